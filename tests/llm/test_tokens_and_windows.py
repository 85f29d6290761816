import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from helpers import WORD, awkward, frame, prose
from tokenizers import Tokenizer

from riskloom.llm import bpe_codec, substring_dedup, token_store

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = "ab E\n\t .,'s!é中😀<|endoftext|>A|É    \x1c 1２LĹ \xa0 İΣ́"


def odd_texts(n):
    rnd = random.Random(4)
    fixed = [None, "", "<|endoftext|>", "a <|endoftext|> b", "x" * 3000, " " * 700, "It's, we'll;don't.", "a<|endoftext|>.b | c |d", "ab " * 900]
    return fixed + ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 120))) for _ in range(n)]


def test_codec_equals_the_library(spark):
    rows = list(enumerate(odd_texts(400))) + [(1000 + i, t) for i, (_, t) in enumerate(awkward())] + [(None, "null id")]
    library = Tokenizer.from_file(BYTES)
    found = {r.doc_id: r for r in bpe_codec.encoded(frame(spark, rows), BYTES).collect()}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (found[d].n_tokens, found[d].ids) == (len(ids), ",".join(map(str, ids)))
        assert found[d].decoded == library.decode(ids, skip_special_tokens=False)
    digest = bpe_codec.encoded_digests(frame(spark, rows[:50]), BYTES).collect()
    assert all(r.ids_sha256 == hashlib.sha256(found[r.doc_id].ids.encode()).hexdigest() for r in digest)


def test_chunks_do_not_depend_on_what_stands_before():
    text = prose(3, 2000).encode()
    for before in (b"", b"some other beginning "):
        data = np.frombuffer(before + text, np.uint8)
        cuts = bpe_codec.chunk_starts(data, np.array([0, len(data)])) - len(before)
        late = set(cuts[cuts >= bpe_codec.WINDOW].tolist())
        if before:
            assert late == first and len(late) > 20
        first = late


def test_packing_round_trip():
    for bits in (1, 7, 8, 13, 16, 17, 31):
        ids = np.random.default_rng(bits).integers(0, 2**bits, 777).astype(np.uint32)
        packed = token_store.pack(ids, bits)
        assert len(packed) == -(-777 * bits // 8)
        assert (token_store.unpack(packed, bits, 0, 777) == ids).all()
        for first, count in ((5, 0), (333, 44), (776, 1)):
            assert (token_store.unpack(packed, bits, first, count) == ids[first : first + count]).all()


def test_store_equals_the_library(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(150))] + [(1000 + (d or 0), t) for d, t in awkward() if d != 50] + [(3, "again"), (None, "null id")]
    library = Tokenizer.from_file(WORDS)
    found = token_store.stored_ids(frame(spark, rows), WORDS, block_ids=700).collect()
    code = lambda t: library.encode(t or "", add_special_tokens=False).ids + [1]
    ordered = sorted(found, key=lambda r: r.start)
    assert sorted(-1 if d is None else d for d, _ in rows) == [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    wanted = sorted((-1 if d is None else d, len(code(t)), zlib.crc32(np.array(code(t), "<u4").tobytes())) for d, t in rows)
    assert wanted == sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in found)
    assert token_store.stored_ids(frame(spark, []), WORDS).collect() == []


def brute_windows(rows, width):
    """{doc_id: (n_words, n_removed, kept)} with windows judged in (doc_id, start) order."""
    first, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in first:
                gone[s : s + width] = [True] * width
            first.add(key)
        out[d] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return out


def test_windows_equal_brute_force(spark):
    rows = [r for r in awkward() if r[0] is not None]
    period = prose(31, 31)
    rows += [(80, " ".join([period] * 5)), (81, "a b " * 60), (82, "z " * 25 + period), (83, prose(100, 5) + " " + prose(1, 120)[40:400])]
    for width in (20, 7):
        found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(frame(spark, rows), width).collect()}
        assert found == brute_windows(rows, width)


def test_windows_of_random_small_alphabets(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choices("ab" if i % 2 else "abcdef", k=rnd.randint(0, 160)))) for i in range(60)]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(frame(spark, rows), 6).collect()}
    assert found == brute_windows(rows, 6)


def test_windows_with_null_and_repeated_ids(spark):
    text = prose(1, 50)
    rows = [(1, text), (1, text), (2, text), (None, text)]
    found = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.without_repeats(frame(spark, rows)).collect())
    assert found == [(0, 0), (1, 0), (1, 0), (2, 50)]
    assert substring_dedup.without_repeats(frame(spark, [])).collect() == []
