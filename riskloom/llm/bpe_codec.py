"""Byte-level BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash of the last ``WINDOW`` bytes cuts a text into chunks of about
256 bytes, at characters' starts; equal passages get equal chunks whatever stands
before them. A worker encodes each chunk once and keeps its inner part (everything
between the chunk's first and last cut at which the tokenizer surely cuts, see
:mod:`pieces`). What is left at a join of two chunks is put together and encoded anew,
over as many chunks as it takes to reach sure cuts on both sides; from there on the ids
agree exactly with those of the whole text.

Decoding maps ids to bytes by the tokenizer's vocabulary and reads the bytes as UTF-8
with replacement of malformed parts, as the byte-level decoder does.

Defined results: null and empty texts have no tokens; special tokens' strings in a text
are their ids, as the library reads them; rows are independent, so repeated rows and
null ``doc_id`` are fine. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.pieces import Memo, cuts

WINDOW = 16
#: Chunks and pieces that a worker remembers before it starts anew.
CHUNK_MEMO = 20_000
MEMO_PIECES = 250_000
_ROLL = tb.Hasher(51)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a chunk begins inside a text, from the bytes before them alone."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    ends = np.arange(WINDOW, len(data))
    rolled = _ROLL(data, ends - WINDOW, ends)
    hit = ends[rolled >> np.uint64(56) == 0]
    hit = hit[(data[hit] & 0xC0) != 0x80]
    inside = hit - offsets[np.searchsorted(offsets, hit, "right") - 1]
    return hit[inside >= WINDOW]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """One tokenizer file: ids of texts by chunks, and texts of ids."""

    _of: dict[str, Codec] = {}

    def __init__(self, path: str) -> None:
        self.memo = Memo.of(path)
        alphabet = byte_alphabet()
        tokens = {i: t for t, i in self.memo.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.raw = [bytes(alphabet[c] for c in tokens[i]) if i in tokens and all(c in alphabet for c in tokens[i]) else tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.pieces: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.chunks: dict[bytes, tuple[bytes, tuple[int, bytes, bytes], bytes | None]] = {}

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def learn(self, wanted: list[bytes]) -> None:
        """Encodes the pieces that are not known yet: count, decimal ids with commas, bytes the ids decode to."""
        new = [p for p in dict.fromkeys(wanted) if p not in self.pieces]
        if not new:
            return
        if len(self.pieces) > MEMO_PIECES:
            self.pieces.clear()
            new = list(dict.fromkeys(wanted))
        for p, ids in zip(new, self.memo.encode([p.decode() for p in new])):
            decoded = b"".join([self.raw[i] for i in ids])
            self.pieces[p] = (len(ids), "".join(f"{i}," for i in ids).encode(), p if decoded == p else decoded)  # one copy in memory

    def together(self, pieces: list[bytes]) -> tuple[int, bytes, bytes]:
        found = [self.pieces[p] for p in pieces]
        return sum(f[0] for f in found), b"".join([f[1] for f in found]), b"".join([f[2] for f in found])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, bytes, bytes]]:
        """Per text: number of ids, the ids in decimal with a comma after each, the decoded bytes."""
        raw = data.tobytes()
        sure = cuts(data)
        starts = np.union1d(chunk_starts(data, offsets), offsets)
        edges = np.flatnonzero(sure)
        low, high = np.searchsorted(edges, starts[:-1], "right"), np.searchsorted(edges, starts[1:], "left")
        if len(self.chunks) > CHUNK_MEMO:
            self.chunks.clear()
        names = [raw[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        new: dict[bytes, tuple[bytes, list[bytes], bytes | None]] = {}
        for i, name in enumerate(names):
            if name in self.chunks or name in new:
                continue
            at = edges[low[i] : high[i]].tolist()
            if at:
                end = int(starts[i + 1])
                new[name] = raw[int(starts[i]) : at[0]], [raw[a:b] for a, b in zip(at[:-1], at[1:])], raw[at[-1] : end]
            else:
                new[name] = name, [], None
        self.learn([p for _, inner, _ in new.values() for p in inner])
        for name, (head, inner, tail) in new.items():
            self.chunks[name] = head, self.together(inner), tail
        # the joins: what lies between the last sure cut of a chunk and the first of a later one
        first = np.searchsorted(starts, offsets).tolist()
        plans: list[list[bytes | tuple[int, bytes, bytes]]] = []
        for text in range(len(offsets) - 1):
            plan: list[bytes | tuple[int, bytes, bytes]] = []
            held = b""
            for i in range(first[text], first[text + 1]):
                head, inner, tail = self.chunks[names[i]]
                if held and sure[starts[i]]:
                    plan.append(held)
                    held = b""
                held += head
                if tail is not None:
                    if held:
                        plan.append(held)
                    plan.append(inner)
                    held = tail
            if held:
                plan.append(held)
            plans.append(plan)
        self.learn([x for plan in plans for x in plan if isinstance(x, bytes)])
        out = []
        for plan in plans:
            found = [self.pieces[x] if isinstance(x, bytes) else x for x in plan]
            out.append((sum(f[0] for f in found), b"".join([f[1] for f in found]), b"".join([f[2] for f in found])))
        return out


def _coded(path: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in batches:
            for part in tb.steps(batch, "text"):
                n, printed, digest, decoded = [], [], [], []
                for count, ids, plain in codec.encode(*tb.utf8(part.column("text"))):
                    n.append(count)
                    printed.append(ids[:-1] if texts else hashlib.sha256(ids[:-1]).hexdigest())
                    plain = plain.decode("utf-8", "replace")
                    decoded.append(plain if texts else hashlib.sha256(plain.encode()).hexdigest())
                columns = [pa.array(n, pa.int64()), pa.array([p.decode() for p in printed] if texts else printed, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas), decoded (the text the ids give)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tb.freeing(_coded(path, True)), "doc_id long, n_tokens long, ids string, decoded string")


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """As :func:`encoded`, with SHA-256 of ids and decoded text made where they are, in the tasks."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(tb.freeing(_coded(path, False)), "doc_id long, n_tokens long, ids string, decoded string")
    return out.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})
