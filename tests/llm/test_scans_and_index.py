import random
import re
import zlib

import numpy as np
import pyarrow as pa
from helpers import LOWER, awkward, frame, prose

from riskloom.llm import decontamination, kd_shards, license_scan, mtree_search, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def test_license_scan(spark):
    notice = license_scan.TEMPLATES[3].words
    broken = notice.replace("granted free", "granted FREE-of extra,").replace(" any ", " ")
    rows = awkward() + [
        (90, "MIT  License! mit-license; the MIT license"), (91, "GNU General\nPublic License, Apache License 2"), (92, notice.title()),
        (93, prose(1, 30) + " " + broken), (94, " ".join(notice.split()[:6])), (95, "mit"), (96, "licensemit license"), (97, "general public public license"),
    ]
    found = license_scan.scanned(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        starts = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        if d is not None:
            r = by[d]
            assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(starts), ",".join(sorted({x for _, x in starts})))
            assert (r.first_word, r.last_word) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
            assert 0 <= r.score <= 1
    assert by[92].labels == by[93].labels == "mit-notice" and by[94].labels == "" and by[92].score == 1
    assert license_scan.scanned(frame(spark, [])).collect() == []


def test_scattered_or_reordered_notices_get_no_label(spark):
    rows, spread = [], []
    for n, t in enumerate(license_scan.TEMPLATES[3:]):
        words = t.words.split()
        pairs = [words[i : i + 2] for i in range(len(words) - 1)]
        rows += [(n, " ".join(f"{a} {b} {prose(n, 2)}" for a, b in pairs)), (20 + n, " ".join(f"{a} {b}" for a, b in pairs[::-1]))]
        spread.append((40 + n, prose(n, 40) + " " + " ".join(words[:5] + ["oh", "so"] + words[5:9] + words[10:]) + " " + prose(n, 40)))
    found = {r.doc_id: r for r in license_scan.scanned(frame(spark, rows + spread)).collect()}
    notices = {t.label for t in license_scan.TEMPLATES if not t.base}
    for n, t in enumerate(license_scan.TEMPLATES[3:]):
        assert not notices & set((found[n].labels + "," + found[20 + n].labels).split(","))
        assert t.label in found[40 + n].labels.split(",")


def test_kd_shards_are_near_equal(spark):
    rows = awkward() + [(200 + i, "tied" * 30) for i in range(300)] + [(5, "again")]
    for shards in (1, 3, 8):
        found = kd_shards.kd_sharded(frame(spark, rows), shards=shards).collect()
        assert len(found) == len(rows)
        sizes = [len((t or "").encode()) + 1 for _, t in rows]
        assert sorted((r.size, r.text_crc32) for r in found) == sorted((s, zlib.crc32((t or "").encode())) for s, (_, t) in zip(sizes, rows))
        per = {}
        for r in found:
            per.setdefault(r.shard, []).append(r)
        assert set(per) <= set(range(shards))
        for own in per.values():
            assert sorted(r.slot for r in own) == list(range(len(own)))
    small = [(i, t) for i, t in rows if t is None or len(t) < 500]
    found = kd_shards.kd_sharded(frame(spark, small), shards=8).collect()
    loads = [sum(r.size for r in found if r.shard == s) for s in range(8)]
    assert max(loads) - min(loads) <= 3 * 500
    assert kd_shards.kd_sharded(frame(spark, []), shards=8).collect() == []


def test_target_bytes_give_the_number_of_leaves(spark):
    found = kd_shards.kd_sharded(frame(spark, [(i, "x" * 99) for i in range(40)]), target_bytes=1000).collect()
    assert sorted({r.shard for r in found}) == [0, 1, 2, 3]


def brute_top(rows, k):
    good = [(i, [int(np.floor(float(np.float32(x)) * 64)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in good if i % 20 == 0}:
        own = {tuple(v) for i, v in good if i == q}
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for a in own for i, b in good if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_products(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=12).tolist()) for i in range(500)]
    rows += [(500 + i, rows[7][1]) for i in range(80)] + [(600 + i, [0.5] * 12) for i in range(60)]
    rows += [(700, None), (720, [None] * 12), (740, [float("nan")] * 12), (701, [float("inf")] * 12), (None, rows[0][1]), rows[20], (760, [2.0, 1.0]), (780, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, query long")
    rows += [(801, rows[60][1])] * 30 + [(60, rows[60][1])] * 25 + [(60, rows[61][1])] + [(820, [3.0] * 12)] * 40 + [(822, [3.0] * 12)] * 2 + [(840, [3.0] * 12)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, query long")
    assert sorted(tuple(r) for r in mtree_search.top_products(df).collect()) == brute_top(rows, 20)
    four = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in mtree_search.top_products(four).orderBy("rank").collect()] == [(0, 1, 2, 8192), (0, 2, 1, 4096), (0, 3, 1, 4096)]
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(0, 100, 20)], "vec_id long, embedding array<float>")
    assert mtree_search.top_products(few).count() == 20
    assert mtree_search.top_products(few.limit(0)).collect() == []


def test_top_products_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mtree_search, "BLOCK", 60)
    monkeypatch.setattr(mtree_search, "QUERIES", 4)
    monkeypatch.setattr(mtree_search, "_turn", lambda width: 4)
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(9, 6)) * 5
    rows = [(i, (centres[i % 9] + rnd.normal(size=6) * 0.05).tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in mtree_search.top_products(df).collect()) == brute_top(rows, 20)


def test_tree_prunes_and_stays_exact():
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-2000, 2000, (40, 8))
    x = np.concatenate([c + rnd.integers(-5, 5, (100, 8)) for c in centres])
    tree = mtree_search.Tree(x, [[i] for i in range(len(x))])
    asked = []
    page = mtree_search.Tree._page
    mtree_search.Tree._page = lambda self, leaf, rows, *a: (asked.append(len(rows)), page(self, leaf, rows, *a))[1]
    try:
        got = tree.search(x[:50], 5)
    finally:
        mtree_search.Tree._page = page
    for i, found in enumerate(got):
        wanted = sorted(((-(x[i] @ v), n) for n, v in enumerate(x)))[:5]
        assert [(-s, tree.ids[e][0]) for s, e in found] == wanted
    assert sum(asked) < 50 * len(tree.radii) / 3
    assert tree.products < 50 * len(x) / 3
    big = np.array([[2**30, 1], [2**30, 2], [-(2**30), 5]])
    assert [[s for s, _ in f] for f in mtree_search.Tree(big, [[0], [1], [2]]).search(big[:1], 2)] == [[2**60 + 2, 2**60 + 1]]


def test_contained_items(spark):
    rnd = random.Random(9)
    items = [(i, prose(500 + i, n)) for i, n in enumerate([6, 9, 20, 33, 60, 130, 3, 400])] + [(50, None), (51, ""), (None, prose(900, 25))]
    rows = awkward()
    for i, (n, t) in enumerate(items[:8]):
        words = t.split()
        rows.append((300 + i, prose(1, 200) + " " + t + "\n" + prose(2, 4000)))
        swapped = words.copy()
        swapped[len(words) // 2] = "swapped"
        rows.append((320 + i, prose(3, 150) + " " + " ".join(swapped) + ". " + prose(4, 50)))
        rows.append((340 + i, " ".join(rnd.sample(words, len(words)))))
    found = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in decontamination.contained_items(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    wanted = {}
    for i, t in items:
        own = decontamination.shingle_words((t or "").encode(), 5)
        for d, text in rows:
            common = len(own & decontamination.shingle_words((text or "").encode(), 5))
            if own and common >= 0.8 * len(own):
                wanted[d, i] = len(own), common
    assert found == wanted and len(wanted) > 8
    blocks = decontamination.contained_items(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_bytes=600)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(wanted)
    assert decontamination.contained_items(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert decontamination.contained_items(frame(spark, rows), spark.createDataFrame([], "item_id long, text string")).collect() == []


def toxic_corpus():
    insults = ["blockhead", "nincompoop", "dunderhead", "stinker"]
    rows, labels = [], []
    for i in range(500):
        words = prose(i, 60).split()
        bad = i % 3 == 0
        if bad:
            for w in random.Random(i).sample(insults, 2):
                words.insert(random.Random(i).randint(0, 60), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    docs = frame(spark, rows + [(900, None), (901, ""), (902, "123 456"), (None, "a stinker")])
    known = spark.createDataFrame(labels + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    held = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 50 and all(found[d].predicted == dict(labels)[d] for d in held)
    assert found[None].predicted == 1 and found[900].score == found[901].score == found[902].score < 0.5
    clean = prose(7000, 40)
    for insult in ("block-head", "n i n c o m p o o p", "dunnderhead", "stink3r", "blockhead", "nincomppoop"):
        assert model.scores(model.margins(pa.array([f"{clean} {insult} {clean}"])))[0] >= 0.5, insult
    assert model.scores(model.margins(pa.array([clean])))[0] < 0.5
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {d for d, r in found.items() if not r.predicted}


def test_toxicity_without_labels(spark):
    docs = frame(spark, awkward())
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-6 and r.predicted == 0 for r in toxicity.toxicity(docs, model).collect())
    assert toxicity.toxicity(frame(spark, []), model).collect() == []


def test_word_kernel_is_symmetric_and_bounded_by_the_ceiling():
    words = ["idiot", "idxiot", "banana", "ab", "abc", "thethethe"]
    marks = toxicity.landmark_rows(words)
    like = toxicity.kernel(*toxicity.coded(words), marks)
    assert np.allclose(like, like.T, atol=1e-5) and like[0, 1] > 0.5 > like[0, 2]
    assert (toxicity.ceiling(*toxicity.coded(words), marks.max(axis=1)) >= like.max(axis=1) - 1e-5).all()
