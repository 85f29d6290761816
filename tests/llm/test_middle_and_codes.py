"""Fill-in-middle against plain slicing; vector codes against plain integer rounds."""

import hashlib
import math
import random

import numpy as np
import pytest
from helpers import awkward, frame, prose

from riskloom.llm import anchor_codes, fill_middle, queries

MIXED = "ab é中😀\n\t xyz"


def odd_texts():
    rnd = random.Random(11)
    texts = ["", "a", "😀", "<P>", "a<S>b", "<M", "a<", ">b", "<P", " \n ", "\n\n\nx\n", "中" * 5000, "ab" * 2048, "é" * 2048, "a" * 4095 + "😀" + "b" * 4095, None]
    return texts + ["".join(rnd.choices(MIXED, k=rnd.choice((3, 40, 900, 5000)))) for _ in range(150)]


def units(text, unit):
    if unit == "code point":
        return list(text)
    starts = [0] if text else []
    for i in range(1, len(text)):
        white = [c in "\t\n\v\f\r " for c in text[i - 1 : i + 1]]
        if (white[0] and not white[1]) if unit == "word" else text[i - 1] == "\n":
            starts.append(i)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def plainly(doc_id, text, unit="code point", seed=1, rate=90, spm=20):
    text = text or ""
    h = [int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    parts = units(text, unit)
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", fill_middle.UNITS)
def test_middle_equals_plain_slicing(spark, unit):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd_texts())] + [(100, "again"), (-5, "minus <")]
    made = fill_middle.middle_examples(frame(spark, rows), unit).withColumn("back", fill_middle.restored()).collect()
    found = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made]
    assert sorted(found, key=str) == sorted(((d, *plainly(d, t, unit)) for d, t in rows), key=str)
    assert sorted((r.doc_id or -1, r.back) for r in made) == sorted((d or -1, t or "") for d, t in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_middle_settings_and_empty_table(spark):
    docs = frame(spark, [(i, prose(i, 9)) for i in range(200)])
    made = fill_middle.middle_examples(docs, seed=7, rate=100, suffix_first=0, marks=("<a>", "<b|>", "<.*>"))
    rows = made.withColumn("back", fill_middle.restored(marks=("<a>", "<b|>", "<.*>"))).collect()
    assert {r.form for r in rows} == {"psm"} and {r.doc_id: r.back for r in rows} == {i: prose(i, 9) for i in range(200)}
    assert fill_middle.middle_examples(docs.limit(0)).count() == 0
    for wrong in ({"unit": "byte"}, {"marks": ("<P>", "<P>", "<M>")}, {"marks": ("P>", "<S>", "<M>")}):
        with pytest.raises(ValueError):
            fill_middle.middle_examples(docs, **wrong)


def test_middle_query(spark, tmp_path):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd_texts())]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = []
    for d, t in rows:
        n, form, prefix, middle, output = plainly(d, t)
        wanted.append((d, n, form, prefix, middle, sha(output), sha(t or "")))
    assert sorted(map(tuple, queries.op12_fill_middle(spark, str(tmp_path)).collect()), key=str) == sorted(wanted, key=str)


def test_fenwick_descent_equals_prefix_sums():
    rnd = np.random.default_rng(3)
    for blocks in (1, 2, 7, 8, 9, 100):
        counts = np.stack([rnd.integers(0, 4, blocks) * rnd.integers(0, 2, blocks), rnd.integers(0, 9, blocks)], axis=1)
        tree, sums = fill_middle.Fenwick(counts), np.concatenate([[[0, 0]], np.cumsum(counts, axis=0)])
        for k in range(tree.total[0] + 1):
            block = max(b for b in range(blocks + 1) if sums[b, 0] <= k)
            assert tree.descend(k) == (block, *sums[block])


# --- vector codes -----------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, code, error, label_error, digest) per sound row."""
    sound = [(v, x, lab) for v, x, lab in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    cells = [([math.floor(c * scale) for c in np.float32(x).astype(float).tolist()], v, lab) for v, x, lab in sound]
    if not cells:
        return []
    cells.sort(key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    width = len(cells[0][0]) // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for x, _, _ in cells]
    books = [[list(cut[k][p]) for k in range(min(entries, len(cells)))] for p in range(parts)]
    dist = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))
    assign = lambda: [[min(range(len(books[p])), key=lambda k: (dist(x[p], books[p][k]), k)) for p in range(parts)] for x in cut]
    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, codes) if c[p] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    codes = assign()
    errors = [sum(dist(x[p], books[p][c[p]]) for p in range(parts)) for x, c in zip(cut, codes)]
    total = {}
    for (_, _, lab), e in zip(cells, errors):
        total[lab] = total.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return [(v, "".join(f"{k:02x}" for k in c), e, total[lab], digest) for (_, v, lab), c, e in zip(cells, codes, errors)]


def vectors(spark, rows):
    return spark.createDataFrame([(v, x, lab, 1, 2) for v, x, lab in rows], "vec_id long, embedding array<float>, label int, error int, codes string")


def awkward_vectors(n, width=16, seed=2):
    rnd = random.Random(seed)
    some = lambda: [rnd.gauss(rnd.choice((-2, 0, 2)), 0.3) for _ in range(width)]
    rows = [(i, some(), rnd.choice((None, 0, 1, 2))) for i in range(n)]
    same = [0.5] * width
    rows += [(1000 + i, same, 3) for i in range(90)] + [(5, some(), 1), (5, some(), 1), *rows[7:8], *rows[7:8], (None, some(), 2), (None, some(), None)]
    rows += [(2000, None, 1), (2001, [float("nan")] + same[1:], 1), (2002, [float("inf")] + same[1:], 1), (2003, [None] + same[1:], 1), (-1, [-0.0] * width, 0)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [0, 3, 400])
def test_codes_equal_plain_rounds(spark, tmp_path, n, monkeypatch):
    monkeypatch.setattr(anchor_codes, "BLOCK", 150)
    rows = awkward_vectors(n)
    vectors(spark, rows).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op13_anchor_codes(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_codes(rows), key=str)


def test_few_and_no_vectors(spark, tmp_path):
    for name, rows in (("few", [(3, [1.0] * 8, None), (1, [1.0] * 8, 2)]), ("none", [(1, None, 2)]), ("empty", [])):
        vectors(spark, rows).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        found = queries.op13_anchor_codes(spark, f"{tmp_path}/{name}").collect()
        assert sorted(map(tuple, found), key=str) == sorted(plain_codes(rows), key=str)
    for wrong in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e20] * 8, 1)], [(1, [], 1)]):
        with pytest.raises(ValueError):
            anchor_codes.compressed(vectors(spark, wrong))


def test_walk_is_exact_and_settles_whole_balls():
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-40_000, 40_000, (16, 8))
    clustered = centres[rnd.integers(0, 16, 4096)] + rnd.integers(-400, 400, (4096, 8))
    even = rnd.integers(-9000, 9000, (4096, 8))
    shares = []
    for points in (clustered, even, np.zeros((500, 8), np.int64), points_with_ties(rnd)):
        nodes, order = anchor_codes.grown(points)
        assert sorted(order.tolist()) == list(range(len(points)))
        for ball in nodes[:: max(1, len(nodes) // 50)]:
            held = points[order[ball["first"] : ball["first"] + ball["n"]]]
            assert (held.sum(0) == ball["sum"]).all()
            assert (((held - ball["sum"] / ball["n"]) ** 2).sum(1) <= (ball["radius"] * (1 + 1e-12)) ** 2 + 1e-9).all()
        entries = points[:16]
        walk = anchor_codes.Walk(points, nodes, order, entries)
        d = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (walk.index == d.argmin(1)).all() and (walk.counts == np.bincount(walk.index, minlength=16)).all()
        assert (walk.sums == np.stack([points[walk.index == k].sum(0) for k in range(16)])).all()
        shares.append(walk.compared / d.size)
    assert shares[0] < 0.3 and shares[1] < 1


def points_with_ties(rnd):
    return rnd.integers(-2, 3, (700, 8))
