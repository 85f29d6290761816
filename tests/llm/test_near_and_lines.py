import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, awkward, frame, prose, roots, shingle_set

from riskloom.llm import clusters, line_dedup, near_dedup
from riskloom.llm.tables import Scratch, components


def expected_components(rows, width, num, den):
    sets = {}
    for d, t in rows:
        if d is not None:
            sets.setdefault(d, []).append(shingle_set(t, width))
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return roots(ids, links)


@pytest.mark.parametrize("width, share", [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates_equal_brute_force(spark, width, share):
    rows = awkward()
    rows += [rows[0], rows[12]]  # repeated rows
    rows += [(70, prose(31, 90)), (70, prose(32, 90)), (71, prose(31, 90)), (72, prose(32, 90) + " end"), (19, prose(33, 80)), (73, prose(33, 80)), (73, prose(9, 50))]
    found = near_dedup.near_duplicates(frame(spark, rows), width, share).collect()
    wanted = expected_components(rows, width, *share)
    assert len(found) == len(rows)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, set()).add(len(shingle_set(t, width)))
    for r in found:
        assert r.n_shingles in texts[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == wanted[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_texts_under_one_doc_id_all_link(spark):
    a, b = prose(41, 100), prose(42, 100)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (1, a)]
    found = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == 5 and {r.component_id for r in found} == {1} and {r.doc_id for r in found if r.kept} == {1}


def test_cells_are_bounded_by_bytes_too(spark, monkeypatch):
    rows = [(i, prose(51, 200) + f" {i % 7}") for i in range(40)] + [(90, prose(52, 200))]
    monkeypatch.setattr(clusters, "BLOCK_BYTES", 4000)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert found == expected_components(rows, 5, 80, 100)


def test_bands_follow_the_similarity():
    for share in ((85, 100), (80, 100), (1, 2), (1, 10), (1, 1)):
        bands, rows = near_dedup.banding(share)
        assert (1 - (share[0] / share[1]) ** rows) ** bands <= 1.01 * near_dedup.MISS
    assert near_dedup.banding((85, 100)) == (20, 5)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []


def test_sketch_coordinates_are_filled_and_estimate_similarity():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(pool[:2000]), np.unique(pool[500:2500]), pool[:1], pool[:0], pool[:3]]
    sketch = near_dedup.fast_sketches(sets, 512)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (sketch[[0, 1, 2, 4]] != full).all() and (sketch[3] == full).all()
    assert abs((sketch[0] == sketch[1]).mean() - 1500 / 2500) < 0.08


def test_split_clusters_lose_no_link(spark):
    """A group beyond the block size, of near copies that are not all like the smallest one."""
    rnd = random.Random(3)
    base = prose(11, 150).split()
    rows = []
    for i in range(60):
        words = base.copy()
        for j in rnd.sample(range(150), rnd.choice([1, 2, 3, 5, 8])):
            words[j] = f"w{rnd.randint(0, 40)}"
        rows.append((i, " ".join(words)))
    wanted = expected_components(rows, 3, 85, 100)
    docs = frame(spark, rows)
    before = clusters.BLOCK
    for block in (8, 512):
        clusters.linked_components.__defaults__ = (block,)
        try:
            found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 3, (85, 100)).collect()}
        finally:
            clusters.linked_components.__defaults__ = (before,)
        assert found == wanted


def test_components_of_paths_stars_and_rings(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    rnd.shuffle(links)
    wanted = roots({x for p in links for x in p}, links)
    df = spark.createDataFrame(links + [(300, 300)], "a long, b long")
    found = {r.node: r.root for r in components(Scratch(spark, "t"), df).collect()}
    assert found == wanted


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(2)
    for _ in range(500):
        a, b = (bytes(rnd.choices(b"abc", k=rnd.randint(0, 14))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == levenshtein(a, b)


def test_within_bounds():
    rnd = random.Random(3)
    for _ in range(3000):
        a = bytes(rnd.choices(b"abc", k=rnd.randint(0, 40)))
        b = edited(rnd, a.decode() + "x", rnd.randint(0, 9)).encode() if rnd.random() < 0.7 else bytes(rnd.choices(b"abc", k=rnd.randint(0, 40)))
        d = levenshtein(a, b)
        for most, few in ((0, 3), (2, 3), (5, 2), (9, 9), (30, 4)):
            assert line_dedup.within(a, b, most, few) == (d <= most), (a, b, d, most)


def normal(line):
    word = "".join(chr(b) if line_dedup._WORD[b] else " " for b in line.encode("utf-8")).translate(LOWER)
    return [w for w in re.sub("[0-9]", "0", word).split(" ") if w]


def expected_lines(rows, similarity=0.9, min_words=3):
    """{doc_id: removed line numbers} from all pairs of lines, by edit similarity alone."""
    lines = {}
    for d, t in rows:
        if d is not None and t:
            for i, line in enumerate(t.split("\n")):
                w = normal(line)
                if len(w) >= min_words:
                    lines[d, i] = " ".join(w).encode("latin-1")
    places, links = sorted(lines), []
    for i, p in enumerate(places):
        for q in places[i + 1 :]:
            a, b = lines[p], lines[q]
            most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
            if a == b or (abs(len(a) - len(b)) <= most and line_dedup.edit_distance(a, b) <= most):
                links.append((p, q))
    root = roots(places, links)
    out = {}
    for p, r in root.items():
        if p != r:
            out.setdefault(p[0], []).append(p[1])
    return {d: sorted(x) for d, x in out.items()}


def test_byte_counts_tell_lines_apart_before_edit_distance():
    rng = random.Random(19)
    pairs = []
    for _ in range(400):
        a = bytes(rng.choice(b"abcdefghij 0" + bytes([195, 164])) for _ in range(rng.randrange(1, 600)))
        b = bytearray(a)
        for _ in range(rng.randrange(0, 1 + len(a) // 6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = bytes(rng.choice(b"abcdefghij 0") for _ in range(rng.randrange(2)))
        pairs.append((a, bytes(b)))
    pairs.append((b"a" * 2000, b"b" * 2000))  # counts end at 255
    columns = {"a": list(range(len(pairs))), "b": list(range(len(pairs)))}
    for side, lines in zip("ab", zip(*pairs)):
        columns[f"{side}_size"] = list(map(len, lines))
        packed = np.frombuffer(b"".join(line_dedup.byte_counts(np.frombuffer(x, np.uint8)) for x in lines), np.int64).reshape(-1, 4)
        columns |= {f"{side}_c{i}": x for i, x in enumerate(packed.T)}
    counts = [np.stack([columns[f"{side}_c{i}"] for i in range(4)], axis=1).view(np.uint8) for side in "ab"]
    least = line_dedup.fewest_edits(*counts)
    kept = {i for batch in line_dedup._may_be_alike(0.9)(iter([pa.RecordBatch.from_pydict(columns)])) for i in batch.column("a").to_pylist()}
    dropped = 0
    for i, (a, b) in enumerate(pairs):
        d = line_dedup.edit_distance(a, b)
        assert least[i] <= d
        assert i in kept or d > line_dedup.most_edits(max(len(a), len(b)), 0.9)
        dropped += i not in kept
    assert dropped and len(pairs) - 1 not in kept


def test_lines_equal_brute_force(spark):
    long = prose(21, 80)
    rows = [(d, t) for d, t in awkward() if d != 50]
    rows += [(70, "\n".join([prose(20, 12), long, "a b", "a b", prose(20, 12).upper() + "!"])), (71, long.replace("an", "am", 1) + "\n\n" + prose(22, 9)), (72, long + " " + "tail")]
    rows += [(73, "Call 12 34 now please"), (74, "call 98 76 now, please.")]
    docs = frame(spark, rows + [rows[0]])
    removed = line_dedup.repeated_lines(docs)
    wanted = expected_lines(rows)
    assert {r.doc_id: r.removed for r in removed.collect()} == wanted
    kept = line_dedup.without_lines(docs, removed).collect()
    assert len(kept) == len(rows) + 1
    texts = dict(rows)
    for r in kept:
        if r.doc_id is not None:
            gone = set(wanted.get(r.doc_id, []))
            t = texts[r.doc_id]
            assert r.text == (t if t is None or not gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))


def test_close_hashes_in_a_wide_bucket():
    sim = np.arange(200, dtype=np.int64) * 1  # neighbours differ in few bits
    edges = line_dedup._edges(np.zeros(200, np.int64), sim, sim)
    narrow = line_dedup._edges(np.zeros(200, np.int64), sim, sim, wide=1000)
    assert set(roots(range(200), zip(*(c.to_pylist() for c in edges))).values()) == set(roots(range(200), zip(*(c.to_pylist() for c in narrow))).values())


def edited(rnd, line, edits):
    out = list(line)
    for _ in range(edits):
        i, c = rnd.randrange(len(out)), rnd.choice("abcdefghij")
        out[i : i + rnd.randint(0, 1)] = rnd.choice([[c], [c], []]) if len(out) > 9 else [c]
    return "".join(out)


def levenshtein_lines(rows, min_words):
    """{doc_id: removed line numbers} by edit similarity 0.9 alone."""
    lines = {(d, i): " ".join(normal(x)).encode("latin-1") for d, t in rows for i, x in enumerate(t.split("\n")) if len(normal(x)) >= min_words}
    texts = sorted(set(lines.values()))
    links = [
        (a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]
        if abs(len(a) - len(b)) <= (most := int(0.1 * max(len(a), len(b)) + 1e-9)) and line_dedup.edit_distance(a, b) <= most
    ]
    group, first, out = roots(texts, links), {}, {}
    for p in sorted(lines):
        if first.setdefault(group[lines[p]], p) != p:
            out.setdefault(p[0], []).append(p[1])
    return out


def test_parted_pairs_are_all_close_pairs_of_different_parts():
    rnd = np.random.default_rng(4)
    for members, kinds in ((20, 5), (300, 4), (300, 300), (90, 1)):
        base = rnd.integers(0, 1 << 62, (3, 4))
        sketch, key = base[rnd.integers(0, 3, members)].copy(), np.repeat([0, 2], members)[:members]
        sketch[:, 0] ^= rnd.integers(0, 1 << 40, members)
        node, part = np.arange(members), rnd.integers(0, kinds, members)
        found = set()
        for batch in line_dedup._parted_edges(key, sketch, node, part, most=50):
            found |= set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
        alike = (sketch.view(np.uint8).reshape(members, -1)[:, None] == sketch.view(np.uint8).reshape(members, -1)[None]).sum(2) >= line_dedup.AGREE
        assert found == {(i, j) for i in range(members) for j in range(i + 1, members) if alike[i, j] and part[i] != part[j] and key[i] == key[j]}


def test_registered_query_equals_brute_force(spark, tmp_path):
    import hashlib

    from riskloom.llm.queries import QUERIES

    rows = [(d, t) for d, t in awkward() if d not in (50, None)]
    rows += [(70, "Menu\nHome\n" + prose(21, 40)), (71, "menu\n--\n" + prose(21, 40).replace("an", "am", 1)), (72, "\n\nHome page"), (None, "Menu\nMenu")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    gone, wanted = expected_lines(rows, min_words=1), []
    for d, t in rows:
        lines = t.split("\n") if t else []
        kept = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone.get(d, []))
        wanted.append((d, len(lines), len(gone.get(d, [])), kept if kept is None else hashlib.sha256(kept.encode()).hexdigest()))
    found = QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str) and sum(w[2] for w in wanted) > 4


def test_edited_lines_equal_levenshtein_alone(spark):
    rnd, rows = random.Random(5), []
    for k in range(120):
        line = "".join(rnd.choices("etaoin shrdlu", weights=[6, 5, 5, 4, 4, 4, 9, 3, 3, 3, 3, 2, 2], k=rnd.randint(8, 240))).strip() + "x y z"
        rows.append((k, "\n".join([line, edited(rnd, line, 1), edited(rnd, line, max(1, len(line) // 20))])))
    wanted = levenshtein_lines(rows, 3)
    assert sum(map(len, wanted.values())) > 200
    assert {r.doc_id: r.removed for r in line_dedup.repeated_lines(frame(spark, rows)).collect()} == wanted


def test_short_pairs_share_a_piece():
    rnd = random.Random(6)
    for _ in range(3000):
        a = "".join(rnd.choices("abcdefgh ", k=rnd.randint(9, 43)))
        b = edited(rnd, a, rnd.randint(1, 4))
        longer = max(len(a), len(b))
        if min(len(a), len(b)) > line_dedup.SHORT or levenshtein(a, b) > line_dedup.most_edits(longer, 0.9):
            continue
        data, cuts = np.frombuffer((a + b).encode(), np.uint8), np.array([0, len(a), len(a) + len(b)])
        line, keys = line_dedup.piece_keys(data, cuts, 0.9)
        assert set(keys[line == 0]) & set(keys[line == 1]), (a, b)
        counts = line_dedup.letter_counts(data, cuts)
        assert line_dedup._near(np.ones(1, np.int64), counts[:1], counts[1:], 8)[0]


def test_stage_drops_repeats_of_short_lines_and_of_scripts_without_spaces(spark):
    import corpus_pipeline

    chinese = "今天天气很好我们去公园散步吧"
    rows = [(1, f"Menu\nHome page\n{chinese}\n--\n\nMenu"), (2, f"menu\nhome  PAGE!\n{chinese}\n--\n\nother"), (3, chinese.replace("公", "花") + "\nMenus")]
    after = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, frame(spark, rows), "").collect()}
    assert after == {1: f"Menu\nHome page\n{chinese}\n--\n", 2: "--\n\nother", 3: "Menus"}


def test_pairs_are_compared_together_as_one_by_one():
    rnd = random.Random(17)
    pairs = []
    for _ in range(1500):
        x = bytes(rnd.choice(b"abcd \xc3") for _ in range(rnd.choice((1, 9, 40, 63, 64, 65, 130, 700, 3000))))
        y = bytearray(x)
        for _ in range(rnd.randrange(len(x) // 6 + 2)):
            at = rnd.randrange(len(y) + 1)
            y[at : at + rnd.randrange(2)] = bytes(rnd.choice(b"abcd ") for _ in range(rnd.randrange(2)))
        pairs.append((x, bytes(y)) if rnd.random() < 0.5 else (bytes(y), x))
    pairs += [(b"", b""), (b"", b"abc"), (b"abc" * 9, b"xyz" * 9), (b"a\x00b" * 20, b"a\x00\x01" * 20)]
    x, y = (pa.array(side, pa.binary()) for side in zip(*pairs))
    for similarity in (0.9, 0.8, 0.5):
        most = [line_dedup.most_edits(max(len(a), len(b)), similarity) for a, b in pairs]
        found = line_dedup.within_all(x, y, np.array(most))
        assert found.tolist() == [line_dedup.edit_distance(a, b) <= m for (a, b), m in zip(pairs, most)]
        part = line_dedup.within_all(x.slice(100, 300), y.slice(100, 300), np.array(most[100:400]), cells=1 << 12)
        assert part.tolist() == found[100:400].tolist()


def test_packed_entries_give_all_close_pairs_of_a_band(monkeypatch):
    rnd = np.random.default_rng(8)
    base = rnd.integers(0, 256, (30, line_dedup.COORDS)).astype(np.uint8)
    sketch = base[rnd.integers(0, 30, 400)]
    sketch[rnd.random(sketch.shape) < 0.3] = 7
    node, size = rnd.permutation(400) * 3 + 5, rnd.integers(100, 125, 400).astype(np.int32)
    step, part = rnd.integers(20, 22, 400), np.where(rnd.random(400) < 0.5, node, 5)
    columns = {"node": node, **dict(zip(line_dedup._SKETCH, np.ascontiguousarray(sketch).view(np.int64).T)), "step": step, "size": size, "part": part}
    rows = pa.table({k: np.ascontiguousarray(v) for k, v in columns.items()})
    monkeypatch.setattr(line_dedup, "HELD_BYTES", 150 * 4 * line_dedup._ENTRY.itemsize)
    packed = pa.Table.from_batches(list(line_dedup._banded(range(4), 16)(iter(rows.to_batches(max_chunksize=60))))).sort_by("bucket")
    assert packed.num_rows < 4 * 400 / 10
    found = set()
    for batch in line_dedup._bucket_pairs(0.9, True)(iter(packed.to_batches(max_chunksize=5))):
        found |= set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
    keys = np.stack([line_dedup._band_keys(sketch, step, i) for i in range(4)], axis=1)
    wanted = set()
    for i in range(400):
        for j in range(i + 1, 400):
            fits = abs(int(size[i]) - int(size[j])) <= line_dedup.most_edits(max(size[i], size[j]), 0.9)
            if fits and part[i] != part[j] and (keys[i] == keys[j]).any() and (sketch[i] == sketch[j]).sum() >= line_dedup.AGREE:
                wanted.add((min(node[i], node[j]), max(node[i], node[j])))
    assert found == wanted and len(wanted) > 100


def test_candidates_move_in_turns(spark, monkeypatch):
    lines = [f"the same long line of many documents, number {'abcdefgh'[k % 8] * 3}" + "xyz"[k % 3] * (k % 4) for k in range(60)]
    rows, stored, store = [(k, f"{x}\nown {'qwertz'[k % 6] * 40}") for k, x in enumerate(lines)], [], line_dedup.Scratch.store
    monkeypatch.setattr(line_dedup.Scratch, "store", lambda self, df: stored.append(df.columns) or store(self, df))
    once = {r.doc_id: r.removed for r in line_dedup.repeated_lines(frame(spark, rows), min_words=1).collect()}
    before = len(stored)
    monkeypatch.setattr(line_dedup, "MOVED_BYTES", 1)
    monkeypatch.setattr(line_dedup, "MOVED_SHARE", 1.0)
    again = {r.doc_id: r.removed for r in line_dedup.repeated_lines(frame(spark, rows), min_words=1).collect()}
    assert again == once == levenshtein_lines(rows, 1) and len(stored) >= before + 3


def test_pairs_of_many_batches_are_compared_together(monkeypatch):
    lines = [f"line number {'abcdefghij'[k % 10] * 3} of a text".encode() for k in range(200)]
    rows = pa.table({"a": range(200), "b": range(200, 400), "x": pa.array(lines, pa.binary()), "y": pa.array(lines[1:] + lines[:1], pa.binary())})
    calls, within_all = [], line_dedup.within_all
    monkeypatch.setattr(line_dedup, "within_all", lambda x, y, most: calls.append(len(x)) or within_all(x, y, most))
    found = pa.Table.from_batches(list(line_dedup._alike(0.9)(iter(rows.to_batches(max_chunksize=7)))))
    assert calls == [200]
    longer = max(map(len, lines))
    assert found.column("a").to_pylist() == [k for k in range(200) if line_dedup.edit_distance(lines[k], lines[(k + 1) % 200]) <= line_dedup.most_edits(longer, 0.9)]


def test_workers_give_memory_back_after_much_data(monkeypatch):
    from riskloom.llm import textbytes

    trims, batch = [], pa.RecordBatch.from_pydict({"x": np.arange(1000)})
    monkeypatch.setattr(textbytes, "_trim", lambda: trims.append)
    assert [b.num_rows for b in textbytes.freeing(lambda batches: batches)(iter([batch, batch]))] == [1000, 1000] and trims == []
    monkeypatch.setattr(textbytes, "FREED_BYTES", 2 * batch.nbytes)
    assert len(list(textbytes.freeing(lambda batches: (b for b in batches))(iter([batch, batch])))) == 2 and trims == [0]
