"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set is its distinct word shingles. The sketch has ``t`` coordinates and is
filled in rounds: in round i < t every shingle is hashed to one coordinate, in round
t + i every shingle to coordinate i, and a coordinate keeps the smallest hash of the
first round that reached it. After 2 t rounds every coordinate is filled, and two
sketches agree in a coordinate with a probability of the sets' Jaccard similarity,
concentrated as with independent trials. Long texts need one or two rounds.

Bands of coordinates give bucket keys; their number and width follow from the similarity
asked for (``banding``). Equal sets (by a 128-bit fingerprint) are one class first, and
classes, not documents, are the nodes of all further steps; buckets give stars of classes,
and :mod:`clusters` verifies all links on the full sets.

Defined results: null or empty text, or text without words, has no set (0 shingles) and
is linked with nothing; rows that share a ``doc_id`` are one document, and all their sets
link; a null ``doc_id`` is linked with nothing and kept. Only ``doc_id`` and ``text`` are
read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.clusters import linked_components, spanning
from riskloom.llm.tables import Scratch, components, small

COORDINATES, MISS = 100, 1e-5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def banding(share: tuple[int, int]) -> tuple[int, int]:
    """(bands, rows): the widest bands that miss a pair at this similarity with a probability of ``MISS`` at most."""
    like = min(share[0] / share[1], 1 - 1e-9)
    for rows in range(8, 1, -1):
        if (1 - like**rows) ** (COORDINATES // rows) <= MISS:
            return COORDINATES // rows, rows
    return math.ceil(math.log(MISS) / math.log(1 - like)), 1


def shingle_sets(column: pa.Array, hasher: tb.Hasher, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, offsets = tb.utf8(column)
    starts, ends, firsts = tb.spans(data, offsets, tb.SPACES)
    values, begins = tb.shingles(hasher(data, starts, ends), firsts, width)
    return [np.unique(values[a:b]) for a, b in zip(begins[:-1], begins[1:])]


def fast_sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of ``t`` coordinates per set; rows of empty sets stay unfilled."""
    sizes = np.array([len(s) for s in sets])
    sketch = np.full(len(sets) * t, _EMPTY)
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    salts = tb.seeds(2 * t, 11)
    for i in range(2 * t):
        if not len(items):
            break
        hashed = tb.mix(items ^ salts[i])
        place = ((hashed >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        place = owner * t + place
        unfilled = sketch[place] == _EMPTY
        np.minimum.at(sketch, place[unfilled], np.minimum(tb.mix(hashed[unfilled]), _EMPTY - np.uint64(1)))
        waiting = (sketch.reshape(-1, t) == _EMPTY).any(axis=1)[owner]
        items, owner = items[waiting], owner[waiting]
    return sketch.reshape(-1, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key per set and band."""
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(tb.seeds(bands, 12), (len(sketch), bands))
        for r in range(rows):
            keys = tb.mix(keys * np.uint64(0xD6E8FEB86659FD93) + sketch.reshape(-1, bands, rows)[:, :, r])
    return keys


def _sketched(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tb.Hasher(3, lower=True)
        for batch in batches:
            for part in tb.steps(batch, "text"):
                sets = shingle_sets(part.column("text"), hasher, width)
                keys = band_keys(fast_sketches(sets, bands * rows), bands, rows)
                with np.errstate(over="ignore"):
                    print_ = [(s.sum(dtype=np.uint64), tb.mix(s ^ np.uint64(77)).sum(dtype=np.uint64)) for s in sets]
                prints = np.array(print_, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("mark"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints[:, 0]),
                        pa.array(prints[:, 1]),
                        pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, pa.array(keys.ravel().view(np.int64))),
                    ],
                    ["doc_id", "mark", "n_shingles", "print_a", "print_b", "bands"],
                )

    return run


def _set_payload(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tb.Hasher(3, lower=True)
        for batch in batches:
            for part in tb.steps(batch, "text"):
                sets = shingle_sets(part.column("text"), hasher, width)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "payload"])

    return run


def jaccard_links(share: tuple[int, int]):
    """Spanning links of sets with ``den`` * intersection >= ``num`` * union, all pairs looked at."""
    num, den = share

    def verify(nodes: list[int], payloads: list[bytes]) -> list[tuple[int, int]]:
        sets = [np.frombuffer(p, np.uint64) for p in payloads]
        sizes = np.array([len(s) for s in sets])
        n = len(sets)
        if n < 2:
            return []
        _, which = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), sizes)
        order = np.argsort(which, kind="stable")
        which, owner = which[order], owner[order]
        common = np.zeros((n, n), np.float64)
        width = max(1, (4 << 20) // n)
        for low in range(0, int(which[-1]) + 1 if len(which) else 0, width):
            a, b = np.searchsorted(which, [low, low + width])
            cells = np.zeros((n, width if low + width <= which[-1] else int(which[-1]) + 1 - low), np.float32)
            cells[owner[a:b], which[a:b] - low] = 1
            common += cells @ cells.T
        union = sizes[:, None] + sizes[None, :] - common
        i, j = np.nonzero(np.triu(den * common >= num * union, 1))
        return spanning(nodes, zip(i.tolist(), j.tolist()))

    return verify


def near_duplicates(docs: DataFrame, width: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to), kept; a row per input row.

    A pair at the similarity asked for shares a bucket with a probability of at least
    1 - ``MISS``; pairs of one candidate cluster are compared in any case.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    bands, rows = banding(share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))  # tells texts under one doc_id apart
    schema = "doc_id long, mark long, n_shingles long, print_a long, print_b long, bands array<long>"
    sketched = scratch.store(texts.mapInArrow(tb.freeing(_sketched(width, bands, rows)), schema))
    full = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("print_a", "print_b").agg(F.min(F.struct("doc_id", "mark")).alias("rep"))
    classes = scratch.store(classes.withColumn("node", F.monotonically_increasing_id()))
    own = full.join(classes, ["print_a", "print_b"])
    repeated = not full.groupBy("doc_id", "mark").count().filter("count > 1").isEmpty()
    once = (lambda df: df.dropDuplicates(["node"])) if repeated else (lambda df: df)  # a class's first text may stand in many rows
    belongs = own.select("doc_id", "node")
    belongs = scratch.store(belongs.distinct() if repeated else belongs)
    firsts = once(own.filter("doc_id = rep.doc_id AND mark = rep.mark"))
    keys = scratch.store(firsts.select("node", F.explode("bands").alias("band")))
    leaders = keys.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    stars = keys.join(leaders, "band").filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    stars = scratch.store(stars.distinct())
    scratch.drop(keys)

    def payload_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.join(classes, "node").select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.mark").alias("rep_mark"))
        wanted = scratch.store(wanted)
        found = texts.join(small(wanted), (F.col("doc_id") == F.col("rep_id")) & (F.col("mark") == F.col("rep_mark"))).select("node", "text")
        return once(found).mapInArrow(tb.freeing(_set_payload(width)), "node long, payload binary")

    linked = linked_components(scratch, stars, payload_of, jaccard_links(share))
    lowest = belongs.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").drop("high")
    together = scratch.store(belongs.join(lowest, "doc_id").filter("node > low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    if not together.isEmpty():  # documents of several sets
        linked = components(scratch, linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(together))
    placed = belongs.join(linked, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "root").filter("doc_id <> component_id").select(F.col("doc_id").alias("id"), "component_id")
    named = scratch.store(named.distinct() if repeated else named)
    if not together.isEmpty():
        named = named.distinct()
    out = sketched.join(named, F.col("doc_id") == F.col("id"), "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.col("component_id").isNull().alias("kept")
    )
