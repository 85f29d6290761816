"""Exact links inside candidate clusters, in cells of bounded size.

Candidate pairs come as stars (a, b) from sketch buckets. Their components are the
candidate clusters; every link between two of a cluster's members is looked for, so
no pair of a bucket is lost although only stars are emitted. A cluster is dealt into
blocks of at most about ``BLOCK`` members and ``BLOCK_BYTES`` of payload (one member may
be larger), each with the cluster's smallest member:

1. inside each block all pairs are verified, and a spanning forest of the links kept;
2. members that are not yet joined to the cluster's smallest one (few, in a group of
   near copies) meet every other block, again in cells of two blocks at most.

Two members that are both joined to the smallest one are in one component already, so
the pairs left out between blocks cannot change a component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.tables import Scratch, components

BLOCK, BLOCK_BYTES = 512, 128 << 20
Verify = Callable[[list[int], list[bytes]], Iterable[tuple[int, int]]]


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one ``key`` after the other; the batches are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        first = 0
        for cut in [*((keys[1:] != keys[:-1]).nonzero()[0] + 1), len(keys)]:
            if cut == first:
                continue
            if held and held[-1].column(key)[0].as_py() != keys[first]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, cut - first))
            first = cut
    if held:
        yield pa.Table.from_batches(held)


def spanning(nodes: list[int], pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of index pairs, (smallest node, node) for every node of each component but the smallest."""
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            if nodes[a] > nodes[b]:
                a, b = b, a
            parent[b] = a
    return [(nodes[find(i)], nodes[i]) for i in range(len(nodes)) if find(i) != i]


def _verified(cells: DataFrame, payload: DataFrame, verify: Verify) -> DataFrame:
    """Links of all cells (cell, node), after the payload of each node was joined."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for rows in runs(batches, "cell"):
            found = dict(zip(rows.column("node").to_pylist(), rows.column("payload").to_pylist()))
            for x, y in verify(list(found), list(found.values())):
                a.append(x)
                b.append(y)
            if len(a) > 10_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = cells.join(payload, "node").select("cell", "node", "payload").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(tb.freeing(links), "a long, b long")


def _parts(block: int) -> Column:
    """How many blocks the grouped members need, by number and by bytes."""
    return F.ceil(F.greatest(F.count("*") / block, F.sum("bytes") / BLOCK_BYTES)).cast("int")


def linked_components(
    scratch: Scratch, candidates: DataFrame, payload_of: Callable[[DataFrame], DataFrame], verify: Verify, block: int = BLOCK
) -> DataFrame:
    """(node, root) of the components under verified links.

    ``candidates`` are stars (a, b); ``payload_of(nodes)`` gives (node, payload binary);
    ``verify(nodes, payloads)`` gives a spanning set of the links among them.
    """
    clusters = components(scratch, candidates)
    payload = scratch.store(payload_of(clusters.select("node")).withColumn("bytes", F.octet_length("payload").cast("long")))
    weighed = clusters.join(payload.select("node", "bytes"), "node")
    sizes = weighed.groupBy("root").agg(_parts(block).alias("blocks"))
    members = scratch.store(
        weighed.join(sizes, "root").select("root", "node", "bytes", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    )
    everywhere = F.when(F.col("node") == F.col("root"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    cells = members.withColumn("block", F.explode(everywhere)).select(F.xxhash64("root", "block").alias("cell"), "node")
    links = scratch.store(_verified(cells, payload, verify))
    split = scratch.store(members.filter("blocks > 1"))
    if not split.isEmpty():
        links = scratch.store(links.unionByName(_verified(_crossing(scratch, split, links, block), payload, verify)))
    scratch.drop(clusters, members, split, payload)
    return components(scratch, links)


def _crossing(scratch: Scratch, split: DataFrame, links: DataFrame, block: int) -> DataFrame:
    """Cells (cell, node) where members not joined to their cluster's root meet each block."""
    joined = components(scratch, links).withColumnRenamed("root", "found")
    known = split.join(joined, "node", "left").withColumn("found", F.coalesce("found", "node"))
    loose = known.filter("found <> root").select("root", "node", "bytes", "block", "blocks")
    parts = loose.groupBy("root").agg(_parts(block).alias("parts"))
    loose = scratch.store(loose.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")))
    one = split.join(parts, "root").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    other = loose.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pick = [F.xxhash64("root", "block", "part").alias("cell"), F.col("node")]
    return one.select(*pick).unionByName(other.select(*pick)).distinct()
