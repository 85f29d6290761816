"""Sharding by a k-d tree over metadata, in DataFrame operations alone.

The documents' metadata (no text) is stored once. A node that is to hold ``n`` leaves is
split along its widest dimension (its extent against the whole table's) where the bytes
reach the share of ``n // 2`` leaves, until every node is one leaf of the target bytes.
The weighted median is exact: histograms of bytes by value, for all nodes of a level in
one job, are narrowed bin by bin to one value, and rows of that value are parted by row
number in the same way, so equal values can't unbalance a split. Only histograms reach
the driver, at most ``CELLS`` cells a round.

Law ``bytes``: shard sizes differ by about one document's size a level. Equal texts may
go to different shards; that is what lets a group with a third of all rows be balanced.

Defined results: a null text has size 1 and the CRC of no bytes; null metadata counts as
0 or as the empty string; repeated rows and null ``doc_id`` are rows like others; an
empty table gives no rows; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.tables import Scratch, small

CELLS = 1 << 17
#: Rows per numbering group, about.
GROUP_ROWS = 50_000


def dimensions(docs: DataFrame) -> dict[str, Column]:
    """Whole numbers by which documents are parted: the id, the size, and hashes of language and source."""
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))
    out = {"d_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "d_size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}
    return out | {f"d_{c}": code(c) for c in ("lang", "source") if c in docs.columns}


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = schema.replace(" long", "").replace(" int", "").split(", ")
    text = ", ".join(f"({', '.join(f'{v}L' for v in r)})" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(names)})"))  # a row per node of one level


def _cuts(rows: DataFrame, nodes: dict[int, dict], column: Column, condition: Column | None) -> None:
    """For each node narrows [low, high] of ``column`` to the value at which its bytes reach ``goal``.

    ``before`` becomes the bytes of the node's smaller values.
    """
    spark = rows.sparkSession
    while active := {i: n for i, n in nodes.items() if n["low"] < n["high"]}:
        bins = max(16, CELLS // len(active))
        for n in active.values():
            n["width"] = (n["high"] - n["low"]) // bins + 1
        asked = _frame(spark, [(i, n["dim"], n["low"], n["high"], n["width"], n["value"]) for i, n in active.items()], "node long, dim long, low long, high long, width long, value long")
        known = rows.join(asked, "node")
        if condition is not None:
            known = known.filter(condition)
        inside = known.withColumn("v", column).filter("v BETWEEN low AND high")
        table = inside.groupBy("node", F.expr("(v - low) div width").alias("bin")).agg(F.sum("size").alias("bytes")).collect()
        for i, n in active.items():
            for cell in sorted((r for r in table if r["node"] == i), key=lambda r: r["bin"]):
                last = cell
                if n["before"] + cell["bytes"] >= n["goal"]:
                    break
                n["before"] += cell["bytes"]
            else:
                n["before"] -= last["bytes"]
            low = n["low"] + last["bin"] * n["width"]
            n["low"], n["high"] = low, min(n["high"], low + n["width"] - 1)


def kd_sharded(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: leaves are numbered in order, slots from 0 without gaps."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    dims = dimensions(docs)
    names = list(dims)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fixed = [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size")]
    meta = scratch.store(docs.select(*fixed, F.crc32(text.cast("binary")).alias("text_crc32"), *(c.cast("long").alias(n) for n, c in dims.items())))
    total, count, *ends = meta.agg(F.sum("size"), F.count("*"), *(f(n) for n in names for f in (F.min, F.max))).first()
    if not count:
        return meta.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    leaves = shards or -(-total // target_bytes)
    whole = [max(1, b - a) for a, b in zip(ends[::2], ends[1::2])]
    rows = meta.withColumn("node", F.lit(0).cast("long"))
    pending = {0: leaves}  # first leaf of a node: its number of leaves
    while any(n > 1 for n in pending.values()):
        sizes = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *(f(n).alias(f"{k}_{n}") for n in names for k, f in (("min", F.min), ("max", F.max))))
        nodes = {}
        for r in sizes.filter(F.col("node").isin([i for i, n in pending.items() if n > 1])).collect():
            wide = [(r[f"max_{n}"] - r[f"min_{n}"]) / w for n, w in zip(names, whole)]
            d = wide.index(max(wide))
            n = pending[r["node"]]
            nodes[r["node"]] = {"dim": d, "low": r[f"min_{names[d]}"], "high": r[f"max_{names[d]}"], "value": 0, "before": 0, "goal": r["bytes"] * (n // 2) / n}
        if not nodes:
            break
        pick = F.coalesce(*(F.when(F.col("dim") == i, F.col(n)) for i, n in enumerate(names)))
        _cuts(rows, nodes, pick, None)
        asked = _frame(spark, [(i, n["dim"], n["low"]) for i, n in nodes.items()], "node long, dim long, value long")
        for r in rows.join(asked, "node").filter(pick == F.col("value")).groupBy("node").agg(F.min("row"), F.max("row")).collect():
            n = nodes[r[0]]
            n["value"], n["low"], n["high"] = n["low"], r[1], r[2]
        _cuts(rows, nodes, F.col("row"), pick == F.col("value"))
        split = _frame(spark, [(i, n["dim"], n["value"], n["low"], pending[i] // 2) for i, n in nodes.items()], "node long, dim long, value long, last long, half long")
        right = (pick > F.col("value")) | ((pick == F.col("value")) & (F.col("row") > F.col("last")))
        rows = rows.join(split, "node", "left").withColumn("node", F.when(right, F.col("node") + F.col("half")).otherwise(F.col("node"))).drop("dim", "value", "last", "half")
        pending = {k: v for i, n in pending.items() for k, v in (((i, n // 2), (i + n // 2, n - n // 2)) if n > 1 else ((i, n),))}
    groups = -(-count // GROUP_ROWS)
    placed = scratch.store(rows.select("row", "doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part")))
    counted = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = scratch.store(counted.select("shard", "part", before.alias("first")))
    slot = F.col("first") + F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    out = placed.join(small(offsets), ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
    scratch.drop(meta)
    return out
