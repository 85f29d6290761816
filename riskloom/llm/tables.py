"""Spark helpers of the corpus operators: tables in the shared folder, checked broadcasts, components."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

#: Rows of a few numbers each that may be broadcast: at most some tens of MB.
BROADCAST_ROWS = 500_000
#: Rows of an Arrow batch: Spark's default, one for whole texts, of which 10,000 take tens of MB in the JVM and in Python,
#: and one for rows that are packed tables of some tens of KB.
BATCH, SPARK_BATCH_ROWS, TEXT_BATCH_ROWS, PACKED_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "500", "200"


class Scratch:
    """Intermediate tables of one run, as Parquet below ``spark.checkpoint.dir``.

    They survive lost executors, cut the lineage, and are dropped one by one as soon
    as no later step reads them.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self._count = spark, scratch_path(spark, name), 0
        self._paths: dict[int, str] = {}

    def store(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for frame in frames:
            path = self._paths.pop(id(frame), None)
            if path:
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that are no longer referred to."""
    gc.collect()
    spark._jvm.System.gc()


def text_batches(spark: SparkSession) -> None:
    """From now on hands rows to Python in batches small enough for whole texts, unless the session has a size of its own."""
    if spark.conf.get(BATCH) == SPARK_BATCH_ROWS:
        spark.conf.set(BATCH, TEXT_BATCH_ROWS)


@contextmanager
def narrow_batches(spark: SparkSession, size: str = SPARK_BATCH_ROWS) -> Iterator[None]:
    """While tables of a few numbers a row are made: Spark's batches again, if :func:`text_batches` made them small, or batches of another size."""
    rows = spark.conf.get(BATCH)
    if rows in (TEXT_BATCH_ROWS, SPARK_BATCH_ROWS):
        spark.conf.set(BATCH, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH, rows)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves it small; else as it is, for a shuffled join.

    Meant for stored tables of a few narrow columns, where counting reads only footers.
    """
    return F.broadcast(df) if df.count() <= rows else df


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): root is the smallest node that can be reached.

    Alternates large-star and small-star rounds; each round is stored, and the number
    of rounds grows with the logarithm of the longest path. A node's star is held by
    window functions, so a hub with a third of all nodes needs no list of them.
    """
    link = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    link = scratch.store(link.filter("a <> b").distinct())
    state = _fingerprint(link)
    while state[0]:
        both = link.unionByName(link.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(floor, "a")
        step = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        after = scratch.store(step.filter("a <> b").distinct())
        scratch.drop(link)
        link, before, state = after, state, _fingerprint(after)
        if state == before:
            break
    roots = link.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return scratch.store(link.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots))


def _fingerprint(link: DataFrame) -> tuple:
    return tuple(link.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
