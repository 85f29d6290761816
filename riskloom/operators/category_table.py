"""Category indexes kept in a table, for columns with more values than a driver should hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path
from riskloom.sources.sinks import written


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, n of all values but NULL, in one aggregation."""
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(entries.alias("_e")).select("_e.*").filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, n, idx: values numbered from 0 by falling frequency, ties by value.

    The values are sorted by ranges: each range is numbered in a task of its own, and starts
    with the number of values in the ranges before it. No list of values leaves the
    executors, and no task holds the values of a whole column.
    """
    spark = df.sparkSession
    order = ["column_name", F.desc("n"), "value"]
    # the ranges are stored with their rows, so that they are cut once
    ranged = category_counts(df, columns).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    stored = written(ranged, scratch_path(spark, "categories"))
    before = Window.partitionBy("column_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("column_name", "_range").agg(F.count(F.lit(1)).alias("_size"))  # a row per range and column
    starts = sizes.select("column_name", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("column_name", "_range").orderBy(F.desc("n"), "value")) - 1
    numbered = stored.withColumn("_within", within).join(starts, ["column_name", "_range"])
    return numbered.select("column_name", "value", "n", (F.col("_start") + F.col("_within")).cast("long").alias("idx"))


def save_categories(table: DataFrame, path: str) -> None:
    """One folder per column, so that indexing one column reads only its values."""
    table.write.mode("overwrite").partitionBy("column_name").parquet(path)


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_categories(df: DataFrame, table: DataFrame, columns: Sequence[str], suffix: str = "_indexed") -> DataFrame:
    """Rows with an index per column; a NULL or a value not in the table gets the number of the column's values.

    A join per column. Spark broadcasts a column's values if they are small; else both
    sides move by value, and adaptive execution splits a value that many rows share.
    """
    sizes = {r["column_name"]: r["n"] for r in table.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}

    def one(rows: DataFrame, column: str) -> DataFrame:
        values = table.filter(F.col("column_name") == column).select(F.col("value").alias("_value"), F.col("idx").alias("_idx"))
        joined = rows.join(values, F.col(column).cast("string") == F.col("_value"), "left")
        return joined.withColumn(f"{column}{suffix}", F.coalesce("_idx", F.lit(sizes.get(column, 0)))).drop("_value", "_idx")

    return reduce(one, columns, df)
