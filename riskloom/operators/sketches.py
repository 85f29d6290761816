"""Quantiles from stored sketches, which merge later without the rows they came from.

A sketch is a few kilobytes whatever the number of rows. Per part of a table (a day, a
batch, a file) one sketch per column is stored; any set of parts is later merged, and
asked for any quantile, by reading sketches alone. With ``k`` the rank of an answer is off
by about 2.3 / k of the rows (1.3 % for the default 200).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and the share of rows by which a rank may be off (twice the standard figure for it).
SKETCH_K = 200
RANK_ERROR = 0.03


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """A row per group and column: ``by``, column_name, n (non-NULL values), sketch (NULL for no values).

    One aggregation of all columns; NULL and NaN values are left out.
    """
    numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    held = [F.struct(F.count(v).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch")).alias(f"_{c}") for c, v in numbers.items()]
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}.n").alias("n"), F.col(f"_{c}.sketch").alias("sketch")) for c in columns]
    rows = df.groupBy(*by).agg(*held).select(*by, F.explode(F.array(*entries)).alias("_e"))
    return rows.select(*by, "_e.column_name", "_e.n", F.when(F.col("_e.n") > 0, F.col("_e.sketch")).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of fewer, larger groups, from the sketches alone."""
    return sketches.filter("n > 0").groupBy(*by, "column_name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """A column per wanted quantile; NULL where a group has no values."""
    return sketches.select(
        *by, "column_name", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias(name) for name, share in shares.items()]
    )


def rank_errors(df: DataFrame, quantiles: DataFrame, shares: Mapping[str, float], columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How far the exact ranks of given quantiles are from their shares: by, column_name, quantile, error (share of rows).

    An answer covers all ranks of its value, so the error is 0 if the share lies among them.
    """
    wanted = quantiles.select(*by, "column_name", F.explode(F.array(*[
        F.struct(F.lit(name).alias("quantile"), F.lit(share).alias("share"), F.col(name).alias("answer")) for name, share in shares.items()
    ])).alias("_q")).select(*by, "column_name", "_q.*")
    values = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("_v")).select(*by, "_v.*").filter("value IS NOT NULL AND NOT isnan(value)")
    counted = values.groupBy(*by, "column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
    both = counted.join(F.broadcast(wanted), [*by, "column_name"])
    n = F.sum("_n")
    low = F.sum(F.when(F.col("value") < F.col("answer"), F.col("_n")).otherwise(0)) / n
    high = F.sum(F.when(F.col("value") <= F.col("answer"), F.col("_n")).otherwise(0)) / n
    error = F.greatest(low - F.col("share"), F.col("share") - high, F.lit(0.0))
    return both.groupBy(*by, "column_name", "quantile", "share").agg(error.alias("error"))
