"""Running totals and exact quantiles that need no global sort in one task.

A window ordered over a whole group puts that group into one task. Here the order
column is cut into many ranges of about equal size; running totals are taken inside
each range, and the totals of the ranges before are added. The cut points come from
an approximate quantile pass and only decide how work is shared out: any cut points
give the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MIN_RANGES = 64


def range_count(df: DataFrame) -> int:
    """How many ranges to cut: a few per shuffle partition, so that it grows with the cluster."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(_MIN_RANGES, 4 * partitions)


def cut_points(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Increasing values that cut a numeric column into ranges with about equally many rows.

    One pass over this column; the driver receives at most ``ranges`` numbers,
    whatever the data size. NULL and NaN are left aside.
    """
    ranges = ranges or range_count(df)
    shares = [i / ranges for i in range(1, ranges)]
    values = df.select(F.col(column).cast("double").alias("value"))
    return sorted(set(values.approxQuantile("value", shares, 0.25 / ranges)))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    cuts: Sequence[float],
    descending: bool = False,
) -> DataFrame:
    """Add ``<name>_run`` and ``<name>_total`` for each column in ``sums``, per ``keys``.

    Rows must be unique in keys and ``order``, i.e. already grouped. ``_run`` is the
    total up to and including the row, in the given order; NULL orders come first
    when ascending and last when descending, as in Spark.

    Each range starts with a carry row holding the totals of the ranges before it,
    so the window needs no join with them. Carry rows also fill the remaining
    columns: both uses of ``df`` then need the same columns, and Spark computes and
    shuffles it once.
    """
    finite = [c for c in cuts if abs(c) != float("inf")] or [0.0]
    bounded = [-float("inf"), *finite, float("inf")]
    ranged = Bucketizer(splits=bounded, inputCol="_order", outputCol="_cut", handleInvalid="keep").transform(
        df.withColumn("_order", F.col(order).cast("double"))
    )
    ranged = ranged.withColumn("_range", F.coalesce(F.col("_cut"), F.lit(-1.0)).cast("int")).drop("_order", "_cut")

    direction = F.desc if descending else F.asc
    group = Window.partitionBy(*keys)
    before = group.orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
    rest = [c for c in df.columns if c not in {*keys, *sums, order}]
    per_range = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in rest]
    )
    carry = per_range.select(
        *keys,
        "_range",
        F.lit(True).alias("_carry"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums],
        *[F.sum(c).over(group).alias(f"{c}_total") for c in sums],
        *rest,
    )

    within = (
        Window.partitionBy(*keys, "_range")
        .orderBy(F.desc("_carry"), direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = ranged.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    running = rows.select(
        *df.columns,
        "_carry",
        *[F.sum(c).over(within).alias(f"{c}_run") for c in sums],
        *[F.first(f"{c}_total").over(within).alias(f"{c}_total") for c in sums],
    )
    return running.filter(~F.col("_carry")).drop("_carry")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    shares: Mapping[str, float],
    cuts: Sequence[float] | None = None,
    summaries: bool = False,
) -> DataFrame:
    """Exact quantiles per group, with linear interpolation between neighbours.

    One output column per entry of ``shares``. Equal values are counted together
    first, so that neither a frequent value nor a large group lands in one task.
    With ``summaries`` the columns ``n`` (all rows) and ``mean`` come along from the
    same counts. Groups without values have NULL quantiles.
    """
    if cuts is None:
        cuts = cut_points(df, column)
    counted = df.groupBy(*keys, F.col(column).cast("double").alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(column).alias("_n")
    )
    ranked = running_totals(counted, keys, "_value", ["_n"], cuts)

    picks = []
    for name, share in shares.items():
        rank = F.lit(float(share)) * (F.col("_n_total") - 1)
        for side, wanted in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (wanted < F.col("_n_run")) & (wanted >= F.col("_n_run") - F.col("_n"))
            picks.append(F.max(F.when(here, F.col("_value"))).alias(f"_{side}_{name}"))
        picks.append(F.max(rank - F.floor(rank)).alias(f"_part_{name}"))
    extra = []
    if summaries:
        extra = ["n", "mean"]
        weighted = F.sum(F.col("_value") * F.col("_n"))
        picks += [F.sum("_rows").alias("n"), F.try_divide(weighted, F.sum("_n")).alias("mean")]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in shares
        ],
        *extra,
    )
