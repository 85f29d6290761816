"""Distribution of scores, and drift of a distribution between two batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranking import exact_quantiles
from riskloom.schemas import LABEL, SCORE

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def score_description(predictions: DataFrame, score: str = SCORE, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of the score."""
    return predictions.groupBy(*by).agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("stddev"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )


def score_by_class(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
    exact: bool = False,
    accuracy: int = 1_000,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Row count, mean and quartiles of the score per actual class.

    Approximate quartiles come from one plain aggregation. Exact ones are ranked
    in many tasks, and all figures come from the same counts.
    """
    keys = [*by, label]
    basics = [F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n")]
    if not exact:
        approx = [F.percentile_approx(score, share, accuracy).alias(name) for name, share in QUARTILES.items()]
        return predictions.groupBy(*keys).agg(*basics, *approx)
    measured = exact_quantiles(predictions, keys, score, QUARTILES, cuts, summaries=True)
    return measured.select(*keys, F.col("mean").alias("mean_score"), "n", *QUARTILES)


def equal_width_bin(column: str, low: float, high: float, bins: int) -> Column:
    """Bin number 0..bins-1; values outside fall in the first or last bin, NULL stays NULL."""
    raw = F.floor((F.col(column) - low) / F.lit((high - low) / bins)).cast("int")
    return F.when(raw.isNotNull(), F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))


def drift_bins(
    baseline: DataFrame, current: DataFrame, bins: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Share of rows per column and bin in both batches.

    ``bins`` maps a name to its bin expression. Both batches are counted in one
    aggregation, so no join of the two sides is needed. NULL is a bin of its own.
    """
    entries = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column_name"), b.cast("string").alias("bin")) for n, b in bins.items()])
    )
    sides = baseline.select(*by, F.lit(1).alias("_base"), entries.alias("_e")).unionByName(
        current.select(*by, F.lit(0).alias("_base"), entries.alias("_e"))
    )
    counted = sides.groupBy(*by, F.col("_e.column_name").alias("column_name"), F.col("_e.bin").alias("bin")).agg(
        F.count_if(F.col("_base") == 1).alias("baseline_n"), F.count_if(F.col("_base") == 0).alias("current_n")
    )
    group = Window.partitionBy(*by, "column_name")
    return counted.withColumns({
        "baseline_share": F.try_divide("baseline_n", F.sum("baseline_n").over(group)),
        "current_share": F.try_divide("current_n", F.sum("current_n").over(group)),
    })


def population_stability(
    baseline: DataFrame,
    current: DataFrame,
    bins: Mapping[str, Column],
    by: Sequence[str] = (),
    floor: float = 1e-6,
) -> DataFrame:
    """Population stability index per column: sum of (p - q) * ln(p / q), empty shares floored."""
    shares = drift_bins(baseline, current, bins, by)
    p, q = (F.greatest(F.col(c), F.lit(floor)) for c in ("baseline_share", "current_share"))
    return shares.groupBy(*by, "column_name").agg(
        F.sum((p - q) * F.ln(p / q)).alias("psi"),
        F.sum("baseline_n").alias("baseline_n"),
        F.sum("current_n").alias("current_n"),
    )
