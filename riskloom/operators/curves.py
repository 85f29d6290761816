"""Exact ROC and precision-recall curves, and everything measured along a ranking.

Rows are first counted per model and distinct score, which makes ties right and
keeps frequent scores cheap; running totals then come from ``ranking``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.confusion import CELLS, cell_counts, positive_metrics, weighted_metrics
from riskloom.operators.ranking import cut_points, running_totals
from riskloom.schemas import LABEL, SCORE


def ranked_scores(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
    prediction: str | None = None,
) -> DataFrame:
    """One row per distinct score and group, best first: ``tp`` and ``fp`` down to that score.

    ``pos`` and ``neg`` are the rows with that score, ``tp_total`` and ``fp_total``
    all rows with a score. With ``prediction`` the confusion counts per score come
    along as ``cell_*``, then including rows without a score (whose pos and neg are 0).
    """
    if cuts is None:
        cuts = cut_points(predictions, score)
    ranked = F.col(score).isNotNull()
    counts = [
        F.count_if(ranked & (F.col(label) == 1)).alias("pos"),
        F.count_if(ranked & (F.col(label) == 0)).alias("neg"),
    ]
    if prediction:
        counts += [c.alias(f"cell_{cell}") for cell, c in zip(CELLS, cell_counts(label, F.col(prediction)))]
    else:
        predictions = predictions.filter(ranked)
    counted = predictions.groupBy(*by, F.col(score).alias("threshold")).agg(*counts)
    ranking = running_totals(counted, by, "threshold", ["pos", "neg"], cuts, descending=True)
    return ranking.withColumnsRenamed({
        "pos_run": "tp", "neg_run": "fp", "pos_total": "tp_total", "neg_total": "fp_total",
    })


def roc_points(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
    origin: bool = False,
) -> DataFrame:
    """True and false positive rate at each distinct score; NULL rate if a class is absent.

    ``origin=True`` adds the point (0, 0) per group, with an infinite threshold.
    """
    points = ranked_scores(predictions, label, score, by, cuts).select(
        *by, "threshold", "tp", "fp",
        F.try_divide("tp", "tp_total").alias("tpr"),
        F.try_divide("fp", "fp_total").alias("fpr"),
    )
    if not origin:
        return points
    groups = predictions.filter(F.col(score).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    start = groups.filter("_n > 0").select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("tp", "fp")],
        *[F.lit(0.0).alias(c) for c in ("tpr", "fpr")],
    )
    return points.unionByName(start)


def pr_points(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
    endpoint: bool = False,
) -> DataFrame:
    """Precision and recall at each distinct score.

    ``endpoint=True`` adds the point (precision 1, recall 0) per group, without a threshold.
    """
    points = ranked_scores(predictions, label, score, by, cuts).select(
        *by, "threshold", "tp", "fp",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "tp_total").alias("recall"),
    )
    if not endpoint:
        return points
    groups = predictions.filter(F.col(score).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    end = groups.filter("_n > 0").select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("tp", "fp")],
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def area_columns() -> dict[str, object]:
    """Aggregates over ``ranked_scores`` that give both areas; NULL if a class is absent.

    The point before a row is known from the row itself, so no second window is
    needed. Tied rows count half for the ROC area, which is its trapezoid; the PR
    area starts at recall 0 with the precision of the best score.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    pairs = F.max(F.col("tp_total").cast("double") * F.col("fp_total").cast("double"))
    roc = F.try_divide(F.sum(neg * (tp - pos / 2)), pairs)
    precision = F.try_divide(tp, tp + fp)
    precision_before = F.coalesce(F.try_divide(tp - pos, tp + fp - pos - neg), precision)
    pr = F.try_divide(
        F.sum(F.coalesce(pos * (precision + precision_before) / 2, F.lit(0.0))),
        F.max(F.col("tp_total").cast("double")),
    )
    return {"auc_roc": roc, "auc_pr": pr}


def curve_areas(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Area under the ROC and the precision-recall curve per group."""
    ranking = ranked_scores(predictions, label, score, by, cuts)
    return ranking.groupBy(*by).agg(*[c.alias(name) for name, c in area_columns().items()])


def evaluation_table(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    prediction: str = "prediction",
    by: Sequence[str] = ("model",),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Both areas, confusion counts and all metrics per group, from one ranking."""
    ranking = ranked_scores(predictions, label, score, by, cuts, prediction)
    measured = ranking.groupBy(*by).agg(
        *[c.alias(name) for name, c in area_columns().items()],
        *[F.sum(f"cell_{cell}").alias(cell) for cell in CELLS],
    )
    return measured.withColumns({**positive_metrics(), **weighted_metrics()})


def operating_point(points: DataFrame, by: Sequence[str] = (), target: float = 0.5) -> DataFrame:
    """The ROC point whose threshold is nearest to ``target``; on a tie the higher threshold."""
    nearest = F.struct(F.abs(F.col("threshold") - target), -F.col("threshold"))
    chosen = points.groupBy(*by).agg(F.min_by(F.struct("threshold", "tp", "fp", "tpr", "fpr"), nearest).alias("_p"))
    return chosen.select(*by, "_p.*")
