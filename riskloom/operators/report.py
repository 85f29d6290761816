"""Everything about scored models that follows from counts, in one long table and one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import percent, safe_ratio
from riskloom.operators.confusion import CELLS, positive_metrics, relabel, weighted_metrics
from riskloom.schemas import LABEL, SCORE, SWEEP_THRESHOLDS

#: Squares are summed around the middle of the score's range, which keeps their digits.
_CENTRE = 0.5


def _spread() -> Column:
    """Sample standard deviation from the sums; NULL for fewer than two scores."""
    n, s, q = F.col("n_scored"), F.col("_sum"), F.col("_squares")
    return F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))


def _values(metrics: Mapping[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()])


def evaluation_report(
    predictions: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    prediction: str = "prediction",
    model: str = "model",
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
) -> DataFrame:
    """section, model, key, metric, value: per model, per model and class, and per model and threshold.

    ``predictions`` is the long frame of all models. Its rows are counted once, by model,
    label, prediction and number of thresholds reached; that table (a few dozen rows a
    model) is then rolled up by grouping sets. A NULL score reaches no threshold; rows
    without a label make a class of their own and no cell.
    """
    ordered = sorted(set(thresholds))
    reached = sum((relabel(score, t) for t in ordered), F.lit(0))
    shifted = F.col(score) - _CENTRE
    cells = predictions.groupBy(model, F.col(label).alias("_label"), F.col(prediction).alias("_predicted"), reached.alias("_reached")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(score).alias("_scored"), F.sum(shifted).alias("_s"), F.sum(shifted * shifted).alias("_q"),
        F.min(score).alias("_low"), F.max(score).alias("_high"),
    )
    # step -1 stands for the model's own predictions
    steps = F.explode(F.sequence(F.lit(-1), F.lit(len(ordered) - 1)))
    called = F.when(F.col("step") < 0, F.col("_predicted")).otherwise((F.col("_reached") > F.col("step")).cast("int"))
    counted = cells.withColumn("step", steps).withColumns({"_called": called, "_actual": F.col("_label")})
    totals = [
        F.coalesce(F.sum(F.when((F.col("_actual") == a) & (F.col("_called") == p), F.col("_n"))), F.lit(0)).alias(cell)
        for cell, (a, p) in CELLS.items()
    ]
    rolled = counted.groupingSets([[model, "step"], [model, "step", "_label"]], model, "step", "_label").agg(
        *totals, F.grouping("_label").alias("_whole"), F.sum("_n").alias("n"), F.sum("_scored").alias("n_scored"),
        F.sum("_s").alias("_sum"), F.sum("_q").alias("_squares"), F.min("_low").alias("min"), F.max("_high").alias("max"),
        F.sum(F.when(F.col("_actual") == 1, F.col("_n")).otherwise(0)).alias("n_positive"),
    )
    tp, tn, fp, fn = (F.col(c) for c in CELLS)
    scores = {
        "n": F.col("n"), "n_scored": F.col("n_scored"), "mean": F.try_divide("_sum", "n_scored") + _CENTRE, "stddev": _spread(),
        "min": F.col("min"), "max": F.col("max"),
    }
    positive = positive_metrics()
    whole, own = F.col("_whole") == 1, F.col("step") < 0
    threshold = F.get(F.array(*[F.lit(float(t)) for t in ordered]).cast("array<double>"), F.col("step"))
    cell_values = {c: F.col(c) for c in CELLS}
    of_model = scores | cell_values | positive | weighted_metrics() | {
        "sensitivity": safe_ratio(tp, tp + fn), "specificity": safe_ratio(tn, tn + fp), "positive_pct": percent(F.col("n_positive"), F.col("n")),
    }
    of_threshold = cell_values | {"precision": positive["precision_pos"], "recall": positive["recall_pos"], "f1": positive["f1_pos"]}
    values = F.when(own & whole, _values(of_model)).when(own, _values(scores)).otherwise(_values(of_threshold))
    listed = rolled.filter(own | whole).select(
        F.when(own & whole, "model").when(own, "class").otherwise("threshold").alias("section"),
        model,
        F.when(own & ~whole, F.col("_label").cast("string")).when(~own, threshold.cast("string")).alias("key"),
        F.explode(values).alias("_m"),
    )
    return listed.select("section", model, "key", "_m.metric", "_m.value")
