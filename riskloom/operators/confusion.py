"""Confusion counts, class metrics and threshold sweeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import flag, safe_ratio
from riskloom.schemas import LABEL, SCORE, SWEEP_THRESHOLDS

CELLS = {"tp": (1, 1), "tn": (0, 0), "fp": (0, 1), "fn": (1, 0)}  # (label, prediction)


def cell_counts(label: str, prediction: Column) -> list[Column]:
    return [
        F.count_if((F.col(label) == actual) & (prediction == predicted)).alias(cell)
        for cell, (actual, predicted) in CELLS.items()
    ]


def confusion_counts(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """tp, tn, fp, fn in one pass, for the whole frame or per group (e.g. per model)."""
    return predictions.groupBy(*by).agg(*cell_counts(label, F.col(prediction)))


def label_prediction_counts(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    keys = [*by, label, prediction]
    return predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys)


def _f1(precision: Column, recall: Column) -> Column:
    return safe_ratio(2 * precision * recall, precision + recall)


def positive_metrics() -> dict[str, Column]:
    """Metrics of class 1 from the four counts; 0 where the divisor is 0."""
    tp, tn, fp, fn = (F.col(c) for c in CELLS)
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    return {
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
        "precision_pos": precision,
        "recall_pos": recall,
        "f1_pos": _f1(precision, recall),
    }


def weighted_metrics() -> dict[str, Column]:
    """Metrics of both classes from the four counts, averaged by class size."""
    tp, tn, fp, fn = (F.col(c) for c in CELLS)
    total = tp + tn + fp + fn
    share = {1: safe_ratio(tp + fn, total), 0: safe_ratio(tn + fp, total)}
    precision = {1: safe_ratio(tp, tp + fp), 0: safe_ratio(tn, tn + fn)}
    recall = {1: safe_ratio(tp, tp + fn), 0: safe_ratio(tn, tn + fp)}
    f1 = {c: _f1(precision[c], recall[c]) for c in (0, 1)}
    return {
        f"weighted_{name}": share[0] * metric[0] + share[1] * metric[1]
        for name, metric in (("precision", precision), ("recall", recall), ("f1", f1))
    }


def class_metrics(counts: DataFrame) -> DataFrame:
    """Add to confusion counts: class-1 metrics, weighted metrics, sensitivity and specificity."""
    tp, tn, fp, fn = (F.col(c) for c in CELLS)
    return counts.withColumns({
        **positive_metrics(),
        **weighted_metrics(),
        "sensitivity": safe_ratio(tp, tp + fn),
        "specificity": safe_ratio(tn, tn + fp),
    })


def calculate_confusion_matrix(
    predictions: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> dict[str, int]:
    return confusion_counts(predictions, label, prediction).first().asDict()


def analyze_confusion_matrix(
    predictions: DataFrame, model_name: str = "", label: str = LABEL, prediction: str = "prediction"
) -> tuple[dict[str, int], float, float]:
    """The four counts, sensitivity and specificity."""
    row = class_metrics(confusion_counts(predictions, label, prediction)).first()
    return {cell: row[cell] for cell in CELLS}, row["sensitivity"], row["specificity"]


def relabel(score: str, threshold: float) -> Column:
    """Class at a threshold; a NULL score is class 0."""
    return flag(F.col(score) >= threshold)


def threshold_sweep(
    predictions: DataFrame,
    thresholds: Sequence[float] = SWEEP_THRESHOLDS,
    label: str = LABEL,
    score: str = SCORE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts, precision, recall and F1 of class 1 for each threshold.

    Rows are counted once, by the number of thresholds they reach; the counts per
    threshold are then summed from these few groups.
    """
    ordered = sorted(set(thresholds))
    reached = sum((relabel(score, t) for t in ordered), F.lit(0))
    grouped = predictions.groupBy(*by, reached.alias("_reached")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    steps = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("t")) for i, t in enumerate(ordered)])
    )
    above = F.col("_reached") > F.col("_step.i")

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    counts = grouped.withColumn("_step", steps).groupBy(*by, F.col("_step.t").alias("threshold")).agg(
        total(above, "_pos").alias("tp"),
        total(~above, "_neg").alias("tn"),
        total(above, "_neg").alias("fp"),
        total(~above, "_pos").alias("fn"),
    )
    metrics = positive_metrics()
    return counts.withColumns({
        "precision": metrics["precision_pos"], "recall": metrics["recall_pos"], "f1": metrics["f1_pos"],
    })
