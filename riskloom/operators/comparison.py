"""Comparing models and choosing one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.confusion import calculate_confusion_matrix
from riskloom.operators.curves import evaluation_table
from riskloom.schemas import COMPARISON_SCHEMA, LABEL, RETRAIN_BELOW_AUC, SCORE, SELECTION_METRICS
from riskloom.session import local_frame


@dataclass(frozen=True)
class ModelResult:
    """A fitted model and its (lazy) predictions."""

    model: Any
    predictions: DataFrame


def create_evaluators(label: str = LABEL, num_bins: int = 0) -> dict[str, Any]:
    """The MLlib evaluators of the six metrics; ``num_bins=0`` keeps every distinct score."""
    evaluators: dict[str, Any] = {
        name: BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol="rawPrediction", metricName=metric, numBins=num_bins
        )
        for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR"))
    }
    for name, metric in (
        ("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"),
    ):
        evaluators[name] = MulticlassClassificationEvaluator(
            labelCol=label, predictionCol="prediction", metricName=metric
        )
    return evaluators


def stack_predictions(
    predictions: Mapping[str, DataFrame], columns: Sequence[str] = (LABEL, "prediction", SCORE), name: str = "model"
) -> DataFrame:
    """One long frame of several models' predictions, with the model name in front."""
    frames = [df.select(F.lit(model).alias(name), *columns) for model, df in predictions.items()]
    if not frames:
        raise ValueError("no predictions to stack")
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def comparison_table(
    stacked: DataFrame,
    label: str = LABEL,
    score: str = SCORE,
    prediction: str = "prediction",
    model: str = "model",
    digits: int = 4,
) -> DataFrame:
    """One row per model: six rounded metrics and the four counts."""
    measured = evaluation_table(stacked, label, score, prediction, [model])
    metrics = {
        "AUC_ROC": "auc_roc", "AUC_PR": "auc_pr", "Accuracy": "accuracy", "F1_Score": "weighted_f1",
        "Precision": "weighted_precision", "Recall": "weighted_recall",
    }
    counts = {"True_Positives": "tp", "True_Negatives": "tn", "False_Positives": "fp", "False_Negatives": "fn"}
    return measured.select(
        F.col(model).alias("Model"),
        *[F.round(F.col(c), digits).alias(name) for name, c in metrics.items()],
        *[F.col(c).alias(name) for name, c in counts.items()],
    )


def evaluate_model(
    predictions: DataFrame, model_name: str, evaluators: Mapping[str, Any] | None = None, score: str = SCORE
) -> dict[str, Any]:
    """The six metrics of one model, rounded to four places.

    Without ``evaluators`` they come from one ranking; given evaluators are run one by one.
    """
    if evaluators is not None:
        return {"model": model_name} | {
            name: round(evaluator.evaluate(predictions), 4) for name, evaluator in evaluators.items()
        }
    row = comparison_table(stack_predictions({model_name: predictions}, (LABEL, "prediction", score)), score=score).first()
    if row is None:
        raise ValueError(f"model {model_name!r} has no predictions to evaluate")
    names = {
        "auc_roc": "AUC_ROC", "auc_pr": "AUC_PR", "accuracy": "Accuracy",
        "f1": "F1_Score", "precision": "Precision", "recall": "Recall",
    }
    return {"model": model_name} | {name: row[column] for name, column in names.items()}


def comparison_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Comparison rows held on the driver as a DataFrame; an unknown metric is None."""
    return local_frame(spark, rows, COMPARISON_SCHEMA)


def compare_models(
    results: Mapping[str, ModelResult],
    spark: SparkSession,
    evaluators: Mapping[str, Any] | None = None,
    score: str = SCORE,
) -> DataFrame:
    """Comparison of all models, one row each.

    All models are measured together unless evaluators are given.
    """
    if evaluators is None:
        stacked = stack_predictions(
            {name: result.predictions for name, result in results.items()}, (LABEL, "prediction", score)
        )
        return comparison_table(stacked, score=score)
    rows = []
    for name, result in results.items():
        m = evaluate_model(result.predictions, name, evaluators)
        cells = calculate_confusion_matrix(result.predictions)
        rows.append({
            "Model": name, "AUC_ROC": m.get("auc_roc"), "AUC_PR": m.get("auc_pr"), "Accuracy": m.get("accuracy"),
            "F1_Score": m.get("f1"), "Precision": m.get("precision"), "Recall": m.get("recall"),
            "True_Positives": cells["tp"], "True_Negatives": cells["tn"],
            "False_Positives": cells["fp"], "False_Negatives": cells["fn"],
        })
    return comparison_frame(spark, rows)


def best_model(comparison: DataFrame, metric: str = "AUC_ROC") -> DataFrame:
    """The row with the highest metric; on a tie the first name, and a missing metric last."""
    if metric not in SELECTION_METRICS:
        raise ValueError(f"unknown selection metric {metric!r}; use one of {SELECTION_METRICS}")
    return comparison.orderBy(F.desc_nulls_last(metric), F.asc("Model")).limit(1)


def select_best_model(
    comparison: DataFrame, results: Mapping[str, ModelResult], metric: str = "AUC_ROC"
) -> tuple[str, Any, DataFrame]:
    """Name, model and predictions of the best model."""
    row = best_model(comparison, metric).first()
    if row is None:
        raise ValueError("the comparison is empty")
    chosen = results[row["Model"]]
    return row["Model"], chosen.model, chosen.predictions


def model_row(comparison: DataFrame, name: str) -> Row:
    """The comparison row of one model."""
    row = comparison.filter(F.col("Model") == name).first()
    if row is None:
        raise ValueError(f"model {name!r} is not in the comparison")
    return row


def comparison_long(
    comparison: DataFrame, metrics: Sequence[str] = SELECTION_METRICS
) -> DataFrame:
    """One row per model and metric."""
    return comparison.unpivot("Model", list(metrics), "metric", "value")


def champion_challenger(
    comparison: DataFrame, champion: str, metric: str = "AUC_ROC", retrain_below: float = RETRAIN_BELOW_AUC
) -> DataFrame:
    """Each other model against the champion: difference, promote, and whether to retrain.

    Retraining is due when even the better of the two stays below the bound.
    """
    everyone = Window.partitionBy()  # one row per model
    held = F.max(F.when(F.col("Model") == champion, F.col(metric))).over(everyone)
    pairs = comparison.select(
        F.lit(champion).alias("champion"), F.col("Model").alias("challenger"),
        held.alias("champion_value"), F.col(metric).alias("challenger_value"),
    ).filter(F.col("challenger") != champion)
    delta = F.col("challenger_value") - F.col("champion_value")
    return pairs.select(
        "*",
        F.round(delta, 4).alias("delta"),
        (delta > 0).alias("promote"),
        (F.greatest("champion_value", "challenger_value") < retrain_below).alias("retrain"),
    )
