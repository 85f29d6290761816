"""Evaluating trained models on the held-out part."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from riskloom.functions import positive_probability
from riskloom.operators.comparison import ModelResult, comparison_frame, comparison_table, select_best_model, stack_predictions
from riskloom.operators.confusion import analyze_confusion_matrix, threshold_sweep
from riskloom.operators.distribution import score_by_class, score_description
from riskloom.operators.report import evaluation_report
from riskloom.operators.split import validate_data_leakage_prevention
from riskloom.schemas import SCORE


def with_score(predictions: DataFrame, score: str = SCORE) -> DataFrame:
    """Predictions with the class-1 probability as a plain column."""
    return predictions if score in predictions.columns else predictions.withColumn(score, positive_probability())


def evaluate_and_compare(
    results: Mapping[str, ModelResult], spark: SparkSession, selection_metric: str = "AUC_ROC"
) -> tuple[str, Any, DataFrame, DataFrame]:
    """Best model's name, model and predictions, and the comparison of all.

    Label, prediction and score of every row are kept on the executors while the
    models are measured, so that rows are scored once. The comparison, one row per
    model, is held as values.
    """
    narrow = stack_predictions(
        {name: with_score(result.predictions) for name, result in results.items()}
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        comparison = comparison_frame(spark, [row.asDict() for row in comparison_table(narrow).collect()])
    finally:
        narrow.unpersist()
    return (*select_best_model(comparison, results, selection_metric), comparison)


def run_comprehensive_tests(
    results: Mapping[str, ModelResult], spark: SparkSession, train_df: DataFrame, test_df: DataFrame
) -> dict[str, Any]:
    """Leakage check, comparison, and a closer look at the best model.

    The frames in the result are lazy, except the comparison. For large test parts
    hand in results whose predictions were written first (``training_run`` does).
    """
    no_leakage = validate_data_leakage_prevention(train_df, test_df)
    name, model, predictions, comparison = evaluate_and_compare(results, spark)
    detailed = with_score(predictions)
    cells, sensitivity, specificity = analyze_confusion_matrix(detailed, name)
    return {
        "best_model_name": name,
        "best_model": model,
        "best_predictions": predictions,
        "comparison_df": comparison,
        "confusion_matrix": cells,
        "sensitivity": sensitivity,
        "specificity": specificity,
        "predictions_detailed": detailed,
        "no_leakage": no_leakage,
        "score_description": score_description(detailed),
        "score_by_class": score_by_class(detailed),
        "threshold_sweep": threshold_sweep(detailed),
        "report": evaluation_report(stack_predictions({n: with_score(r.predictions) for n, r in results.items()})),
    }
