"""The data behind evaluation charts, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from riskloom.operators.comparison import comparison_long
from riskloom.operators.confusion import label_prediction_counts
from riskloom.operators.curves import operating_point, pr_points, roc_points
from riskloom.operators.ranking import cut_points
from riskloom.operators.split import base_rate, class_distribution
from riskloom.operators.training import feature_importance
from riskloom.plans.evaluation import with_score
from riskloom.schemas import LABEL, SCORE


def chart_tables(
    test_results: Mapping[str, Any],
    feature_names: Sequence[str] | None = None,
    importance: Sequence[float] | None = None,
    n: int = 15,
) -> dict[str, DataFrame]:
    """Tables for the curves, the matrix, the bars and the importances of the best model."""
    predictions = with_score(test_results["best_predictions"]).select(LABEL, "prediction", SCORE)
    cuts = cut_points(predictions, SCORE)
    roc = roc_points(predictions, cuts=cuts, origin=True)
    tables = {
        "roc_curve": roc,
        "roc_operating_point": operating_point(roc.filter("threshold <> double('infinity')")),
        "precision_recall_curve": pr_points(predictions, cuts=cuts, endpoint=True),
        "base_rate": base_rate(predictions),
        "confusion_matrix": label_prediction_counts(predictions),
        "model_comparison": comparison_long(test_results["comparison_df"]),
        "class_distribution": class_distribution(predictions),
    }
    if feature_names is not None and importance is not None:
        tables["feature_importance"] = feature_importance(predictions.sparkSession, feature_names, importance, n)
    return tables


def save_chart_tables(tables: Mapping[str, DataFrame], output_path: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/{name}")
