"""Scoring with a saved pipeline, and working with scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import percent, positive_probability, risk_band
from riskloom.schemas import HIGH_RISK_THRESHOLD, RISK_BANDS, ROW_KEY, SCORE
from riskloom.session import keep_methods_compiled


def make_predictions(
    model: Transformer, data: DataFrame, include_probability: bool = True, score: str = SCORE
) -> DataFrame:
    """Apply a fitted pipeline and add the probability of class 1."""
    keep_methods_compiled(data.sparkSession)
    predictions = model.transform(data)
    return predictions.withColumn(score, positive_probability()) if include_probability else predictions


def missing_feature_rows(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows a model skips: those with NULL in one of the columns it assembles. No join."""
    absent = F.lit(False)
    for column in columns:
        absent = absent | F.col(column).isNull()
    return data.filter(absent)


def unscored_rows(data: DataFrame, predictions: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Rows of one table without a prediction in another, by key; see ``missing_feature_rows`` for one table."""
    return data.join(predictions.select(key), key, "left_anti")


def get_prediction_summary(
    predictions: DataFrame, target_col: str | None = None, score: str = SCORE, by: Sequence[str] = ()
) -> DataFrame:
    """Rows and mean score in percent per predicted class, and the actual rate if there is a label."""
    measures = [
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(score) * 100, 2).alias("avg_probability_pct"),
    ]
    if target_col and target_col in predictions.columns:
        measures.append(F.round(F.avg(target_col) * 100, 2).alias("actual_readmit_rate_pct"))
    return predictions.groupBy(*by, "prediction").agg(*measures)


def filter_high_risk_patients(
    predictions: DataFrame, threshold: float = HIGH_RISK_THRESHOLD, score: str = SCORE
) -> DataFrame:
    """Rows at or above the threshold."""
    return predictions.filter(F.col(score) >= threshold)


def high_risk_report(
    predictions: DataFrame, threshold: float = HIGH_RISK_THRESHOLD, score: str = SCORE, by: Sequence[str] = ()
) -> DataFrame:
    """Rows at or above the threshold, all rows, and the share in percent (0 for no rows)."""
    counts = predictions.groupBy(*by).agg(
        F.count_if(F.col(score) >= threshold).alias("high_risk"), F.count(F.lit(1)).alias("total")
    )
    return counts.withColumn("high_risk_pct", percent(F.col("high_risk"), F.col("total")))


def with_risk_band(predictions: DataFrame, score: str = SCORE, bands=RISK_BANDS, column: str = "risk_band") -> DataFrame:
    return predictions.withColumn(column, risk_band(score, bands))
