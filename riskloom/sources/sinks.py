"""Writing predictions, comparisons and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import require_columns
from riskloom.schemas import ENTITY_KEY, LABEL, ROW_KEY, SCORE
from riskloom.session import keep_methods_compiled

TEST_PREDICTION_COLUMNS = (ROW_KEY, ENTITY_KEY, LABEL, "prediction", "probability")


def existing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns as far as they exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def prediction_columns(df: DataFrame, label: str = LABEL) -> list[str]:
    """Default columns of a prediction table; the label comes third where there is one."""
    keys = [ROW_KEY, ENTITY_KEY]
    outcome = [label] if label in df.columns else []
    return keys + outcome + ["prediction", SCORE, "probability"]


def save_predictions(
    predictions: DataFrame,
    output_path: str,
    columns: Sequence[str] | None = None,
    strict: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write predictions as Parquet.

    Wanted columns that do not exist are left out, or are an error if ``strict``.
    ``mode="append"`` adds a batch to an existing table.
    """
    wanted = list(columns) if columns is not None else prediction_columns(predictions)
    if strict:
        require_columns(predictions, wanted, "save_predictions")
    existing_columns(predictions, wanted).write.mode(mode).parquet(output_path)


def save_test_predictions(predictions: DataFrame, output_path: str) -> None:
    """Write the fixed five columns of a held-out evaluation."""
    save_predictions(predictions, output_path, TEST_PREDICTION_COLUMNS, strict=True)


def written(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame and read it back: one computation, whatever follows, and a short lineage.

    Filters on ``partition_by`` columns then read only the folders they need.
    """
    keep_methods_compiled(df.sparkSession)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_batch(df: DataFrame, path: str, batch: int | str, column: str = "batch") -> None:
    """Add a batch to a table, once however often it is delivered.

    Each batch has a folder of its own, and a delivery replaces what that folder holds and
    nothing else, so a retried batch leaves each row once. A retry has to bring the
    same rows: one without any rows leaves the folder as it is.
    """
    keyed = df.withColumn(column, F.lit(str(batch)))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def append_scored_batch(model: PipelineModel, batch: DataFrame, output_path: str, batch_id: int | str | None = None) -> None:
    """Score one batch and add it to the prediction table; with a ``batch_id`` a repeated call adds nothing twice."""
    from riskloom.operators.scoring import make_predictions

    scored = make_predictions(model, batch)
    if batch_id is None:
        save_predictions(scored, output_path, mode="append")
    else:
        append_batch(existing_columns(scored, prediction_columns(scored)), output_path, batch_id)


def save_comparison_results(comparison: DataFrame, output_path: str) -> None:
    comparison.write.mode("overwrite").parquet(output_path)


def save_model(model: PipelineModel, output_path: str) -> None:
    """Save a whole pipeline, so that it can be loaded and scored without other parts."""
    model.write().overwrite().save(output_path)


def load_model(spark: SparkSession, model_path: str) -> PipelineModel:
    return PipelineModel.read().session(spark).load(model_path)
