"""Scoring streams, and counting high-risk rows per time window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.scoring import make_predictions
from riskloom.schemas import HIGH_RISK_THRESHOLD, SCORE
from riskloom.sources.sinks import append_batch


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files in a folder (or matching a glob) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(model: Transformer, stream: DataFrame, score: str = SCORE) -> DataFrame:
    """Score a stream; rows with missing features are skipped as in batch."""
    return make_predictions(model, stream, score=score)


def high_risk_by_window(
    scored: DataFrame,
    at: str,
    threshold: float = HIGH_RISK_THRESHOLD,
    score: str = SCORE,
    window: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """Rows and high-risk rows per tumbling window; rows later than ``delay`` are dropped on a stream.

    ``at`` must be a timestamp: cast a timestamp without zone first. State is one
    row per open window, whatever the number of rows.
    """
    counted = scored.withWatermark(at, delay).groupBy(F.window(at, window).alias("_w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(score) >= threshold).alias("high_risk")
    )
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n_rows", "high_risk"
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder; the checkpoint makes a restart continue exactly once.

    By default takes what is there and stops; ``every`` (e.g. ``"1 minute"``) keeps running.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def write_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hand each micro-batch and its number to ``write``, at least once.

    A batch whose writing was cut short comes again with the same number and rows. With
    ``batch_writer`` as ``write`` the table still holds each row once; any number of
    such tables can be fed by one query, and rewritten later batch by batch.
    """
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def batch_writer(path: str, run: str = "stream") -> Callable[[DataFrame, int], None]:
    """Writes micro-batches below ``path``, each in a folder of its own; ``run`` tells streams with other checkpoints apart."""
    return lambda batch, number: append_batch(batch, path, f"{run}-{number}")
