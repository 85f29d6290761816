"""Late rows of windowed streams: deliveries replayed in order, and the watermark rule as a batch.

A windowed count drops a row if its window closed before the delivery that holds it: if the
window ends at or before the largest time of all earlier deliveries less the delay. The rule
is stated here once as a batch operator, so that a finished stream can be completed with
the windows that are still open, and held against what arrived.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.schemas import HIGH_RISK_THRESHOLD, SCORE
from riskloom.streaming.scoring import high_risk_by_window


def replay(deliveries: Iterable[DataFrame], folder: str, start: Callable[[], StreamingQuery]) -> int:
    """Add each delivery to the folder that a stream reads and run the stream until it has taken it.

    Every run is a new query on the same checkpoint, as after a stop or a lost driver, so
    state and watermark are carried from one delivery to the next. Returns the number of deliveries.
    """
    n = 0
    for n, rows in enumerate(deliveries, 1):
        rows.write.mode("append").parquet(folder)
        start().awaitTermination()
    return n


def _less(time: Column, delay: str) -> Column:
    return time - F.expr(f"INTERVAL {delay}")


def mark_late(rows: DataFrame, at: str, delivery: str, window: str = "1 day", delay: str = "1 day", column: str = "late") -> DataFrame:
    """Rows with a flag: would a windowed count that got the deliveries in their order have dropped the row?

    Deliveries are summed up to a row each first; only those rows are ordered.
    """
    closed = F.max("_latest").over(Window.orderBy(delivery).rowsBetween(Window.unboundedPreceding, -1))
    marks = rows.groupBy(delivery).agg(F.max(at).alias("_latest")).select(
        F.col(delivery).alias("_delivery"), _less(closed, delay).alias("_mark")
    )
    ends = F.window(at, window)["end"]
    flagged = rows.join(marks, F.col(delivery) == F.col("_delivery"))
    return flagged.withColumn(column, F.coalesce(ends <= F.col("_mark"), F.lit(False))).drop("_delivery", "_mark")


def open_windows(
    scored: DataFrame, at: str, threshold: float = HIGH_RISK_THRESHOLD, score: str = SCORE, window: str = "1 day", delay: str = "1 day"
) -> DataFrame:
    """Counts of the windows that a stream over all these rows has not closed yet: those that end after the watermark.

    Rows that the stream dropped must not be among the given ones (see ``mark_late``).
    """
    latest = scored.agg(F.max(at).alias("latest")).first()["latest"]
    counted = high_risk_by_window(scored, at, threshold, score, window, delay)
    return counted.filter(F.col("window_end") > _less(F.lit(latest).cast(scored.schema[at].dataType), delay))


def late_report(emitted: DataFrame, rows: DataFrame, at: str, window: str = "1 day") -> DataFrame:
    """Per window that a stream emitted: rows it counted, rows that arrived in all, and the difference, which it dropped."""
    arrived = rows.groupBy(F.window(at, window).alias("_w")).agg(F.count(F.lit(1)).alias("n_arrived"))
    arrived = arrived.select(F.col("_w.start").alias("window_start"), "n_arrived")
    return emitted.join(arrived, "window_start", "left").withColumn("n_dropped", F.col("n_arrived") - F.col("n_rows"))
