"""Late rows, replayed deliveries and batches that come twice."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from riskloom.sources.sinks import append_batch
from riskloom.streaming import high_risk_by_window, late_report, mark_late, open_windows, read_stream, replay, write_stream

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frame(spark, rows):
    """(hours after the start, delivery, score)"""
    return spark.createDataFrame([(ZERO + timedelta(hours=h), d, s) for h, d, s in rows], "at timestamp, delivery int, score double")


def judged(rows, delay=24):
    """The watermark rule, row by row."""
    out = []
    for h, d, s in rows:
        before = [x for x, e, _ in rows if e < d]
        end = (h // 24 + 1) * 24
        out.append((h, d, s, bool(before) and end <= max(before) - delay))
    return out


ROWS = [(1, 0, 0.9), (30, 0, 0.2), (60, 0, 0.6), (72, 1, 0.5), (130, 1, 0.1), (2, 2, 0.9), (100, 2, 0.8), (106, 2, 0.8), (47, 2, 0.3), (150, 3, 0.7), (106, 3, 0.9), (129, 4, 0.9)]


def test_marking_equals_the_rule(spark):
    found = mark_late(frame(spark, ROWS), "at", "delivery").collect()
    hours = lambda t: round((t.replace(tzinfo=timezone.utc) - ZERO).total_seconds() / 3600)
    assert sorted((hours(r.at), r.delivery, r.score, r.late) for r in found) == sorted(judged(ROWS))


def test_replayed_stream_drops_what_the_rule_says(spark, tmp_path):
    rows = frame(spark, ROWS)
    source, out, checkpoint = (f"{tmp_path}/{name}" for name in ("in", "out", "checkpoint"))

    def start():
        stream = read_stream(spark, source, rows.schema)
        return write_stream(high_risk_by_window(stream, "at", score="score"), out, checkpoint)

    assert replay((rows.filter(F.col("delivery") == d) for d in range(5)), source, start) == 5
    emitted = spark.read.parquet(out)
    in_time = mark_late(rows, "at", "delivery").filter("NOT late")
    late = {}
    for h, _, _, dropped in judged(ROWS):
        late[h // 24] = late.get(h // 24, 0) + dropped
    day = F.datediff(F.col("window_start"), F.lit(ZERO.date())).alias("day")
    found = {r.day: r for r in late_report(emitted, rows, "at").select(day, "n_rows", "high_risk", "n_dropped").collect()}
    assert sorted(found) == [0, 1, 2, 3, 4] and {d: r.n_dropped for d, r in found.items()} == {d: late[d] for d in found}
    still = [r.day for r in open_windows(in_time, "at", score="score").select(day).collect()]
    assert sorted(still) == [5, 6]
    whole = {r.day: (r.n_rows, r.high_risk) for r in high_risk_by_window(in_time, "at", score="score").select(day, "n_rows", "high_risk").collect()}
    assert {d: (r.n_rows, r.high_risk) for d, r in found.items()} == {d: whole[d] for d in found}


def test_a_batch_that_comes_twice_counts_once(spark, tmp_path):
    path, one, two = f"{tmp_path}/t", spark.range(10), spark.range(10, 15)
    for rows, batch in ((one, 0), (two, 1), (one, 0), (two, 1), (one, 0)):
        append_batch(rows, path, batch)
    assert sorted((r.id, r.n) for r in spark.read.parquet(path).groupBy("id").agg(F.count("*").alias("n")).collect()) == [(i, 1) for i in range(15)]
    append_batch(one.limit(0), path, 2)
    append_batch(one, path, "other-0")
    assert spark.read.parquet(path).count() == 25


def test_unknown_time_is_refused(spark):
    with pytest.raises(Exception, match="nope"):
        mark_late(frame(spark, ROWS), "nope", "delivery").collect()
