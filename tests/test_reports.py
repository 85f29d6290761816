"""The long report against plain counting, and sketches against exact ranks."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskloom.operators import confusion, report, sketches

SCHEMA = "model string, label int, score double, prediction double"


def rows(n=400):
    rnd = random.Random(8)
    out = [(m, rnd.choice((0, 1)), rnd.choice((0.3, 0.5, rnd.random())), float(rnd.random() > 0.5)) for m in ("a", "b") for _ in range(n)]
    return out + [("a", 1, None, 0.0), ("a", None, 0.7, 1.0), ("c", 0, 0.4, 0.0)]


def plainly(data, thresholds):
    out = {}
    ratio = lambda a, b: a / b if b else 0.0
    for m in {r[0] for r in data}:
        mine = [r for r in data if r[0] == m]
        groups = {("model", None): mine} | {("class", None if c is None else str(c)): [r for r in mine if r[1] == c] for c in {r[1] for r in mine}}
        for (section, key), held in groups.items():
            scores = [r[2] for r in held if r[2] is not None]
            out |= {(section, m, key, "n"): len(held), (section, m, key, "n_scored"): len(scores), (section, m, key, "mean"): statistics.fmean(scores)}
            out |= {(section, m, key, "min"): min(scores), (section, m, key, "max"): max(scores)}
            out[section, m, key, "stddev"] = statistics.stdev(scores) if len(scores) > 1 else None
        for section, key, called in [("model", None, lambda r: r[3] == 1)] + [("threshold", str(t), lambda r, t=t: r[2] is not None and r[2] >= t) for t in thresholds]:
            count = lambda actual, wanted: sum(r[1] == actual and bool(called(r)) == wanted for r in mine)
            tp, tn, fp, fn = count(1, True), count(0, False), count(0, True), count(1, False)
            precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
            names = ("precision_pos", "recall_pos", "f1_pos") if section == "model" else ("precision", "recall", "f1")
            figures = dict(zip(("tp", "tn", "fp", "fn", *names), (tp, tn, fp, fn, precision, recall, ratio(2 * precision * recall, precision + recall))))
            out |= {(section, m, key, name): value for name, value in figures.items()}
    return out


def test_report_equals_plain_counting(spark):
    data, thresholds = rows(), (0.5, 0.3, 0.3, 0.9)
    found = report.evaluation_report(spark.createDataFrame(data, SCHEMA), "label", "score", thresholds=thresholds).collect()
    values = {(r.section, r.model, r.key, r.metric): r.value for r in found}
    assert len(values) == len(found)
    for key, value in plainly(data, sorted(set(thresholds))).items():
        assert values[key] == (pytest.approx(value, abs=1e-12) if value is not None else None), key
    measured = confusion.class_metrics(confusion.confusion_counts(spark.createDataFrame(data, SCHEMA), "label", by=["model"])).collect()
    for r in measured:
        for name in ("accuracy", "weighted_f1", "weighted_precision", "sensitivity", "specificity"):
            assert values["model", r.model, None, name] == pytest.approx(r[name])


def test_report_of_nothing_and_without_thresholds(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert report.evaluation_report(empty, "label", "score").count() == 0
    only = report.evaluation_report(spark.createDataFrame(rows(), SCHEMA), "label", "score", thresholds=())
    assert {r.section for r in only.select("section").distinct().collect()} == {"model", "class"}


def test_merged_sketches_keep_their_bound(spark):
    rnd = random.Random(4)
    data = [(i % 13, rnd.choice((1.0, rnd.gauss(0, 5))), None if i % 3 else float(i), math.nan if i % 2 else None) for i in range(30_000)]
    df = spark.createDataFrame(data, "part int, x double, y double, z double")
    columns, shares = ["x", "y", "z"], {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    parts = sketches.column_sketches(df, columns, ["part"])
    assert parts.count() == 39 and parts.filter("column_name = 'z' AND (n > 0 OR sketch IS NOT NULL)").count() == 0
    merged = sketches.merged_sketches(parts)
    counts = {r.column_name: r.n for r in merged.collect()}
    assert counts == {"x": 30_000, "y": 10_000}
    found = sketches.sketch_quantiles(merged, shares)
    errors = sketches.rank_errors(df, found, shares, columns).collect()
    assert len(errors) == 6 and all(r.error <= sketches.RANK_ERROR for r in errors)
    # a wrong answer has a large error
    wrong = found.withColumn("p50", F.col("p99"))
    assert max(r.error for r in sketches.rank_errors(df, wrong, shares, columns).filter("quantile = 'p50'").collect()) > 0.2
