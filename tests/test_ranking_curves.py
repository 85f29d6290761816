import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import comparison, confusion, curves, distribution, ranking
from riskloom.schemas import SWEEP_THRESHOLDS


def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, label int, score double, prediction double")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    for i in range(3000):
        label = int(rng.random() < 0.3)
        # a third of all rows of "hot" share one score
        hot = 0.25 if rng.random() < 0.34 else round(rng.random(), 2)
        made.append(("hot", label, hot, float(hot >= 0.5)))
        fine = min(1.0, rng.random() * (1.2 if label else 0.9))
        made.append(("fine", label, fine, float(fine >= 0.5)))
    return made


def brute_running(rows, descending):
    totals, out = {}, {}
    for model, label, score, _ in sorted(rows, key=lambda r: r[2], reverse=descending):
        key = (model, score)
        totals[model] = totals.get(model, 0) + label
        out[key] = totals[model]
    return out


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("cuts", [[], [0.5], [i / 97 for i in range(1, 97)], [-5.0, 0.25, 9.0]])
def test_running_totals_do_not_depend_on_cuts(spark, rows, descending, cuts):
    grouped = scored(spark, rows).groupBy("model", "score").agg(F.sum("label").alias("pos"))
    found = ranking.running_totals(grouped, ["model"], "score", ["pos"], cuts, descending).collect()
    wanted = brute_running(rows, descending)
    assert {(r.model, r.score): r.pos_run for r in found} == wanted
    totals = {m: sum(r[1] for r in rows if r[0] == m) for m in ("hot", "fine")}
    assert all(r.pos_total == totals[r.model] for r in found)


def test_running_totals_null_nan_infinite(spark):
    df = spark.createDataFrame(
        [(None, 1), (float("-inf"), 1), (0.0, 1), (float("inf"), 1), (float("nan"), 1)], "v double, n long"
    )
    up = ranking.running_totals(df, [], "v", ["n"], [0.0]).collect()
    assert {str(r.v): r.n_run for r in up} == {"None": 1, "-inf": 2, "0.0": 3, "inf": 4, "nan": 5}
    down = ranking.running_totals(df, [], "v", ["n"], [0.0], descending=True).collect()
    assert {str(r.v): r.n_run for r in down} == {"nan": 1, "inf": 2, "0.0": 3, "-inf": 4, "None": 5}


def test_cut_points_are_bounded_and_balanced(spark):
    df = spark.range(10_000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    cuts = ranking.cut_points(df, "v", ranges=20)
    assert len(cuts) == 19 and cuts == sorted(cuts)
    bounds = [0, *[c ** 0.5 for c in cuts], 10_000]
    assert max(b - a for a, b in zip(bounds, bounds[1:])) < 800
    assert ranking.cut_points(df.limit(0), "v") == []


def test_no_task_gets_a_whole_group(spark, rows):
    """The window over scores is partitioned by model and range, never by model alone."""
    df = scored(spark, rows)
    plan = curves.roc_points(df, "label", "score", ["model"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "threshold" in line]
    assert windows and all("_range" in line for line in windows)


@pytest.mark.parametrize("measure", [
    lambda df: curves.roc_points(df, "label", "score", ["model"]),
    lambda df: curves.curve_areas(df, "label", "score", ["model"]),
    lambda df: curves.evaluation_table(df, "label", "score"),
    lambda df: distribution.score_by_class(df, "label", "score", ["model"], exact=True),
])
def test_rows_are_counted_once(spark, rows, tmp_path, measure):
    """Both uses of the counted rows share one scan and one shuffle."""
    scored(spark, rows).write.parquet(str(tmp_path / "t"))
    df = measure(spark.read.parquet(str(tmp_path / "t")))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert (final.count("FileScan"), final.count("ReusedExchange")) == (1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-20, 20) | st.none()), min_size=1, max_size=40))
def test_exact_quantiles_match_brute_force(spark, values):
    df = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in values], "k string, v double")
    found = {
        r.k: (r.p25, r.median, r.p75)
        for r in ranking.exact_quantiles(df, ["k"], "v", distribution.QUARTILES).collect()
    }
    for key in "ab":
        own = sorted(float(v) for k, v in values if k == key and v is not None)
        if not own:
            assert found.get(key, (None, None, None)) == (None, None, None)
            continue
        wanted = statistics.quantiles(own, n=4, method="inclusive") if len(own) > 1 else [own[0]] * 3
        assert found[key] == pytest.approx(tuple(wanted))


def test_areas_match_mllib(spark, rows):
    df = scored(spark, rows).persist()
    areas = {r.model: r for r in curves.curve_areas(df, "label", "score", ["model"]).collect()}
    for model in ("hot", "fine"):
        part = df.filter(F.col("model") == model)
        for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
            evaluator = BinaryClassificationEvaluator(
                labelCol="label", rawPredictionCol="score", metricName=metric, numBins=0
            )
            assert areas[model][name] == pytest.approx(evaluator.evaluate(part), abs=1e-12)
    df.unpersist()


def test_weighted_metrics_match_mllib(spark, rows):
    df = scored(spark, rows).filter("model = 'fine'").withColumn("label", F.col("label").cast("double")).persist()
    row = confusion.class_metrics(confusion.confusion_counts(df, "label")).first()
    for name, metric in (
        ("accuracy", "accuracy"), ("weighted_f1", "f1"),
        ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"),
    ):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert row[name] == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    df.unpersist()


def test_auc_survives_monotone_change_of_scores(spark, rows):
    df = scored(spark, rows)
    changed = df.withColumn("score", F.exp(F.col("score") * 3) - 2)
    first, second = (
        {r.model: r.auc_roc for r in curves.curve_areas(d, "label", "score", ["model"]).collect()} for d in (df, changed)
    )
    assert first == pytest.approx(second)


def test_single_class_gives_null_area(spark):
    df = scored(spark, [("m", 1, 0.2, 0.0), ("m", 1, 0.8, 1.0)])
    row = curves.curve_areas(df, "label", "score", ["model"]).first()
    assert row.auc_roc is None and row.auc_pr == pytest.approx(1.0)
    no_positives = curves.curve_areas(df.withColumn("label", F.lit(0)), "label", "score", ["model"]).first()
    assert (no_positives.auc_roc, no_positives.auc_pr) == (None, None)


def test_rows_without_score_count_in_the_matrix_only(spark):
    df = scored(spark, [("m", 1, 0.9, 1.0), ("m", 0, 0.1, 0.0), ("m", 1, None, 0.0)])
    row = curves.evaluation_table(df, "label", "score").first()
    assert (row.tp, row.tn, row.fp, row.fn, row.auc_roc) == (1, 1, 0, 1, 1.0)


def test_curve_end_points(spark):
    df = scored(spark, [("m", 1, 0.9, 1.0), ("m", 0, 0.9, 1.0), ("m", 1, 0.4, 0.0), ("m", 0, 0.1, 0.0)])
    roc = curves.roc_points(df, "label", "score", ["model"], origin=True).orderBy(F.desc("threshold")).collect()
    assert [(r.threshold, r.tpr, r.fpr) for r in roc] == [
        (float("inf"), 0.0, 0.0), (0.9, 0.5, 0.5), (0.4, 1.0, 0.5), (0.1, 1.0, 1.0),
    ]
    pr = curves.pr_points(df, "label", "score", ["model"], endpoint=True).orderBy("recall", F.desc("threshold")).collect()
    assert [(r.precision, r.recall) for r in pr][:2] == [(1.0, 0.0), (0.5, 0.5)]
    empty = df.filter("score > 2").drop("model")
    assert curves.roc_points(empty, "label", "score", origin=True).count() == 0


def test_operating_point_tie_takes_higher_threshold(spark):
    df = scored(spark, [("m", 1, 0.625, 1.0), ("m", 0, 0.375, 0.0), ("m", 0, 0.1, 0.0)])
    point = curves.operating_point(curves.roc_points(df, "label", "score", ["model"]), ["model"]).first()
    assert point.threshold == 0.625


def test_sweep_matches_single_thresholds_and_recall_falls(spark, rows):
    df = scored(spark, rows).drop("model")
    sweep = {r.threshold: r for r in confusion.threshold_sweep(df, label="label", score="score").collect()}
    assert sorted(sweep) == list(SWEEP_THRESHOLDS)
    for threshold, row in sweep.items():
        tp = sum(1 for _, label, s, _ in rows if label == 1 and s >= threshold)
        fp = sum(1 for _, label, s, _ in rows if label == 0 and s >= threshold)
        assert (row.tp, row.fp, row.tp + row.tn + row.fp + row.fn) == (tp, fp, len(rows))
    recalls = [sweep[t].recall for t in sorted(sweep)]
    assert recalls == sorted(recalls, reverse=True)


def test_sweep_null_score_is_class_zero(spark):
    df = scored(spark, [("m", 1, None, 0.0), ("m", 0, None, 0.0)])
    row = confusion.threshold_sweep(df, [0.5], "label", "score").first()
    assert (row.tp, row.tn, row.fp, row.fn, row.precision, row.f1) == (0, 1, 0, 1, 0.0, 0.0)


def test_zero_divisors(spark):
    row = confusion.class_metrics(confusion.confusion_counts(scored(spark, []).drop("model"), "label")).first()
    assert (row.tp, row.accuracy, row.precision_pos, row.f1_pos, row.sensitivity, row.weighted_f1) == (0, 0, 0, 0, 0, 0)


def test_analyze_confusion_matrix(spark):
    df = scored(spark, [("m", 1, 0.9, 1.0), ("m", 1, 0.1, 0.0), ("m", 0, 0.9, 1.0), ("m", 0, 0.2, 0.0), ("m", 0, 0.2, 0.0)])
    cells, sensitivity, specificity = confusion.analyze_confusion_matrix(df, "m", "label")
    assert cells == {"tp": 1, "tn": 2, "fp": 1, "fn": 1}
    assert (sensitivity, specificity) == (0.5, pytest.approx(2 / 3))


def test_comparison_and_choice(spark, rows):
    table = comparison.comparison_table(scored(spark, rows), "label", "score").persist()
    assert [f.name for f in table.schema] == [f.name for f in comparison.COMPARISON_SCHEMA]
    assert comparison.best_model(table).first().Model == "fine"
    assert comparison.model_row(table, "hot").Model == "hot"
    with pytest.raises(ValueError, match="nobody"):
        comparison.model_row(table, "nobody")
    with pytest.raises(ValueError, match="metric"):
        comparison.best_model(table, "Luck")
    assert comparison.comparison_long(table).count() == 8
    row = comparison.champion_challenger(table, "hot").first()
    assert (row.challenger, row.promote) == ("fine", True)
    table.unpersist()


def test_choice_with_missing_metric_and_tie(spark):
    frame = comparison.comparison_frame(spark, [
        {"Model": "c", "AUC_ROC": None}, {"Model": "b", "AUC_ROC": 0.7}, {"Model": "a", "AUC_ROC": 0.7},
    ])
    assert frame.schema == comparison.COMPARISON_SCHEMA
    assert comparison.best_model(frame).first().Model == "a"
    row = comparison.champion_challenger(frame, "b").filter("challenger = 'a'").first()
    assert (row.delta, row.promote, row.retrain) == (0.0, False, False)


def test_drift_of_equal_and_shifted_batches(spark):
    base = spark.range(1000).select((F.col("id") / 1000.0).alias("x"))
    bins = {"x": distribution.equal_width_bin("x", 0.0, 1.0, 10)}
    assert distribution.population_stability(base, base, bins).first().psi == pytest.approx(0.0)
    shifted = base.select((F.col("x") / 2).alias("x"))
    assert distribution.population_stability(base, shifted, bins).first().psi > 0.25
    one_sided = distribution.population_stability(base, base.limit(0), bins).first()
    assert one_sided.baseline_n == 1000 and one_sided.current_n == 0


def test_score_by_class_counts_rows_without_score(spark):
    df = scored(spark, [("m", 1, 0.2, 0.0), ("m", 1, 0.6, 0.0), ("m", 1, None, 0.0), ("m", 0, None, 0.0)])
    for exact in (True, False):
        found = {r.label: r for r in distribution.score_by_class(df, "label", "score", exact=exact).collect()}
        assert (found[1].n, found[1].mean_score, found[0].n, found[0].mean_score) == (3, pytest.approx(0.4), 1, None)
        assert found[0].median is None
    # exact interpolates
    assert distribution.score_by_class(df, "label", "score", exact=True).filter("label = 1").first().median == pytest.approx(0.4)


def test_score_by_class_exact_close_to_approximate(spark, rows):
    df = scored(spark, rows)
    exact = {(r.model, r.label): r for r in distribution.score_by_class(df, "label", "score", ["model"], exact=True).collect()}
    approx = {(r.model, r.label): r for r in distribution.score_by_class(df, "label", "score", ["model"]).collect()}
    for key, row in exact.items():
        assert row.n == approx[key].n
        assert row.median == pytest.approx(approx[key].median, abs=0.02)
