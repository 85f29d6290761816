import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import comparison, scoring, split, training
from riskloom.plans import chart_tables, evaluation, training_run
from riskloom.plans import scoring as scoring_plan
from riskloom.plans.preparation import prepare_encounters
from riskloom.plans.stages import EncounterPreparer, EncounterPreparerModel, train_on_raw
from riskloom.schemas import ENCOUNTER_FEATURES, LABEL, ROW_KEY, SCORE
from riskloom.sources import (
    append_scored_batch,
    existing_columns,
    load_model,
    save_model,
    save_predictions,
)
from riskloom.sources.sample_tables import encounters
from riskloom.sources.sinks import written
from riskloom.streaming import high_risk_by_window, read_stream, score_stream, write_stream

QUICK = {
    "Logistic Regression": {"maxIter": 5},
    "Random Forest": {"numTrees": 3, "maxDepth": 3},
    "Gradient Boosted Trees": {"maxIter": 2, "maxDepth": 2},
}
SPEC = ENCOUNTER_FEATURES


@pytest.fixture(scope="module")
def raw(spark, small, tmp_path_factory):
    return written(encounters(spark, small), str(tmp_path_factory.mktemp("raw") / "t"))


@pytest.fixture(scope="module")
def run(spark, raw, tmp_path_factory):
    """The whole batch run, from a CSV file."""
    folder = tmp_path_factory.mktemp("run")
    raw.drop("admitted_at").write.option("header", True).csv(str(folder / "csv"))
    return training_run.main(str(folder / "csv"), str(folder / "out"), spark=spark, models=QUICK), folder / "out"


def test_output_layout(spark, run):
    result, out = run
    assert (out / "models" / "readmission_best_model" / "metadata").exists()
    assert spark.read.parquet(str(out / "predictions" / "test_predictions")).columns == [
        ROW_KEY, "patient_nbr", LABEL, "prediction", "probability",
    ]
    assert spark.read.parquet(str(out / "predictions" / "new_predictions")).columns == [
        ROW_KEY, "patient_nbr", LABEL, "prediction", SCORE, "probability",
    ]
    stored = spark.read.parquet(str(out / "results" / "model_comparison"))
    assert sorted(stored.collect()) == sorted(result["comparison_df"].collect())
    assert {r.Model for r in stored.collect()} == set(QUICK)


def test_parts_read_their_own_folder(run):
    result, _ = run
    plan = result["train"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert split.validate_data_leakage_prevention(result["train"], result["test"])
    hashed = split.split_part()
    assert result["test"].filter(hashed != "test").count() == 0 and result["train"].filter(hashed != "train").count() == 0


def test_saved_model_scores_as_before(spark, run):
    result, _ = run
    before = {r[0]: r[1] for r in result["best_predictions"].select(ROW_KEY, SCORE).collect()}
    after = {r[0]: r[1] for r in result["new_predictions"].select(ROW_KEY, SCORE).collect()}
    assert before and before == after


def test_comparison_matches_mllib(spark, run):
    result, _ = run
    model = result["results"]["Random Forest"].model
    predictions = scoring.make_predictions(model, result["test"]).persist()
    ours = comparison.evaluate_model(predictions, "Random Forest")
    theirs = comparison.evaluate_model(predictions, "Random Forest", comparison.create_evaluators())
    assert ours == pytest.approx(theirs, abs=1.01e-4)
    one = comparison.compare_models(
        {"Random Forest": comparison.ModelResult(model, predictions)}, spark, comparison.create_evaluators()
    )
    assert one.schema == comparison.COMPARISON_SCHEMA
    predictions.unpersist()


def test_comprehensive_tests_and_chart_tables(spark, run, tmp_path):
    result, _ = run
    tests = evaluation.run_comprehensive_tests(result["results"], spark, result["train"], result["test"])
    assert tests["no_leakage"] and tests["best_model_name"] == result["best_model_name"]
    cells = tests["confusion_matrix"]
    assert sum(cells.values()) == tests["predictions_detailed"].count()
    assert tests["threshold_sweep"].count() == 5
    names = training.slot_names(result["encoder"], result["test"])
    values = training.importances(result["results"]["Random Forest"].model.stages[-1])
    tables = chart_tables.chart_tables(tests, names, values)
    chart_tables.save_chart_tables(tables, str(tmp_path / "charts"))
    importance = spark.read.parquet(str(tmp_path / "charts" / "feature_importance"))
    assert importance.count() == 15
    assert spark.read.parquet(str(tmp_path / "charts" / "roc_curve")).filter("fpr = 0 AND tpr = 0").count() >= 1
    assert set(tables) == {
        "roc_curve", "roc_operating_point", "precision_recall_curve", "base_rate", "confusion_matrix",
        "model_comparison", "class_distribution", "feature_importance",
    }


def test_scoring_plan(spark, run, tmp_path):
    result, _ = run
    out = str(tmp_path / "scored")
    reports = scoring_plan.predict_pipeline(spark, result["model_path"], result["test"], out, 0.6)
    predictions = reports["predictions"]
    assert spark.read.parquet(out).count() == predictions.count()
    assert reports["unscored"].count() == 0
    assert reports["high_risk"].filter("readmission_probability < 0.6").count() == 0
    assert sum(r["count"] for r in reports["summary"].collect()) == predictions.count()
    assert "actual_readmit_rate_pct" in reports["summary"].columns
    assert reports["high_risk"].count() == reports["high_risk_report"].first().high_risk


def test_slots_line_up_with_importances(run):
    result, _ = run
    names = training.slot_names(result["encoder"], result["test"])
    assert names[: len(SPEC.numeric)] == list(SPEC.numeric)
    assert names[len(SPEC.numeric): len(SPEC.numeric) + len(SPEC.binary)] == list(SPEC.binary)
    for name in QUICK:
        assert len(training.importances(result["results"][name].model.stages[-1])) == len(names)
    assert training.model_importance(result["results"]["Logistic Regression"].model, result["test"], 3).count() == 3


def test_unseen_category_encodes_to_zeros(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    encoder = training.create_feature_pipeline(["x"], [], ["c"])[0].fit(df)
    new = spark.createDataFrame([("zzz", 1.0), (None, 1.0), ("a", None)], "c string, x double")
    rows = encoder.transform(new).select("c", training.UNSCALED).collect()
    assert {r.c: list(r[training.UNSCALED].toArray()) for r in rows} == {"zzz": [1.0, 0.0, 0.0], None: [1.0, 0.0, 0.0]}


def test_scaling_is_without_centring(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    scaled = training.create_feature_pipeline(["x"], [], [])[0].fit(df).transform(df)
    sd = df.agg(F.stddev_samp("x")).first()[0]
    assert [r.features[0] for r in scaled.collect()] == pytest.approx([1 / sd, 2 / sd, 4 / sd])


def test_key_like_category_is_refused(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many categories"):
        training.check_category_sizes(df, ["c"], limit=100)


def test_classifier_defaults():
    forest = training.make_classifier("Random Forest")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (100, 10, 5, 42)
    boosted = training.make_classifier("Gradient Boosted Trees")
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (100, 5, 0.1)
    logistic = training.make_classifier("Logistic Regression")
    assert (logistic.getMaxIter(), logistic.getRegParam(), logistic.getElasticNetParam()) == (100, 0.01, 0.5)
    assert logistic.getWeightCol() == "sample_weight"


def test_scores_need_no_python_worker(spark, run):
    result, _ = run
    predictions = scoring.make_predictions(result["best_model"], result["test"]).select(ROW_KEY, SCORE)
    plan = predictions._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_lost_by_the_assembler_are_reported(spark, raw, run):
    result, _ = run
    broken = result["test"].withColumn("time_in_hospital", F.when(F.col(ROW_KEY) % 2 == 0, F.col("time_in_hospital")))
    predictions = scoring.make_predictions(result["best_model"], broken)
    lost = scoring.unscored_rows(broken, predictions)
    assert lost.count() == broken.filter("time_in_hospital IS NULL").count() > 0


def test_sinks(spark, tmp_path, run):
    result, _ = run
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 0.0, 0.3)], f"{ROW_KEY} long, prediction double, {SCORE} double")
    save_predictions(df, path)
    assert spark.read.parquet(path).columns == [ROW_KEY, "prediction", SCORE]
    save_predictions(df, path, ["prediction", "absent"])
    assert spark.read.parquet(path).columns == ["prediction"]
    with pytest.raises(ValueError, match="absent"):
        save_predictions(df, path, ["prediction", "absent"], strict=True)
    assert existing_columns(df, [SCORE, "x", ROW_KEY]).columns == [SCORE, ROW_KEY]
    batches = str(tmp_path / "batches")
    half = result["test"].filter(F.col(ROW_KEY) % 2 == 0)
    other = result["test"].filter(F.col(ROW_KEY) % 2 != 0)
    append_scored_batch(result["best_model"], half, batches)
    append_scored_batch(result["best_model"], other, batches)
    whole = scoring.make_predictions(result["best_model"], result["test"])
    assert sorted(spark.read.parquet(batches).select(ROW_KEY, SCORE).collect()) == sorted(whole.select(ROW_KEY, SCORE).collect())


@pytest.fixture(scope="module")
def raw_model(spark, raw, tmp_path_factory):
    name = "Logistic Regression"
    model = train_on_raw(
        *split.prepare_train_test_split(raw), EncounterPreparer(untestedValues=["None", "Unknown"]), models={name: QUICK[name]}
    )[name].model
    path = str(tmp_path_factory.mktemp("raw_model") / "m")
    save_model(model, path)
    return model, load_model(spark, path)


def test_one_pipeline_scores_raw_rows_after_reload(raw, raw_model):
    model, loaded = raw_model
    assert isinstance(loaded, PipelineModel) and isinstance(loaded.stages[0], EncounterPreparerModel)
    learned = loaded.stages[0].preparation()
    assert learned.dropped == ("weight",) and learned.medians == model.stages[0].preparation().medians
    assert loaded.stages[0].getOrDefault("untestedValues") == ["None", "Unknown"]
    unlabelled = raw.drop("readmitted")
    a = scoring.make_predictions(model, raw).select(ROW_KEY, SCORE)
    b = scoring.make_predictions(loaded, unlabelled).select(ROW_KEY, SCORE)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() > 0


def test_preparer_fits_inside_a_plain_pipeline(raw):
    stages = [EncounterPreparer(), *training.create_feature_pipeline(SPEC.numeric, SPEC.binary, SPEC.categorical)[0].getStages()]
    assert Pipeline(stages=stages).fit(raw).transform(raw).count() > 0


def test_preparer_learns_from_what_it_is_fitted_on(raw):
    part = raw.filter("num_lab_procedures > 100 OR num_lab_procedures IS NULL")
    all_rows = EncounterPreparer().fit(raw).preparation().medians["num_lab_procedures"]
    assert EncounterPreparer().fit(part).preparation().medians["num_lab_procedures"] > all_rows
    prepared = EncounterPreparer().fit(raw).transform(raw)
    assert prepared.columns == prepare_encounters(raw).columns


def test_stream_scores_as_batch(spark, raw, raw_model, tmp_path):
    source = str(tmp_path / "in")
    raw.repartition(3).write.parquet(source)
    _, loaded = raw_model
    scored = score_stream(loaded, read_stream(spark, source, raw.schema, max_files_per_trigger=1)).select(ROW_KEY, SCORE)
    write_stream(scored, str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    # a second run finds nothing new and writes nothing twice
    write_stream(scored, str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()
    batch = scoring.make_predictions(loaded, raw).select(ROW_KEY, SCORE)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect())


def test_stream_windows_drop_late_rows(spark, tmp_path):
    def batch(i, rows):
        spark.createDataFrame(rows, "at string, score double").select(
            F.col("at").cast("timestamp").alias("at"), "score"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    schema = spark.createDataFrame([], "at timestamp, score double").schema

    def drain():
        stream = high_risk_by_window(read_stream(spark, str(tmp_path / "in"), schema), "at", score="score")
        write_stream(stream, str(tmp_path / "out"), str(tmp_path / "chk")).awaitTermination()

    batch(0, [("2024-01-01 01:00:00", 0.9), ("2024-01-01 02:00:00", 0.1)])
    drain()
    batch(1, [("2024-01-05 00:00:00", 0.9)])
    drain()
    batch(2, [("2024-01-01 03:00:00", 0.9), ("2024-01-08 00:00:00", 0.2)])
    drain()
    found = {str(r.window_start): (r.n_rows, r.high_risk) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {"2024-01-01 00:00:00": (2, 1), "2024-01-05 00:00:00": (1, 1)}


def test_evaluators_names():
    evaluators = comparison.create_evaluators()
    assert list(evaluators) == ["auc_roc", "auc_pr", "accuracy", "f1", "precision", "recall"]
    assert isinstance(evaluators["f1"], MulticlassClassificationEvaluator)
