"""The registered queries: each runs operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import code_group
from riskloom.operators import category_table, cleaning, comparison, confusion, curves, distribution, features, history
from riskloom.operators import report, scoring, sketches, split, training, tree_nodes
from riskloom.plans.chart_tables import chart_tables, save_chart_tables
from riskloom.plans.evaluation import evaluate_and_compare
from riskloom.plans.preparation import apply_preparation, clean_rows, learn_preparation, prepare_encounters
from riskloom.plans.scoring import predict_pipeline
from riskloom.plans.stages import ExpressionStep, train_on_raw
from riskloom.plans.training_run import main
from riskloom.schemas import (
    ADMISSION_TYPE_GROUPS,
    COMPARISON_SCHEMA,
    ENCOUNTER_FEATURES,
    LABEL,
    MEDIAN_FILL_COLUMNS,
    ROW_KEY,
    SCORE,
)
from riskloom.session import local_frame, scratch_path
from riskloom.sources.encounters_csv import load_data, load_report
from riskloom.sources.lookups import ENCOUNTER_LOOKUPS, lookup_frame
from riskloom.sources.sample_tables import (
    ENCOUNTER_COLUMNS,
    encounters,
    model_scores,
    prior_kinds,
    read_table,
    visits,
)
from riskloom.sources.sinks import append_scored_batch, load_model, save_comparison_results, save_model, save_predictions, written
from riskloom.streaming import (
    batch_writer,
    high_risk_by_window,
    late_report,
    mark_late,
    open_windows,
    read_stream,
    replay,
    score_stream,
    write_batches,
    write_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MODEL = ["model"]


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def encounter_table(spark: SparkSession, sf_dir: str, columns=ENCOUNTER_COLUMNS) -> DataFrame:
    """Encounters written once, for queries that look at them more than once."""
    return written(encounters(spark, sf_dir, columns), scratch_path(spark, "encounters"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- sources and sinks ---------------------------------------------------------------


@register
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "encounters-csv")
    encounters(spark, sf_dir).write.option("header", True).csv(path)
    return load_data(spark, path, types={"admitted_at": T.TimestampNTZType()})


@register
def malformed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters of which every seventh has a word where a number belongs, read and counted."""
    path = scratch_path(spark, "encounters-bad-csv")
    stay = F.when(F.col(ROW_KEY) % 7 == 0, F.lit("some")).otherwise(F.col("time_in_hospital").cast("string"))
    encounters(spark, sf_dir).withColumn("time_in_hospital", stay).write.option("header", True).csv(path)
    types = {"admitted_at": T.TimestampNTZType()}
    loaded = load_data(spark, path, types=types, mode="PERMISSIVE", corrupt="_bad").cache()  # Spark needs the raw column kept
    return load_report(loaded, "_bad").select("n_rows", "n_malformed")


@register
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(encounters(spark, sf_dir))


@register
def parquet_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    scored = model_scores(spark, sf_dir, ["m1"]).withColumnsRenamed(
        {"event_id": ROW_KEY, "label": LABEL, "score": SCORE}
    )
    save_predictions(scored, path)
    return spark.read.parquet(path)


@register
def comparison_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "comparison")
    save_comparison_results(model_comparison(spark, sf_dir), path)
    return spark.read.parquet(path)


# --- cleaning ------------------------------------------------------------------------


@register
def admission_readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits and readmission rate per admission group."""
    df = encounters(
        spark, sf_dir, [ROW_KEY, "admission_type_id", "discharge_disposition_id", "readmitted"]
    )
    df = cleaning.remove_invalid_records(cleaning.create_target_variable(df))
    group = code_group("admission_type_id", ADMISSION_TYPE_GROUPS, "Other_Unknown")
    return df.groupBy(group.alias("admission_type_group")).agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum(LABEL).alias("readmitted_30"),
        F.round(F.avg(LABEL), 6).alias("readmission_rate"),
    )


@register
def null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.replace_missing_indicators(encounters(spark, sf_dir))


@register
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.replace_missing_indicators(encounters(spark, sf_dir))
    return rounded(cleaning.missing_profile(df), "missing_pct")


@register
def drop_high_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, "discharge_disposition_id", "weight", "payer_code", "medical_specialty"]
    df = cleaning.replace_missing_indicators(encounters(spark, sf_dir, columns))
    return cleaning.drop_high_missing_columns(cleaning.remove_invalid_records(df))


@register
def fill_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, "race", "gender", "payer_code", "medical_specialty", "max_glu_serum", "change"]
    return cleaning.fill_categories(cleaning.replace_missing_indicators(encounters(spark, sf_dir, columns)))


@register
def fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_medians(encounter_table(spark, sf_dir, [ROW_KEY, *MEDIAN_FILL_COLUMNS]), exact=True)


@register
def approx_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = cleaning.approx_medians(encounters(spark, sf_dir, MEDIAN_FILL_COLUMNS), MEDIAN_FILL_COLUMNS)
    schema = T.StructType().add("column_name", T.StringType()).add("approx_median", T.DoubleType())
    return local_frame(spark, [{"column_name": c, "approx_median": v} for c, v in medians.items()], schema)


@register
def target_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.create_target_variable(encounters(spark, sf_dir, [ROW_KEY, "readmitted"]))


@register
def exclude_discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.remove_invalid_records(encounters(spark, sf_dir, [ROW_KEY, "discharge_disposition_id"]))


@register
def exclusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.exclusion_report(encounters(spark, sf_dir, ["discharge_disposition_id"]))


@register
def clean_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_gender_column(encounters(spark, sf_dir, [ROW_KEY, "gender"]))


@register
def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = encounters(spark, sf_dir, [ROW_KEY, *ENCOUNTER_LOOKUPS])
    for column, values in ENCOUNTER_LOOKUPS.items():
        df = cleaning.decode_codes(df, lookup_frame(spark, values), column, column.replace("_id", "_text"))
    return df


# --- features ------------------------------------------------------------------------


@register
def admission_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, *features.REQUIRED_COLUMNS["admission"]]
    return features.create_admission_features(encounters(spark, sf_dir, columns))


@register
def discharge_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, *features.REQUIRED_COLUMNS["discharge"]]
    return features.create_discharge_features(encounters(spark, sf_dir, columns))


@register
def utilization_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, *features.REQUIRED_COLUMNS["utilization"]]
    return rounded(features.create_utilization_features(encounters(spark, sf_dir, columns)), "complexity_score")


@register
def age_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.create_age_features(encounters(spark, sf_dir, [ROW_KEY, "age"]))


@register
def lab_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [ROW_KEY, *features.REQUIRED_COLUMNS["lab"]]
    return features.create_lab_test_features(encounters(spark, sf_dir, columns))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_encounters(encounter_table(spark, sf_dir), exact_median=True)


def _prepared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and features of prepared rows as a table, as fits pass over them several times."""
    wanted = _prepared(spark, sf_dir).select(ROW_KEY, "patient_nbr", LABEL, *ENCOUNTER_FEATURES.all)
    return written(wanted, scratch_path(spark, "prepared"))


@register
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir).select(ROW_KEY, "patient_nbr", *ENCOUNTER_FEATURES.all, LABEL)
    return rounded(prepared, "complexity_score")


@register
def prior_year_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = history.with_prior_visits(visits(spark, sf_dir), "patient_nbr", "admitted_at", prior_kinds())
    return counted.select(ROW_KEY, *prior_kinds())


@register
def next_visit_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = history.with_next_visit_label(visits(spark, sf_dir), "patient_nbr", "admitted_at", ROW_KEY)
    return labelled.select(ROW_KEY, "readmitted")


# --- split and weights ---------------------------------------------------------------


@register
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encounters(spark, sf_dir, [ROW_KEY, "patient_nbr"]).withColumn("part", split.split_part())


@register
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_report(encounters(spark, sf_dir, ["patient_nbr"]))


@register
def random_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The random split is a partition of rows and of patients, whatever the draw."""
    df = encounters(spark, sf_dir, [ROW_KEY, "patient_nbr"])
    train, test = split.prepare_train_test_split(df, method="random")
    return split.entity_overlap(train, test).select(
        (F.col("train_entities") + F.col("test_entities")).alias("entities"), "overlap", "passed"
    )


@register
def entity_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.prepare_train_test_split(encounters(spark, sf_dir, ["patient_nbr"]))
    return split.entity_overlap(train, test)


@register
def distinct_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.distinct_entities(encounters(spark, sf_dir, ["patient_nbr"]))


def _labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return cleaning.create_target_variable(encounters(spark, sf_dir, [*columns, "readmitted"]))


@register
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.class_counts(_labelled(spark, sf_dir))


@register
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(split.class_weight_table(_labelled(spark, sf_dir)), "weight")


@register
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = written(_labelled(spark, sf_dir, ROW_KEY), scratch_path(spark, "labelled"))
    weighted = split.add_sample_weights(df, *split.calculate_class_weights(df))
    return rounded(weighted.select(ROW_KEY, LABEL, "sample_weight"), "sample_weight")


@register
def semi_join_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of the patients who were readmitted within 30 days at least once."""
    df = written(_labelled(spark, sf_dir, ROW_KEY, "patient_nbr"), scratch_path(spark, "labelled"))
    return split.keep_entities(df, df.filter(F.col(LABEL) == 1)).select(ROW_KEY, "patient_nbr")


@register
def anti_join_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits a model would skip: those with a missing number."""
    df = encounters(spark, sf_dir, [ROW_KEY, *MEDIAN_FILL_COLUMNS])
    return scoring.unscored_rows(df.select(ROW_KEY), df.dropna(subset=list(MEDIAN_FILL_COLUMNS)))


# --- metrics on scored rows ----------------------------------------------------------


@register
def label_prediction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion.label_prediction_counts(model_scores(spark, sf_dir), "label", by=MODEL)


@register
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion.confusion_counts(model_scores(spark, sf_dir), "label", by=MODEL)


@register
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = confusion.class_metrics(confusion.confusion_counts(model_scores(spark, sf_dir), "label", by=MODEL))
    return rounded(measured, *[c for c, kind in measured.dtypes if kind == "double"])


@register
def score_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = distribution.score_description(model_scores(spark, sf_dir), "score", MODEL)
    return rounded(described, "mean", "stddev", "min", "max")


@register
def score_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_class = distribution.score_by_class(model_scores(spark, sf_dir), "label", "score", MODEL, exact=True)
    return rounded(by_class, "mean_score", "p25", "median", "p75")


@register
def score_by_class_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.score_by_class(model_scores(spark, sf_dir), "label", "score", MODEL)


@register
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = confusion.threshold_sweep(model_scores(spark, sf_dir), label="label", score="score", by=MODEL)
    return rounded(sweep, "precision", "recall", "f1")


@register
def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.get_prediction_summary(model_scores(spark, sf_dir), "label", "score", MODEL)


@register
def high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    risky = scoring.filter_high_risk_patients(model_scores(spark, sf_dir), score="score")
    return rounded(risky.select("event_id", "model", "label", "score"), "score")


@register
def high_risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.high_risk_report(model_scores(spark, sf_dir), score="score", by=MODEL)


@register
def sql_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter given as SQL text, as a user would write it."""
    chosen = model_scores(spark, sf_dir).filter("score >= 0.3 AND score < 0.7 AND label = 1 AND model <> 'm2'")
    return rounded(chosen.select("event_id", "model", "score"), "score")


@register
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = scoring.with_risk_band(model_scores(spark, sf_dir), "score")
    return rounded(banded.select("event_id", "model", "score", "risk_band"), "score")


@register
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.class_distribution(model_scores(spark, sf_dir, ["m1"]), "label")


@register
def base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(split.base_rate(model_scores(spark, sf_dir, ["m1"]), "label"), "base_rate")


@register
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curves.roc_points(model_scores(spark, sf_dir), "label", "score", MODEL)
    return rounded(points, "threshold", "tpr", "fpr", digits=9)


@register
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curves.pr_points(model_scores(spark, sf_dir), "label", "score", MODEL)
    return rounded(points, "threshold", "precision", "recall", digits=9)


@register
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = curves.curve_areas(model_scores(spark, sf_dir), "label", "score", MODEL)
    return rounded(areas.select("model", "auc_roc"), "auc_roc", digits=9)


@register
def pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = curves.curve_areas(model_scores(spark, sf_dir), "label", "score", MODEL)
    return rounded(areas.select("model", "auc_pr"), "auc_pr", digits=9)


@register
def operating_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curves.roc_points(model_scores(spark, sf_dir), "label", "score", MODEL)
    return rounded(curves.operating_point(points, MODEL), "threshold", "tpr", "fpr")


@register
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_model = {m: model_scores(spark, sf_dir, [m]) for m in ("m1", "m2", "m3")}
    stacked = comparison.stack_predictions(per_model, ["label", "prediction", "score"])
    return comparison.comparison_table(stacked, "label", "score")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models from a single scan, where ``model_comparison`` stacks one frame per model."""
    return comparison.comparison_table(model_scores(spark, sf_dir), "label", "score")


@register
def comprehensive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models, classes and thresholds in one long table, from one scan."""
    return rounded(report.evaluation_report(model_scores(spark, sf_dir), "label", "score"), "value")


@register
def model_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison row of one model, looked up by its name."""
    return local_frame(spark, [comparison.model_row(_compared(spark, sf_dir), "m2").asDict()], COMPARISON_SCHEMA)


def _chart_query(table: str, *decimals: str, digits: int = 6) -> Query:
    """One table of the chart bundle, as it is after the bundle was saved."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        named = {"label": LABEL, "score": SCORE}
        compared = _compared(spark, sf_dir)
        best = comparison.best_model(compared).first()["Model"]
        results = {"best_predictions": model_scores(spark, sf_dir, [best]).withColumnsRenamed(named), "comparison_df": compared}
        path = scratch_path(spark, "charts")
        save_chart_tables({table: chart_tables(results)[table]}, path)
        saved = spark.read.parquet(f"{path}/{table}")
        finite = saved.withColumn("threshold", F.nullif("threshold", F.lit(float("inf")))) if "threshold" in saved.columns else saved
        return rounded(finite, *decimals, digits=digits)

    return run


QUERIES["chart_roc_curve"] = _chart_query("roc_curve", "threshold", "tpr", "fpr", digits=9)
QUERIES["chart_operating_point"] = _chart_query("roc_operating_point", "threshold", "tpr", "fpr")
QUERIES["chart_precision_recall"] = _chart_query("precision_recall_curve", "threshold", "precision", "recall", digits=9)
QUERIES["chart_base_rate"] = _chart_query("base_rate", "base_rate")
QUERIES["chart_confusion_matrix"] = _chart_query("confusion_matrix")
QUERIES["chart_model_comparison"] = _chart_query("model_comparison")
QUERIES["chart_class_distribution"] = _chart_query("class_distribution")


@register
def comparison_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.comparison_long(_compared(spark, sf_dir))


@register
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.best_model(_compared(spark, sf_dir), "AUC_ROC")


@register
def champion_challenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.champion_challenger(_compared(spark, sf_dir), "m1")


@register
def feature_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores before and after the middle of the time that the events span."""
    scored = model_scores(spark, sf_dir)
    low, high = read_table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(low + (high - low) / 2).cast("timestamp_ntz")
    bins = {
        "score": distribution.equal_width_bin("score", 0.0, 1.0, 10),
        "label": F.col("label"),
    }
    drift = distribution.population_stability(
        scored.filter(F.col("ts") < middle), scored.filter(F.col("ts") >= middle), bins, MODEL
    )
    return rounded(drift, "psi")


# --- models --------------------------------------------------------------------------


def _encoder(prepared: DataFrame) -> PipelineModel:
    spec = ENCOUNTER_FEATURES
    return training.create_feature_pipeline(spec.numeric, spec.binary, spec.categorical)[0].fit(prepared)


@register
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.category_index(_encoder(_prepared_table(spark, sf_dir)), spark)


@register
def encode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-zero slot of the encoded and scaled feature vectors, by name."""
    prepared = _prepared_table(spark, sf_dir)
    encoder = _encoder(prepared)
    slots = training.feature_slots(encoder.transform(prepared), training.slot_names(encoder, prepared), ROW_KEY)
    return rounded(slots, "value")


def _trained(spark: SparkSession, sf_dir: str, *names: str):
    """Results of the named models, fitted on one stored table of prepared rows, and the test part."""
    spec = ENCOUNTER_FEATURES
    wanted = [ROW_KEY, "patient_nbr", LABEL, *spec.all]
    prepared = written(prepare_encounters(encounter_table(spark, sf_dir)).select(*wanted), scratch_path(spark, "prepared"))
    train, test = split.prepare_train_test_split(prepared)
    results, _ = training.train_all_models(
        train, test, spec.numeric, spec.binary, spec.categorical, {name: {} for name in names}
    )
    return results, test


def _train_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        results, _ = _trained(spark, sf_dir, name)
        return evaluate_and_compare(results, spark)[3]

    return run


QUERIES["train_lr"] = _train_query("Logistic Regression")
QUERIES["train_rf"] = _train_query("Random Forest")
QUERIES["train_gbt"] = _train_query("Gradient Boosted Trees")


@register
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, test = _trained(spark, sf_dir, "Random Forest")
    return training.model_importance(results["Random Forest"].model, test)


@register
def score_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, test = _trained(spark, sf_dir, "Logistic Regression")
    path = scratch_path(spark, "model")
    save_model(results["Logistic Regression"].model, path)
    return scoring.make_predictions(load_model(spark, path), test).select(ROW_KEY, "prediction", SCORE)


@register
def saved_model_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test row: the score survives saving and loading, is a probability, and agrees with the class."""
    results, test = _trained(spark, sf_dir, "Logistic Regression")
    path = scratch_path(spark, "model")
    before = results["Logistic Regression"].predictions.select(ROW_KEY, F.col(SCORE).alias("before"))
    save_model(results["Logistic Regression"].model, path)
    after = scoring.make_predictions(load_model(spark, path), test)
    return after.join(before, ROW_KEY).select(
        ROW_KEY,
        LABEL,
        (F.col(SCORE) == F.col("before")).alias("same_after_loading"),
        F.col(SCORE).between(0.0, 1.0).alias("is_probability"),
        ((F.col(SCORE) > 0.5) == (F.col("prediction") == 1.0)).alias("agrees_with_class"),
    )


@register
def lr_probability_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test row: is the probability what the stored coefficients give for the encoded features?"""
    results, test = _trained(spark, sf_dir, "Logistic Regression")
    model = results["Logistic Regression"].model
    weights = F.array(*[F.lit(float(c)) for c in model.stages[-1].coefficients.toArray()])
    products = F.zip_with(vector_to_array(training.FEATURES), weights, lambda x, w: x * w)
    margin = F.aggregate(products, F.lit(float(model.stages[-1].intercept)), lambda a, x: a + x)
    again = 1 / (1 + F.exp(-margin))
    scored = scoring.make_predictions(model, test)
    return scored.select(ROW_KEY, LABEL, (F.abs(again - F.col(SCORE)) < 1e-9).alias("agrees"))


@register
def tree_model_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the fitted forest and boosted trees at the standard settings."""
    rows, depths = [], {"Random Forest": 10, "Gradient Boosted Trees": 5}
    results, test = _trained(spark, sf_dir, *depths)
    for name, depth in depths.items():
        fitted = results[name].model.stages[-1]
        found = training.model_importance(results[name].model, test, None).agg(
            F.count(F.lit(1)).alias("n"), F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("below")
        ).first()
        rows.append({
            "model": name, "n_trees": fitted.getNumTrees, "depth_within": max(t.depth for t in fitted.trees) <= depth,
            "importances_sum_to_one": abs(found["total"] - 1) < 1e-9 and not found["below"],
            "a_slot_per_importance": found["n"] == len(training.slot_names(PipelineModel(results[name].model.stages[:-1]), test)),
        })
    flags = ("depth_within", "importances_sum_to_one", "a_slot_per_importance")
    schema = T.StructType().add("model", T.StringType()).add("n_trees", T.IntegerType())
    for flag in flags:
        schema = schema.add(flag, T.BooleanType())
    return local_frame(spark, rows, schema)


@register
def tree_score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test row and tree model: does a walk over the saved nodes, with joins alone, give the model's score and class?"""
    results, test = _trained(spark, sf_dir, "Random Forest", "Gradient Boosted Trees")
    checks = []
    for name, result in results.items():
        path = scratch_path(spark, "model")
        save_model(result.model, path)
        columns = [ROW_KEY, LABEL, "prediction", SCORE, training.FEATURES]
        scored = written(result.predictions.select(*columns), scratch_path(spark, "scored"))
        rows = scored.select(ROW_KEY, vector_to_array(training.FEATURES).alias("features"))
        again = tree_nodes.tree_scores(rows, tree_nodes.load_ensemble(spark, path), [ROW_KEY], score="again")
        both = scored.select(ROW_KEY, LABEL, "prediction", SCORE).join(again.withColumnRenamed("prediction", "class_again"), ROW_KEY, "left")
        same = (F.abs(F.col("again") - F.col(SCORE)) < 1e-9) & (F.col("class_again") == F.col("prediction"))
        checks.append(both.select(F.lit(name).alias("model"), ROW_KEY, LABEL, F.coalesce(same, F.lit(False)).alias("agrees")))
    return reduce(DataFrame.unionByName, checks)


@register
def importance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feature slot of the forest: is its importance the gain of its splits, and no larger than that of the slot before?"""
    results, test = _trained(spark, sf_dir, "Random Forest")
    model, path = results["Random Forest"].model, scratch_path(spark, "model")
    save_model(model, path)
    given = training.model_importance(model, test, None)
    names = training.slot_names(PipelineModel(model.stages[:-1]), test)
    slots = F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("name"), F.sequence(F.lit(0), F.lit(len(names) - 1)).alias("slot")))
    named = spark.range(1).select(slots.alias("s")).select(F.col("s.name").alias("feature"), F.col("s.slot").alias("slot"))
    again = tree_nodes.node_importance(tree_nodes.load_ensemble(spark, path)).withColumnsRenamed({"feature": "slot", "importance": "again"})
    listed = given.select("feature", "importance", F.monotonically_increasing_id().alias("place"))  # one partition, in its order
    both = listed.join(named, "feature", "left").join(again, "slot", "left")
    before = F.lag("importance").over(Window.partitionBy().orderBy("place"))  # a row per slot
    return both.select(
        "feature",
        (F.abs(F.col("importance") - F.coalesce("again", F.lit(0.0))) < 1e-9).alias("agrees"),
        (F.coalesce(before, F.lit(1.0)) >= F.col("importance")).alias("in_order"),
    )


@register
def scored_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test part scored in two batches added to one table, one of them delivered twice; which rows arrived, and how often."""
    results, test = _trained(spark, sf_dir, "Logistic Regression")
    path = scratch_path(spark, "batches")
    for half in (0, 1, 0):
        append_scored_batch(results["Logistic Regression"].model, test.filter(F.col(ROW_KEY) % 2 == half), path, half)
    return spark.read.parquet(path).groupBy(ROW_KEY).agg(F.count(F.lit(1)).alias("n"))


@register
def predict_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring with a saved model, whole: figures of its reports that must agree with each other and the input."""
    results, test = _trained(spark, sf_dir, "Logistic Regression")
    path, out = scratch_path(spark, "model"), scratch_path(spark, "predictions")
    save_model(results["Logistic Regression"].model, path)
    holes = test.withColumn("time_in_hospital", F.when(F.col(ROW_KEY) % 10 != 0, F.col("time_in_hospital")))
    run = predict_pipeline(spark, path, holes, out, 0.55)
    one, at = F.lit(1), F.count_if(F.col(SCORE) >= 0.55)
    figures = [  # (name, frame, what is counted); figures of one name are added up
        ("rows", run["predictions"], F.count(one)),
        ("positive", run["predictions"], F.sum(LABEL)),
        ("unscored", run["unscored"], F.count(one)),
        ("summary minus rows", run["summary"], F.sum("count")),
        ("summary minus rows", run["predictions"], -F.count(one)),
        ("high risk minus threshold", run["high_risk"], F.count(one)),
        ("high risk minus threshold", run["predictions"], -at),
        ("high risk below threshold", run["high_risk"], F.count_if(F.col(SCORE) < 0.55)),
        ("report minus threshold", run["high_risk_report"], F.sum("high_risk")),
        ("report minus threshold", run["predictions"], -at),
    ]
    counted = [df.agg(figure.cast("long").alias("n")).select(F.lit(name).alias("figure"), "n") for name, df, figure in figures]
    return reduce(DataFrame.unionByName, counted).groupBy("figure").agg(F.sum("n").alias("n"))


@register
def unscored_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits a model would skip, found row by row."""
    df = encounters(spark, sf_dir, [ROW_KEY, *MEDIAN_FILL_COLUMNS])
    return scoring.missing_feature_rows(df, MEDIAN_FILL_COLUMNS).select(ROW_KEY)


@register
def random_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random split of visits of which every tenth has no patient: how many rows arrive, and with NULL."""
    df = encounters(spark, sf_dir, [ROW_KEY, "patient_nbr"])
    df = df.withColumn("patient_nbr", F.when(F.col(ROW_KEY) % 10 != 0, F.col("patient_nbr")))
    train, test = split.prepare_train_test_split(df, method="random")
    return train.unionByName(test).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("patient_nbr").isNull()).alias("n_null")
    )


@register
def late_null_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preparation learned on complete numbers, applied to rows with NULLs: no number stays NULL."""
    numbers = list(MEDIAN_FILL_COLUMNS)
    cleaned = clean_rows(encounters(spark, sf_dir))
    learned = learn_preparation(cleaned.dropna(subset=numbers), exact_median=True)
    holes = cleaned.withColumns({c: F.when(F.col(ROW_KEY) % 3 != 0, F.col(c)) for c in numbers})
    filled = apply_preparation(holes, learned)
    return filled.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in numbers])


@register
def approx_median_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per number column: is the approximate median's rank within the promised error?"""
    columns = list(MEDIAN_FILL_COLUMNS)
    df = written(encounters(spark, sf_dir, columns), scratch_path(spark, "numbers"))
    found = cleaning.approx_medians(df, columns, 0.01)
    measured = df.agg(*[
        F.struct(F.count(c).alias("n"), F.count_if(F.col(c) < found[c]).alias("below"), F.count_if(F.col(c) <= found[c]).alias("upto")).alias(c)
        for c in columns if c in found
    ])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("m")) for c in columns if c in found]))
    return measured.select(rows.alias("r")).select(
        "r.column_name",
        ((F.col("r.m.below") <= 0.51 * F.col("r.m.n") + 1) & (F.col("r.m.upto") >= 0.49 * F.col("r.m.n") - 1)).alias("within_error"),
    )


@register
def sketch_quantile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score quartiles per model and class from daily sketches that were stored and merged: are their ranks within the bound?"""
    scored = written(model_scores(spark, sf_dir).withColumn("day", F.to_date("ts")), scratch_path(spark, "scored"))
    daily = sketches.column_sketches(scored, ["score"], ["day", *MODEL, "label"])
    stored = written(daily, scratch_path(spark, "sketches"))
    merged = sketches.merged_sketches(stored, [*MODEL, "label"])
    found = sketches.sketch_quantiles(merged, distribution.QUARTILES, [*MODEL, "label"])
    errors = sketches.rank_errors(scored, found, distribution.QUARTILES, ["score"], [*MODEL, "label"])
    within = errors.select(*MODEL, "label", "quantile", (F.col("error") <= sketches.RANK_ERROR).alias("within_bound"))
    return within.join(found.select(*MODEL, "label", "n"), [*MODEL, "label"])


@register
def sketch_median_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of the number columns from sketches per admission type, merged over all types: are their ranks within the bound?"""
    columns = list(MEDIAN_FILL_COLUMNS)
    df = encounter_table(spark, sf_dir, [*columns, "admission_type_id"])
    parts = written(sketches.column_sketches(df, columns, ["admission_type_id"]), scratch_path(spark, "sketches"))
    found = sketches.sketch_quantiles(sketches.merged_sketches(parts), {"median": 0.5})
    errors = sketches.rank_errors(df, found, {"median": 0.5}, columns)
    within = errors.select("column_name", (F.col("error") <= sketches.RANK_ERROR).alias("within_bound"))
    return within.join(found.select("column_name", "n"), "column_name")


@register
def category_table_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every category and its index, from a table that was stored and read back."""
    path = scratch_path(spark, "category-table")
    category_table.save_categories(category_table.category_table(_prepared_table(spark, sf_dir), ENCOUNTER_FEATURES.categorical), path)
    return category_table.load_categories(spark, path)


@register
def category_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters indexed by joins with categories learned on the training part; an unseen one gets the number of known ones."""
    columns, prepared = list(ENCOUNTER_FEATURES.categorical), _prepared_table(spark, sf_dir)
    known = prepared.filter((split.split_part() == "train") & ~F.col("race").isin("MACHINERY"))
    path = scratch_path(spark, "category-table")
    category_table.save_categories(category_table.category_table(known, columns), path)
    indexed = category_table.index_categories(prepared, category_table.load_categories(spark, path), columns)
    return indexed.select(ROW_KEY, *[f"{c}_indexed" for c in columns])


@register
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits in parts that hold exactly their share of the patients."""
    df = encounters(spark, sf_dir, [ROW_KEY, "patient_nbr"])
    return df.withColumn("part", split.exact_split_part(df))


@register
def user_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own feature in a saved pipeline: its value after loading, and whether scores are as before saving."""
    raw, name, path = encounter_table(spark, sf_dir), "Logistic Regression", scratch_path(spark, "user-step")
    step = ExpressionStep({"visits_per_day": "total_prior_visits / time_in_hospital"}, {"total_prior_visits": "double", "time_in_hospital": "double"})
    spec = replace(ENCOUNTER_FEATURES, numeric=(*ENCOUNTER_FEATURES.numeric, "visits_per_day"))
    trained = train_on_raw(*split.prepare_train_test_split(raw), features=spec, models={name: {"maxIter": 20}}, steps=[step])[name].model
    save_model(trained, path)
    before = scoring.make_predictions(trained, raw).select(ROW_KEY, F.col(SCORE).alias("before"))
    after = scoring.make_predictions(load_model(spark, path), raw).join(before, ROW_KEY)
    return rounded(after.select(ROW_KEY, "visits_per_day", (F.col(SCORE) == F.col("before")).alias("same_after_loading")), "visits_per_day")


@register
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a CSV file to scored rows, stopped after the first fit and resumed: rows of each table, and what the run counted."""
    source, out = scratch_path(spark, "csv"), scratch_path(spark, "run")
    encounters(spark, sf_dir).drop("admitted_at").write.option("header", True).csv(source)
    stopped = main(source, out, spark=spark, until="model Logistic Regression")
    run = main(source, out, spark=spark)
    figures = [F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).alias("n_positive")]
    compared = run["comparison_df"].select(
        F.lit("model_comparison").alias("table_name"),
        F.col("Model").alias("model"),
        (F.col("True_Positives") + F.col("True_Negatives") + F.col("False_Positives") + F.col("False_Negatives")).alias("n_rows"),
        (F.col("True_Positives") + F.col("False_Negatives")).alias("n_positive"),
    )
    tables = {name: spark.read.parquet(f"{out}/predictions/{name}") for name in ("test_predictions", "new_predictions")}
    rows = [df.agg(*figures).select(F.lit(name).alias("table_name"), F.lit("best").alias("model"), "n_rows", "n_positive") for name, df in tables.items()]
    counted = spark.read.parquet(f"{out}/results/run_counts").select(
        F.concat_ws(" ", F.lit("counted"), "stage", "figure").alias("table_name"), F.lit("run").alias("model"),
        F.col("n").alias("n_rows"), F.lit(None).cast("long").alias("n_positive"),
    )
    resumed = [{"table_name": f"resumed {stage}", "model": "run", "n_rows": int("stopped_after" in stopped), "n_positive": None} for stage in run["resumed"]]
    return reduce(DataFrame.unionByName, [compared, *rows, counted, local_frame(spark, resumed, compared.schema)])


# --- streams -------------------------------------------------------------------------


def _stream_scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineModel, DataFrame]:
    """Raw encounters scored as a stream by one saved pipeline that also prepares them."""
    raw_path, model_path, out, checkpoint = (
        scratch_path(spark, f"stream-{part}") for part in ("raw", "model", "out", "checkpoint")
    )
    raw = written(encounters(spark, sf_dir), raw_path)
    name = "Logistic Regression"
    trained = train_on_raw(*split.prepare_train_test_split(raw), models={name: {}})
    save_model(trained[name].model, model_path)
    model = load_model(spark, model_path)
    stream = read_stream(spark, raw_path, raw.schema)
    scored = score_stream(model, stream).select(ROW_KEY, "prediction", SCORE)
    write_stream(scored, out, checkpoint).awaitTermination()
    return spark.read.parquet(out), model, raw


@register
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_scored(spark, sf_dir)[0]


@register
def stream_matches_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored as a stream, and whether scoring them as a batch gives the same."""
    streamed, model, raw = _stream_scored(spark, sf_dir)
    batch = scoring.make_predictions(model, raw).select(ROW_KEY, F.col(SCORE).alias("_batch"))
    both = streamed.join(batch, ROW_KEY, "full")
    return both.select(ROW_KEY, F.coalesce(F.col(SCORE) == F.col("_batch"), F.lit(False)).alias("same_as_batch"))


def _scored_events(events: DataFrame, *columns: str) -> DataFrame:
    """Events with a time that streams take (a timestamp with zone) and a score."""
    return events.select(*columns, F.col("ts").cast("timestamp").alias("at"), (F.col("value") / (F.col("value") + 35.0)).alias("score"))


def _plain_times(windows: DataFrame) -> DataFrame:
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register
def stream_high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-risk events per day: closed days from the event stream, days still open from a batch."""
    out, checkpoint = (scratch_path(spark, f"windows-{part}") for part in ("out", "checkpoint"))
    events = read_table(spark, sf_dir, "events")
    # a stream source takes a folder or a glob; the brackets make a glob of a single file
    stream = read_stream(spark, f"{sf_dir.rstrip('/')}/[e]vents.parquet", events.schema)
    write_stream(high_risk_by_window(_scored_events(stream), "at", score="score"), out, checkpoint).awaitTermination()
    still_open = open_windows(_scored_events(events), "at", score="score")
    return _plain_times(spark.read.parquet(out).unionByName(still_open))


@register
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-risk events per day from four deliveries, the third of them late; the stream restarts for each.

    Days that the stream closed come from the stream, with the number of rows that it
    dropped; days still open come from a batch over the rows that were in time.
    """
    source, out, checkpoint, kept = (scratch_path(spark, f"late-{part}") for part in ("source", "out", "checkpoint", "events"))
    events = read_table(spark, sf_dir, "events")
    first = events.agg(F.min("ts").alias("t")).first()["t"]
    day = F.datediff("ts", F.lit(first).cast("timestamp_ntz"))
    held_back = (day < 20) & (F.col("event_id") % 7 == 0)
    delivery = F.when(held_back, 2).when(day < 10, 0).when(day < 20, 1).otherwise(3)
    scored = written(_scored_events(events.withColumn("delivery", delivery), "delivery"), kept, ["delivery"])

    def start():
        stream = read_stream(spark, source, scored.drop("delivery").schema)
        return write_stream(high_risk_by_window(stream, "at", score="score"), out, checkpoint)

    replay((scored.filter(F.col("delivery") == d).drop("delivery") for d in range(4)), source, start)
    closed = late_report(spark.read.parquet(out), scored, "at").drop("n_arrived").withColumn("closed", F.lit(True))
    in_time = mark_late(scored, "at", "delivery").filter("NOT late")
    still_open = open_windows(in_time, "at", score="score").withColumns({"n_dropped": F.lit(0).cast("long"), "closed": F.lit(False)})
    return _plain_times(closed.unionByName(still_open))


@register
def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored in batches, one of which is cut off after its write and comes again: which rows arrived, and how often."""
    source, out, checkpoint = (scratch_path(spark, f"redelivered-{part}") for part in ("source", "out", "checkpoint"))
    events = read_table(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(source)
    write, cut = batch_writer(out), [1]

    def interrupted(batch: DataFrame, number: int) -> None:
        write(batch, number)
        if number in cut:
            cut.remove(number)
            raise RuntimeError("cut off after the write")

    def run() -> None:
        stream = _scored_events(read_stream(spark, source, events.schema, 1), "event_id")
        write_batches(stream.drop("at"), interrupted, checkpoint).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        run()
    arrived = spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))
    return rounded(arrived.withColumn("cut_off", F.lit(not cut)), "score")
