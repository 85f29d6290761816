"""Feature encoding, the three classifiers, and what they learned."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.comparison import ModelResult
from riskloom.operators.layout import ROWS_PER_TASK, dealt
from riskloom.operators.scoring import make_predictions
from riskloom.operators.split import add_sample_weights, class_counts, class_weights
from riskloom.schemas import ENTITY_KEY, LABEL, ROW_KEY, SPLIT_SEED
from riskloom.session import ensure_checkpoint_dir, keep_methods_compiled, local_frame, scratch_path
from riskloom.sources.sinks import load_model, save_model

UNSCALED, FEATURES, WEIGHT = "features_unscaled", "features", "sample_weight"

# Settings of the three classifiers.
MODEL_SETTINGS: dict[str, dict[str, Any]] = {
    "Logistic Regression": {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5},
    "Random Forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5, "seed": SPLIT_SEED},
    "Gradient Boosted Trees": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": SPLIT_SEED},
}
# How a fit goes about its work; the trees are the same. Each row keeps the node it has reached in every tree instead
# of walking from the root at each level; a forest has too few levels for a checkpoint of that to pay.
WORK_SETTINGS: dict[str, dict[str, Any]] = {"Random Forest": {"cacheNodeIds": True, "checkpointInterval": -1}}
CLASSIFIERS = {
    "Logistic Regression": LogisticRegression,
    "Random Forest": RandomForestClassifier,
    "Gradient Boosted Trees": GBTClassifier,
}


def create_feature_pipeline(
    numeric_features: Sequence[str],
    binary_features: Sequence[str],
    categorical_features: Sequence[str],
    handle_invalid: str = "skip",
) -> tuple[Pipeline, str]:
    """Index and one-hot encode categories, assemble all features in order, scale to unit deviation.

    A category unseen in training encodes to all zeros. Rows with a missing
    feature are skipped; see ``scoring.unscored_rows``.
    """
    indexed = [f"{c}_indexed" for c in categorical_features]
    encoded = [f"{c}_encoded" for c in categorical_features]
    stages: list[Any] = []
    if categorical_features:
        stages += [
            StringIndexer(inputCols=list(categorical_features), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
    stages += [
        VectorAssembler(
            inputCols=[*numeric_features, *binary_features, *encoded],
            outputCol=UNSCALED,
            handleInvalid=handle_invalid,
        ),
        StandardScaler(inputCol=UNSCALED, outputCol=FEATURES, withStd=True, withMean=False),
    ]
    return Pipeline(stages=stages), FEATURES


def check_category_sizes(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> None:
    """Stop before a key-like column is indexed: its values all go to the driver and into vectors.

    Counts, approximately, only if there is a limit.
    """
    if not columns or limit is None:
        return
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    over = {c: n for c, n in sizes.items() if n > limit}
    if over:
        raise ValueError(f"too many categories (limit {limit}): {over}")


def make_classifier(name: str, label: str = LABEL, weight: str | None = WEIGHT, **overrides: Any):
    """One of the three classifiers, with its standard settings unless overridden."""
    settings = {**WORK_SETTINGS.get(name, {}), **MODEL_SETTINGS[name], **overrides, "featuresCol": FEATURES, "labelCol": label}
    if weight:
        settings["weightCol"] = weight
    return CLASSIFIERS[name](**settings)


def training_rows(
    train_df: DataFrame,
    numeric_features: Sequence[str],
    binary_features: Sequence[str],
    categorical_features: Sequence[str],
    label: str = LABEL,
    keys: Sequence[str] = (ENTITY_KEY, ROW_KEY),
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, PipelineModel]:
    """Encoded and weighted training rows, dealt to tasks and kept on the executors, and the fitted feature stages."""
    wanted = [*numeric_features, *binary_features, *categorical_features]
    columns = [*[c for c in keys if c in train_df.columns and c not in wanted], *wanted, label]
    pruned = train_df.select(*columns)
    counts = {row[label]: row["n"] for row in class_counts(pruned, label).collect()}
    laid = dealt(pruned, columns, sum(counts.values()), rows_per_task)
    weighted = add_sample_weights(laid, *class_weights(counts, label), label).persist(StorageLevel.MEMORY_AND_DISK)
    pipeline, _ = create_feature_pipeline(numeric_features, binary_features, categorical_features)
    try:
        encoder = pipeline.fit(weighted)
        rows = encoder.transform(weighted).select(FEATURES, label, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
    finally:
        weighted.unpersist()
    return rows, encoder


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The pipeline as it is after saving and loading.

    A training summary holds the session, which tasks can't be sent once an ``Observation`` was used in it.
    """
    classifier = model.stages[-1]
    if not getattr(classifier, "hasSummary", False):
        return model
    spark = SparkSession.active()
    path = scratch_path(spark, "fitted")
    save_model(model, path)
    return load_model(spark, path)


def train_all_models(
    train_df: DataFrame,
    test_df: DataFrame,
    numeric_features: Sequence[str],
    binary_features: Sequence[str],
    categorical_features: Sequence[str],
    models: Mapping[str, Mapping[str, Any]] | None = None,
    label: str = LABEL,
    keys: Sequence[str] = (ENTITY_KEY, ROW_KEY),
    max_categories: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    on_fitted: Callable[[str, PipelineModel], None] | None = None,
) -> tuple[dict[str, ModelResult], PipelineModel]:
    """Fit the feature stages and every classifier on the training part only.

    ``models`` maps the names to train to setting overrides; the default is all
    three. Each result holds a whole pipeline (feature stages and classifier), which
    scores prepared rows after being saved and loaded, and lazy predictions for the
    test part. Training rows are dealt to tasks of about ``rows_per_task`` rows (more in large
    tables, see ``layout``) by their keys, so that what is fitted doesn't depend on the files they came from; the encoded
    vectors are kept on the executors during the fits, and rebuilt from the source if an
    executor is lost. All labels of a category column reach the driver, as indexing needs
    them; ``max_categories`` refuses more. ``on_fitted`` is called with each whole pipeline
    as soon as it is fitted.
    """
    models = models if models is not None else {name: {} for name in MODEL_SETTINGS}
    ensure_checkpoint_dir(train_df.sparkSession)
    keep_methods_compiled(train_df.sparkSession)
    check_category_sizes(train_df, categorical_features, max_categories)
    wanted = [*numeric_features, *binary_features, *categorical_features]
    rows, encoder = training_rows(train_df, numeric_features, binary_features, categorical_features, label, keys, rows_per_task)
    fitted = {}
    try:
        for name, overrides in models.items():
            classifier = make_classifier(name, label, **overrides).fit(rows)
            fitted[name] = _without_summary(PipelineModel(stages=[*encoder.stages, classifier]))
            if on_fitted:
                on_fitted(name, fitted[name])
    finally:
        rows.unpersist()

    present = [c for c in (*keys, label) if c in test_df.columns]
    test_rows = test_df.select(*present, *[c for c in wanted if c not in present])
    return {name: ModelResult(whole, make_predictions(whole, test_rows)) for name, whole in fitted.items()}, encoder


def assembled_columns(model: PipelineModel) -> list[str]:
    """Columns of the input that must not be NULL for a row to be scored; NULL categories are indexed."""
    made = {c for stage in model.stages if hasattr(stage, "getOutputCols") for c in stage.getOutputCols()}
    return [c for stage in model.stages if isinstance(stage, VectorAssembler) for c in stage.getInputCols() if c not in made]


def slot_names(encoder: PipelineModel, like: DataFrame) -> list[str]:
    """Name of each slot of the feature vector; the scaler drops them, the assembler has them."""
    assembled = like.limit(0)
    for stage in encoder.stages:
        assembled = stage.transform(assembled)
        if UNSCALED in assembled.columns:
            break
    attrs = assembled.schema[UNSCALED].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


def importances(classifier: Any) -> list[float]:
    """Importance per slot: of the trees, or the absolute coefficients."""
    if hasattr(classifier, "featureImportances"):
        return [float(v) for v in classifier.featureImportances.toArray()]
    return [abs(float(v)) for v in classifier.coefficients.toArray()]


def feature_importance(
    spark: SparkSession, names: Sequence[str], values: Sequence[float], n: int | None = 15
) -> DataFrame:
    """Features by falling importance, the first ``n`` of them (all for None)."""
    schema = T.StructType().add("feature", T.StringType()).add("importance", T.DoubleType())
    table = local_frame(spark, [{"feature": f, "importance": float(v)} for f, v in zip(names, values)], schema)
    ordered = table.orderBy(F.desc("importance"), F.asc("feature"))
    return ordered if n is None else ordered.limit(n)


def model_importance(model: PipelineModel, like: DataFrame, n: int | None = 15) -> DataFrame:
    """Feature importance of a whole pipeline; ``like`` is any frame with its input columns."""
    names = slot_names(PipelineModel(stages=model.stages[:-1]), like)
    return feature_importance(like.sparkSession, names, importances(model.stages[-1]), n)


def category_index(encoder: PipelineModel, spark: SparkSession) -> DataFrame:
    """The learned index of every category."""
    rows = []
    for stage in encoder.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                rows += [{"column_name": column, "value": value, "idx": i} for i, value in enumerate(labels)]
    schema = T.StructType().add("column_name", T.StringType()).add("value", T.StringType()).add("idx", T.IntegerType())
    return local_frame(spark, rows, schema)


def feature_slots(encoded: DataFrame, names: Sequence[str], key: str, vector: str = FEATURES) -> DataFrame:
    """Non-zero vector slots as rows (key, slot, value): a readable form of encoded features."""
    slots = F.arrays_zip(F.array(*map(F.lit, names)).alias("slot"), vector_to_array(vector).alias("value"))
    return encoded.select(key, F.explode(slots).alias("_s")).select(
        key, F.col("_s.slot").alias("slot"), F.col("_s.value").alias("value")
    ).filter("value <> 0")
