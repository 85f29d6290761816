"""Preparation as a pipeline stage, so that one saved pipeline scores raw encounters.

Fitting the stage on the training part only also keeps held-out rows out of the
drop decisions and medians.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.comparison import ModelResult
from riskloom.operators.training import train_all_models
from riskloom.plans.preparation import FEATURE_INPUTS, Preparation, apply_preparation, clean_rows, learn_preparation
from riskloom.schemas import (
    ENCOUNTER_FEATURES,
    EXCLUDED_DISCHARGES,
    MISSING_THRESHOLD,
    UNTESTED_VALUES,
    FeatureSpec,
)


class _PreparationParams(Params):
    threshold = Param(Params._dummy(), "threshold", "missing percentage above which a column is dropped",
                      typeConverter=TypeConverters.toFloat)
    protect = Param(Params._dummy(), "protect", "columns never dropped", typeConverter=TypeConverters.toListString)
    untestedValues = Param(Params._dummy(), "untestedValues", "lab values that mean not tested",
                           typeConverter=TypeConverters.toListString)
    excludeIds = Param(Params._dummy(), "excludeIds", "discharge codes to leave out",
                       typeConverter=TypeConverters.toListInt)
    keepType = Param(Params._dummy(), "keepType", "cast filled columns back", typeConverter=TypeConverters.toBoolean)

    def _defaults(self) -> None:
        self._setDefault(
            threshold=MISSING_THRESHOLD, protect=list(FEATURE_INPUTS), untestedValues=list(UNTESTED_VALUES),
            excludeIds=list(EXCLUDED_DISCHARGES), keepType=False,
        )


class EncounterPreparer(Estimator, _PreparationParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which columns to drop and what to fill in."""

    @keyword_only
    def __init__(self, *, threshold=None, protect=None, untestedValues=None, excludeIds=None, keepType=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> EncounterPreparerModel:
        cleaned = clean_rows(dataset, self.getOrDefault(self.excludeIds))
        learned = learn_preparation(cleaned, self.getOrDefault(self.threshold), self.getOrDefault(self.protect))
        model = EncounterPreparerModel()
        self._copyValues(model)
        return model._set(learned=json.dumps({"dropped": learned.dropped, "medians": dict(learned.medians)}))


class EncounterPreparerModel(Model, _PreparationParams, DefaultParamsReadable, DefaultParamsWritable):
    """Cleans rows and derives features with what was learned; also works on streams."""

    learned = Param(Params._dummy(), "learned", "learned drops and medians, as JSON",
                    typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._defaults()

    def preparation(self) -> Preparation:
        learned = json.loads(self.getOrDefault(self.learned))
        return Preparation(dropped=tuple(learned["dropped"]), medians=learned["medians"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cleaned = clean_rows(dataset, self.getOrDefault(self.excludeIds))
        return apply_preparation(
            cleaned, self.preparation(), self.getOrDefault(self.keepType), self.getOrDefault(self.untestedValues)
        )


class ExpressionStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A user's own feature step: named SQL expressions, saved with the pipeline.

    ``columns`` maps new (or replaced) columns to expressions over the columns before the step;
    ``needs`` maps input columns to their types, checked against every frame before Spark
    sees the expressions, so that a loaded pipeline names what does not fit. Works on streams.
    """

    columns = Param(Params._dummy(), "columns", "column names and their SQL expressions, as JSON", typeConverter=TypeConverters.toString)
    needs = Param(Params._dummy(), "needs", "input columns and their types, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, columns: Mapping[str, str] | None = None, needs: Mapping[str, str] | None = None):
        super().__init__()
        self._set(columns=json.dumps(dict(columns or {})), needs=json.dumps(dict(needs or {})))

    def check(self, dataset: DataFrame) -> None:
        types = dict(dataset.dtypes)
        wrong = {c: types.get(c, "absent") for c, t in json.loads(self.getOrDefault(self.needs)).items() if types.get(c) != t}
        if wrong:
            raise ValueError(f"step {self.uid} needs {self.getOrDefault(self.needs)}; found {wrong}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.check(dataset)
        return dataset.withColumns({c: F.expr(e) for c, e in json.loads(self.getOrDefault(self.columns)).items()})


def train_on_raw(
    raw_train: DataFrame,
    raw_test: DataFrame,
    preparer: EncounterPreparer | None = None,
    features: FeatureSpec = ENCOUNTER_FEATURES,
    models: Mapping[str, Mapping[str, Any]] | None = None,
    max_categories: int | None = None,
    steps: Sequence[Transformer] = (),
) -> dict[str, ModelResult]:
    """Train models whose pipelines take raw encounters.

    Preparation learns from the training part only; classes are weighted as in
    ``train_all_models``. ``steps`` follow preparation, in training and in the saved
    pipelines; name what they derive in ``features``.
    """
    prepare = PipelineModel(stages=[(preparer or EncounterPreparer()).fit(raw_train), *steps])
    train, test = prepare.transform(raw_train), prepare.transform(raw_test)
    spec = features.available(train.columns)
    results, _ = train_all_models(train, test, spec.numeric, spec.binary, spec.categorical, models, max_categories=max_categories)
    return {
        name: ModelResult(PipelineModel(stages=[*prepare.stages, *result.model.stages]), result.predictions)
        for name, result in results.items()
    }
