"""From raw encounters to model features."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.cleaning import (
    MEDIAN_ACCURACY,
    clean_gender_column,
    counts_and_medians,
    create_target_variable,
    fill_categories,
    fill_values,
    remove_invalid_records,
    replace_missing_indicators,
)
from riskloom.operators.features import REQUIRED_COLUMNS, derive_features
from riskloom.schemas import (
    CATEGORY_FILL_COLUMNS,
    ENCOUNTER_FEATURES,
    EXCLUDED_DISCHARGES,
    MEDIAN_FILL_COLUMNS,
    MISSING_THRESHOLD,
    UNTESTED_VALUES,
)
from riskloom.sources.encounters_csv import load_data

FEATURE_INPUTS = tuple(c for group in REQUIRED_COLUMNS.values() for c in group)


@dataclass(frozen=True)
class Preparation:
    """What cleaning learned from data: columns to drop and values to fill in."""

    n_rows: int = 0
    null_counts: Mapping[str, int] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()
    medians: Mapping[str, float] = field(default_factory=dict)
    all_missing: tuple[str, ...] = ()


def clean_rows(
    df: DataFrame,
    exclude_ids: Sequence[int] = EXCLUDED_DISCHARGES,
    outcome: str = "readmitted",
) -> DataFrame:
    """Label (where the outcome is known), sentinels, exclusions: all without looking at the data."""
    labelled = create_target_variable(df, outcome) if outcome in df.columns else df
    return remove_invalid_records(replace_missing_indicators(labelled), exclude_ids)


def learn_preparation(
    cleaned: DataFrame,
    threshold: float = MISSING_THRESHOLD,
    protect: Collection[str] = (),
    exact_median: bool = False,
    accuracy: int = MEDIAN_ACCURACY,
) -> Preparation:
    """NULL counts of all columns and medians of the number columns, in a single pass.

    Exact medians are ranked separately. A number column without any value is
    reported in ``all_missing`` and not filled.
    """
    columns = cleaned.columns
    numbers = [c for c in MEDIAN_FILL_COLUMNS if c in columns]
    rows, nulls, medians = counts_and_medians(cleaned, columns, numbers, exact_median, accuracy)
    dropped = tuple(c for c in columns if rows and nulls[c] / rows * 100 > threshold and c not in set(protect))
    kept = [c for c in numbers if c not in dropped]
    return Preparation(
        rows, nulls, dropped,
        medians={c: medians[c] for c in kept if c in medians},
        all_missing=tuple(c for c in kept if nulls[c] and c not in medians),
    )


def apply_preparation(
    cleaned: DataFrame,
    learned: Preparation,
    keep_type: bool = False,
    untested_values: Sequence[str] = UNTESTED_VALUES,
) -> DataFrame:
    """Drop, fill, standardise and derive features; lazy."""
    kept = cleaned.drop(*learned.dropped)
    filled = fill_values(fill_categories(kept, CATEGORY_FILL_COLUMNS), learned.medians, keep_type)
    return derive_features(clean_gender_column(filled), untested_values)


def prepare_encounters(
    raw: DataFrame,
    threshold: float = MISSING_THRESHOLD,
    protect: Collection[str] = FEATURE_INPUTS,
    exact_median: bool = False,
    keep_type: bool = False,
    untested_values: Sequence[str] = UNTESTED_VALUES,
    exclude_ids: Sequence[int] = EXCLUDED_DISCHARGES,
    watch: Observation | None = None,
) -> DataFrame:
    """Feature table of raw encounters. One job looks at the data; the result is lazy.

    Columns that features are made of are never dropped unless ``protect`` says so.
    ``watch`` gets ``rows_before``, the rows before exclusions, from the first job on the result.
    """
    learned = learn_preparation(clean_rows(raw, exclude_ids), threshold, protect, exact_median)
    seen = raw if watch is None else raw.observe(watch, F.count(F.lit(1)).alias("rows_before"))
    return apply_preparation(clean_rows(seen, exclude_ids), learned, keep_type, untested_values)


def preprocess_data(
    spark: SparkSession, file_path: str, infer: bool = False, **options
) -> tuple[DataFrame, list[str], list[str], list[str]]:
    """Load a CSV file and prepare it; returns the table and its three feature lists."""
    df = prepare_encounters(load_data(spark, file_path, infer=infer), **options)
    spec = ENCOUNTER_FEATURES
    return df, list(spec.numeric), list(spec.binary), list(spec.categorical)
