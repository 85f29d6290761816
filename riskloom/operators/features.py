"""Feature derivation: five groups of scalar expressions, one projection each.

Flags are 1/0 and a NULL input gives 0, unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import code_group, flag, require_columns
from riskloom.functions.expressions import lookup_map
from riskloom.schemas import (
    A1C_ABNORMAL,
    ADMISSION_SOURCE_GROUPS,
    ADMISSION_TYPE_GROUPS,
    AGE_MIDPOINTS,
    DISCHARGE_GROUPS,
    ELDERLY_FROM,
    FREQUENT_ER_FROM,
    HIGH_UTILIZER_FROM,
    INSULIN_GIVEN,
    MEDICATION_CHANGED,
    UNTESTED_VALUES,
)

REQUIRED_COLUMNS = {
    "admission": ("admission_type_id", "admission_source_id"),
    "discharge": ("discharge_disposition_id",),
    "utilization": (
        "number_outpatient", "number_emergency", "number_inpatient",
        "num_procedures", "num_medications", "number_diagnoses",
    ),
    "age": ("age",),
    "lab": ("A1Cresult", "max_glu_serum", "insulin", "change"),
}


def create_admission_features(df: DataFrame) -> DataFrame:
    require_columns(df, REQUIRED_COLUMNS["admission"], "create_admission_features")
    return df.withColumns({
        "admission_type_group": code_group("admission_type_id", ADMISSION_TYPE_GROUPS, "Other_Unknown"),
        "emergency_admission": flag(F.col("admission_type_id").isin(*ADMISSION_TYPE_GROUPS["Emergency"])),
        "admission_source_group": code_group("admission_source_id", ADMISSION_SOURCE_GROUPS, "Other"),
        "admitted_from_er": flag(F.col("admission_source_id").isin(*ADMISSION_SOURCE_GROUPS["Emergency_Room"])),
    })


def create_discharge_features(df: DataFrame) -> DataFrame:
    """``discharged_not_home`` is 1 for an unknown (NULL) discharge."""
    require_columns(df, REQUIRED_COLUMNS["discharge"], "create_discharge_features")
    code = F.col("discharge_disposition_id")
    return df.withColumns({
        "discharge_group": code_group("discharge_disposition_id", DISCHARGE_GROUPS, "Other"),
        "discharged_not_home": 1 - flag(code.isin(*DISCHARGE_GROUPS["Home"])),
        "left_ama": flag(code.isin(*DISCHARGE_GROUPS["Left_AMA"])),
    })


def create_utilization_features(df: DataFrame) -> DataFrame:
    """``total_prior_visits`` is NULL if any of its three counts is."""
    require_columns(df, REQUIRED_COLUMNS["utilization"], "create_utilization_features")
    prior = F.col("number_outpatient") + F.col("number_emergency") + F.col("number_inpatient")
    burden = F.col("num_procedures") + F.col("num_medications") + F.col("number_diagnoses")
    return df.withColumns({
        "total_prior_visits": prior,
        "high_utilizer": flag(prior >= HIGH_UTILIZER_FROM),
        "frequent_er_visitor": flag(F.col("number_emergency") >= FREQUENT_ER_FROM),
        "complexity_score": burden / F.lit(3.0),
    })


def create_age_features(df: DataFrame) -> DataFrame:
    """Midpoint of the age range; an unknown range gives NULL and is not elderly."""
    require_columns(df, REQUIRED_COLUMNS["age"], "create_age_features")
    midpoint = lookup_map(AGE_MIDPOINTS)[F.col("age")]
    return df.withColumns({"age_numeric": midpoint, "is_elderly": flag(midpoint >= ELDERLY_FROM)})


def create_lab_test_features(df: DataFrame, untested_values: Sequence[str] = UNTESTED_VALUES) -> DataFrame:
    """Lab and medication flags.

    A lab counts as done unless its value is in ``untested_values``. After the
    category fill a missing value is ``Unknown`` and so counts as done; add that
    name to ``untested_values`` to change it.
    """
    require_columns(df, REQUIRED_COLUMNS["lab"], "create_lab_test_features")
    return df.withColumns({
        "a1c_tested": flag(~F.col("A1Cresult").isin(*untested_values)),
        "a1c_abnormal": flag(F.col("A1Cresult").isin(*A1C_ABNORMAL)),
        "glucose_tested": flag(~F.col("max_glu_serum").isin(*untested_values)),
        "on_insulin": flag(F.col("insulin").isin(*INSULIN_GIVEN)),
        "med_changed": flag(F.col("change") == MEDICATION_CHANGED),
    })


def derive_features(df: DataFrame, untested_values: Sequence[str] = UNTESTED_VALUES) -> DataFrame:
    """All five groups."""
    return (
        df.transform(create_admission_features)
        .transform(create_discharge_features)
        .transform(create_utilization_features)
        .transform(create_age_features)
        .transform(create_lab_test_features, untested_values)
    )
