"""Column names, schemas and fixed values of the encounter data model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns feed a model, by kind."""

    numeric: tuple[str, ...]
    binary: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def all(self) -> tuple[str, ...]:
        return self.numeric + self.binary + self.categorical

    def available(self, columns: Sequence[str]) -> FeatureSpec:
        """The part of the spec whose columns exist."""
        have = set(columns)
        return FeatureSpec(
            *(tuple(c for c in group if c in have) for group in (self.numeric, self.binary, self.categorical))
        )


# --- Fixed values: names, codes, labels and thresholds of the data set. -------------

ENTITY_KEY = "patient_nbr"
ROW_KEY = "encounter_id"
LABEL = "readmit_30"
SCORE = "readmission_probability"

MISSING_INDICATOR = "?"
MISSING_THRESHOLD = 50.0
POSITIVE_OUTCOME = "<30"
EXCLUDED_DISCHARGES = (11, 13, 14, 19, 20, 21)
GENDERS = ("Male", "Female")
UNKNOWN = "Unknown"

TRAIN_RATIO = 0.8
TEST_RATIO = 0.2
SPLIT_SEED = 42
HIGH_RISK_THRESHOLD = 0.5
SWEEP_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
RETRAIN_BELOW_AUC = 0.60
SELECTION_METRICS = ("AUC_ROC", "AUC_PR", "F1_Score", "Accuracy")

CATEGORY_FILL_COLUMNS = (
    "race", "gender", "medical_specialty", "payer_code",
    "max_glu_serum", "A1Cresult", "change", "diabetesMed",
)
MEDIAN_FILL_COLUMNS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
)

ADMISSION_TYPE_GROUPS = {
    "Emergency": (1,),
    "Urgent": (2,),
    "Elective": (3,),
    "Newborn": (4,),
}
ADMISSION_SOURCE_GROUPS = {
    "Emergency_Room": (7,),
    "Physician_Referral": (1,),
    "Clinic_HMO_Referral": (2, 3),
    "Transfer_Facility": (4, 5, 6, 10, 22, 25, 26),
}
DISCHARGE_GROUPS = {
    "Home": (1, 6, 8),
    "Transfer_Facility": (2, 3, 4, 5, 15, 22, 23, 24, 27, 28, 29, 30),
    "Left_AMA": (7,),
}
UNTESTED_VALUES = ("None",)
A1C_ABNORMAL = (">7", ">8")
INSULIN_GIVEN = ("Down", "Steady", "Up")
MEDICATION_CHANGED = "Ch"
ELDERLY_FROM = 65
HIGH_UTILIZER_FROM = 3
FREQUENT_ER_FROM = 2

# (upper bound, name); a band holds scores from the previous bound up to, not with, its own.
RISK_BANDS = ((0.3, "low"), (0.5, "moderate"), (0.7, "high"), (None, "very_high"))

ADMISSION_TYPES = {
    1: "Emergency", 2: "Urgent", 3: "Elective", 4: "Newborn",
    5: "Not Available", 6: "NULL", 7: "Trauma Center", 8: "Not Mapped",
}
DISCHARGE_DISPOSITIONS = {
    1: "Discharged to home",
    2: "Transferred to short term hospital",
    3: "Transferred to SNF",
    4: "Transferred to ICF",
    5: "Transferred to other inpatient care",
    6: "Home with home health service",
    7: "Left AMA",
    8: "Home under care of Home IV provider",
    9: "Admitted as inpatient to this hospital",
    10: "Neonate transferred for aftercare",
    11: "Expired",
    12: "Still patient/expected to return",
    13: "Hospice / home",
    14: "Hospice / medical facility",
    15: "Transferred to Medicare swing bed",
    16: "Transferred for outpatient services",
    17: "Referred to this institution outpatient",
    18: "NULL",
    19: "Expired at home (Medicaid hospice)",
    20: "Expired in medical facility (Medicaid hospice)",
    21: "Expired place unknown (Medicaid hospice)",
    22: "Transferred to rehab facility",
    23: "Transferred to long term care hospital",
    24: "Transferred to Medicaid nursing facility",
    25: "Not Mapped",
    26: "Unknown/Invalid",
    27: "Transferred to federal health care facility",
    28: "Transferred to psychiatric hospital",
    29: "Transferred to Critical Access Hospital",
    30: "Transferred to other health care institution",
}
ADMISSION_SOURCES = {
    1: "Physician Referral",
    2: "Clinic Referral",
    3: "HMO Referral",
    4: "Transfer from hospital",
    5: "Transfer from SNF",
    6: "Transfer from other health care facility",
    7: "Emergency Room",
    8: "Court/Law Enforcement",
    9: "Not Available",
    10: "Transfer from Critical Access Hospital",
    11: "Normal Delivery",
    12: "Premature Delivery",
    13: "Sick Baby",
    14: "Extramural Birth",
    15: "Not Available",
    17: "NULL",
    18: "Transfer from Home Health Agency",
    19: "Readmission to Same Home Health Agency",
    20: "Not Mapped",
    21: "Unknown/Invalid",
    22: "Transfer from hospital inpatient (separate claim)",
    23: "Born inside this hospital",
    24: "Born outside this hospital",
    25: "Transfer from Ambulatory Surgery Center",
    26: "Transfer from Hospice",
}

# Age ranges are ten years wide; the midpoint stands for the range.
AGE_MIDPOINTS = {f"[{low}-{low + 10})": low + 5 for low in range(0, 100, 10)}

ENCOUNTER_FEATURES = FeatureSpec(
    numeric=MEDIAN_FILL_COLUMNS + ("total_prior_visits", "complexity_score", "age_numeric"),
    binary=(
        "emergency_admission", "admitted_from_er", "discharged_not_home",
        "left_ama", "high_utilizer", "frequent_er_visitor", "is_elderly",
        "a1c_tested", "a1c_abnormal", "glucose_tested", "on_insulin", "med_changed",
    ),
    categorical=("race", "gender", "admission_type_group", "admission_source_group", "discharge_group"),
)

# --- End of fixed values. ------------------------------------------------------------

_BIGINT_COLUMNS = (ROW_KEY, ENTITY_KEY)
_INT_COLUMNS = (
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
) + MEDIAN_FILL_COLUMNS


def encounter_schema(columns: Sequence[str], types: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Schema for a file with these columns: keys bigint, codes and counts int, else string.

    ``types`` overrides single columns, e.g. for tables of another shape.
    """
    known: dict[str, T.DataType] = {c: T.LongType() for c in _BIGINT_COLUMNS}
    known.update({c: T.IntegerType() for c in _INT_COLUMNS})
    known.update(types or {})
    return T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in columns])


COMPARISON_SCHEMA = T.StructType(
    [T.StructField("Model", T.StringType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("AUC_ROC", "AUC_PR", "Accuracy", "F1_Score", "Precision", "Recall")
    ]
    + [
        T.StructField(c, T.LongType())
        for c in ("True_Positives", "True_Negatives", "False_Positives", "False_Negatives")
    ]
)
