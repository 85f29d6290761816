import pytest
from pyspark.ml.feature import VectorAssembler

from riskloom.functions import risk_band
from riskloom.operators import features
from riskloom.operators.scoring import make_predictions


def test_admission_groups(spark):
    df = spark.createDataFrame(
        [(1, 7), (2, 1), (3, 3), (4, 26), (5, 20), (None, None)], "admission_type_id int, admission_source_id int"
    )
    rows = features.create_admission_features(df).collect()
    assert [r.admission_type_group for r in rows] == ["Emergency", "Urgent", "Elective", "Newborn", "Other_Unknown", "Other_Unknown"]
    assert [r.emergency_admission for r in rows] == [1, 0, 0, 0, 0, 0]
    assert [r.admission_source_group for r in rows] == [
        "Emergency_Room", "Physician_Referral", "Clinic_HMO_Referral", "Transfer_Facility", "Other", "Other",
    ]
    assert [r.admitted_from_er for r in rows] == [1, 0, 0, 0, 0, 0]


def test_discharge_groups(spark):
    df = spark.createDataFrame([(1,), (30,), (7,), (9,), (None,)], "discharge_disposition_id int")
    rows = features.create_discharge_features(df).collect()
    assert [(r.discharge_group, r.discharged_not_home, r.left_ama) for r in rows] == [
        ("Home", 0, 0), ("Transfer_Facility", 1, 0), ("Left_AMA", 1, 1), ("Other", 1, 0), ("Other", 1, 0),
    ]


def test_utilization_nulls(spark):
    columns = ["number_outpatient", "number_emergency", "number_inpatient", "num_procedures", "num_medications", "number_diagnoses"]
    df = spark.createDataFrame([(1, 2, 0, 1, 1, 1), (None, 2, 5, None, 1, 1), (0, 0, 2, 2, 2, 3)], ",".join(f"{c} int" for c in columns))
    rows = features.create_utilization_features(df).collect()
    assert [r.total_prior_visits for r in rows] == [3, None, 2]
    assert [r.high_utilizer for r in rows] == [1, 0, 0]
    assert [r.frequent_er_visitor for r in rows] == [1, 1, 0]
    assert [r.complexity_score for r in rows] == [1.0, None, pytest.approx(7 / 3)]


def test_age(spark):
    df = spark.createDataFrame([("[0-10)",), ("[60-70)",), ("[90-100)",), ("old",), (None,)], "age string")
    rows = features.create_age_features(df).collect()
    assert [(r.age_numeric, r.is_elderly) for r in rows] == [(5, 0), (65, 1), (95, 1), (None, 0), (None, 0)]


def test_lab(spark):
    df = spark.createDataFrame(
        [("None", "None", "No", "No"), (">7", ">300", "Up", "Ch"), ("none", None, "Steady", None), (None, "Norm", None, "Ch")],
        "A1Cresult string, max_glu_serum string, insulin string, change string",
    )
    rows = features.create_lab_test_features(df).collect()
    assert [(r.a1c_tested, r.a1c_abnormal, r.glucose_tested, r.on_insulin, r.med_changed) for r in rows] == [
        (0, 0, 0, 0, 0), (1, 1, 1, 1, 1), (1, 0, 0, 1, 0), (0, 0, 1, 0, 1),
    ]


def test_missing_input_column_is_named(spark):
    with pytest.raises(ValueError, match="A1Cresult"):
        features.create_lab_test_features(spark.createDataFrame([("No", "No")], "insulin string, change string"))


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.5,), (0.7,), (1.0,), (None,)], "s double")
    assert [r.b for r in df.select(risk_band("s").alias("b")).collect()] == [
        "low", "moderate", "high", "very_high", "very_high", None,
    ]


def test_one_projection_per_chain(spark):
    columns = {c: "string" if c in ("age", *features.REQUIRED_COLUMNS["lab"]) else "int" for g in features.REQUIRED_COLUMNS.values() for c in g}
    df = spark.createDataFrame([], ",".join(f"{c} {t}" for c, t in columns.items()))
    plan = features.derive_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_user_step_between_stock_steps(spark):
    df = spark.createDataFrame([(1, 7, 1)], "admission_type_id int, admission_source_id int, discharge_disposition_id int")
    mine = lambda d: d.selectExpr("*", "emergency_admission * 10 AS boosted")
    row = df.transform(features.create_admission_features).transform(mine).transform(features.create_discharge_features).first()
    assert (row.boosted, row.discharge_group) == (10, "Home")


def test_scoring_generates_no_method_that_stays_interpreted(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    rows = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    try:
        for own, expected in (("65535", "8000"), ("20000", "20000")):  # Spark's default gives way, a limit of the user's stays
            spark.conf.set(limit, own)
            scored = make_predictions(VectorAssembler(inputCols=["a", "b"], outputCol="v", handleInvalid="skip"), rows, include_probability=False)
            assert spark.conf.get(limit) == expected and scored.count() == 1
    finally:
        spark.conf.set(limit, before)
