import pytest
from pyspark.sql import functions as F

from riskloom.operators import cleaning
from riskloom.plans.preparation import clean_rows, learn_preparation, prepare_encounters
from riskloom.sources import ENCOUNTER_LOOKUPS, lookup_frame
from riskloom.sources.encounters_csv import load_data


def test_sentinel_only_in_text_columns(spark):
    df = spark.createDataFrame([(1, "?", "a"), (2, "b", "?")], "id int, x string, y string")
    assert cleaning.replace_missing_indicators(df).collect() == [(1, None, "a"), (2, "b", None)]


def test_null_code_is_excluded_too(spark):
    df = spark.createDataFrame([(1, 11), (2, 1), (3, None)], "id int, discharge_disposition_id int")
    assert [r.id for r in cleaning.remove_invalid_records(df).collect()] == [2]
    report = cleaning.exclusion_report(df).first()
    assert (report.rows_before, report.rows_kept, report.rows_removed, report.removed_pct) == (3, 1, 2, 66.67)


def test_target_of_null_is_zero(spark):
    df = spark.createDataFrame([("<30",), (">30",), ("NO",), (None,)], "readmitted string")
    assert [r.readmit_30 for r in cleaning.create_target_variable(df).collect()] == [1, 0, 0, 0]


def test_gender(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Unknown/Invalid",), (None,)], "gender string")
    assert [r.gender for r in cleaning.clean_gender_column(df).collect()] == ["Male", "Female", "Unknown", "Unknown"]


def test_missing_profile_and_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, None, None), (4, "x", "y")], "id int, half string, most string")
    profile = {r.column_name: (r.null_count, r.missing_pct) for r in cleaning.missing_profile(df).collect()}
    assert profile == {"id": (0, 0.0), "half": (2, 50.0), "most": (3, 75.0)}
    # strictly more than the threshold
    assert cleaning.identify_high_missing_columns(df) == ["most"]
    assert cleaning.drop_high_missing_columns(df).columns == ["id", "half"]
    assert cleaning.drop_high_missing_columns(df, protect=["most"]).columns == ["id", "half", "most"]


def test_missing_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert cleaning.identify_high_missing_columns(df) == []
    assert [r.missing_pct for r in cleaning.missing_profile(df).collect()] == [None, None]


@pytest.mark.parametrize("exact", [True, False])
def test_median_fill_types(spark, exact):
    df = spark.createDataFrame(
        [(1, 1, 5), (None, 2, None), (3, 3, None), (8, 4, None)],
        "num_procedures int, num_medications int, other int",
    )
    filled = cleaning.fill_medians(df, exact=exact)
    assert dict(filled.dtypes) == {"num_procedures": "double", "num_medications": "double", "other": "int"}
    assert [r.num_procedures for r in filled.collect()] == [1.0, 3.0, 3.0, 8.0]
    assert dict(cleaning.fill_medians(df, exact=exact, keep_type=True).dtypes)["num_procedures"] == "int"


@pytest.mark.parametrize("exact", [True, False])
def test_all_missing_number_column_is_left_alone(spark, exact):
    df = spark.createDataFrame([(None, 1), (None, 2)], "num_procedures int, num_medications int")
    assert cleaning.fill_medians(df, exact=exact).collect() == [(None, 1), (None, 2)]


def test_exact_median_of_even_count(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10, None)], "num_procedures int")
    assert cleaning.exact_medians(df, ["num_procedures"]) == {"num_procedures": 2.5}


def test_approximate_median_is_within_its_error(spark):
    df = spark.range(10_001).select(F.col("id").cast("int").alias("num_procedures"))
    value = cleaning.approx_medians(df, ["num_procedures"])["num_procedures"]
    assert abs(value - 5_000) <= 101


def test_fill_categories_only_existing(spark):
    df = spark.createDataFrame([(None, None)], "race string, other string")
    assert cleaning.fill_categories(df).collect() == [("Unknown", None)]


def test_decode_missing_code(spark):
    lookup = lookup_frame(spark, ENCOUNTER_LOOKUPS["admission_source_id"])
    df = spark.createDataFrame([(15,), (16,), (17,), (None,)], "admission_source_id int")
    decoded = cleaning.decode_codes(df, lookup, "admission_source_id", "text").collect()
    assert {r.admission_source_id: r.text for r in decoded} == {15: "Not Available", 16: None, 17: "NULL", None: None}


def test_lookup_is_broadcast_by_its_size(spark):
    lookup = lookup_frame(spark, ENCOUNTER_LOOKUPS["discharge_disposition_id"])
    df = spark.range(10).select(F.col("id").cast("int").alias("discharge_disposition_id"))
    plan = cleaning.decode_codes(df, lookup, "discharge_disposition_id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


RAW = (
    "encounter_id,patient_nbr,race,gender,age,weight,admission_type_id,discharge_disposition_id,admission_source_id,"
    "time_in_hospital,num_lab_procedures,num_procedures,num_medications,number_outpatient,number_emergency,"
    "number_inpatient,number_diagnoses,max_glu_serum,A1Cresult,insulin,change,diabetesMed,readmitted\n"
    "1,10,Caucasian,Male,[60-70),?,1,1,7,3,40,1,12,0,0,0,9,None,>7,Up,Ch,Yes,<30\n"
    "2,10,?,Female,[70-80),?,2,3,1,4,?,2,10,1,2,1,7,>200,?,No,No,Yes,>30\n"
    "3,11,Asian,Unknown/Invalid,[0-10),?,3,11,2,5,50,3,8,0,0,0,5,None,None,No,No,No,NO\n"
    "4,12,Other,Male,[90-100),[75-100),7,7,4,1,60,0,3,0,0,3,9,None,Norm,Steady,No,Yes,NO\n"
)


@pytest.fixture()
def raw_csv(tmp_path):
    path = tmp_path / "encounters.csv"
    path.write_text(RAW)
    return str(path)


@pytest.mark.parametrize("infer", [False, True])
def test_csv_types(spark, raw_csv, infer):
    df = load_data(spark, raw_csv, infer=infer)
    types = dict(df.dtypes)
    assert types["num_lab_procedures"] == "int" and types["race"] == "string"
    if not infer:
        assert types["encounter_id"] == "bigint"
    assert df.filter("num_lab_procedures IS NULL").count() == 1
    assert df.filter("race IS NULL").count() == 1


def test_header_must_match_schema(spark, raw_csv):
    schema = load_data(spark, raw_csv).schema
    swapped = type(schema)([schema[1], schema[0], *schema.fields[2:]])
    with pytest.raises(Exception, match="(?i)header"):
        load_data(spark, raw_csv, schema=swapped).collect()


def test_preparation_order_and_result(spark, raw_csv):
    raw = load_data(spark, raw_csv)
    learned = learn_preparation(clean_rows(raw))
    # the excluded row is gone before missing rates and medians are taken
    assert learned.n_rows == 3
    assert learned.dropped == ("weight",)
    # all number columns are learned, as later rows may lack any of them
    assert learned.medians == {
        "time_in_hospital": 3.0, "num_lab_procedures": 40.0, "num_procedures": 1.0, "num_medications": 10.0,
        "number_diagnoses": 9.0, "number_outpatient": 0.0, "number_emergency": 0.0, "number_inpatient": 1.0,
    }
    rows = {r.encounter_id: r for r in prepare_encounters(raw).collect()}
    assert set(rows) == {1, 2, 4}
    two = rows[2]
    assert (two.race, two.num_lab_procedures, two.A1Cresult) == ("Unknown", 40.0, "Unknown")
    # a missing lab value is filled first and then counts as tested
    assert (two.a1c_tested, two.a1c_abnormal, two.glucose_tested) == (1, 0, 1)
    assert (two.total_prior_visits, two.high_utilizer, two.frequent_er_visitor) == (4, 1, 1)
    assert rows[4].discharge_group == "Left_AMA" and rows[4].discharged_not_home == 1
    assert rows[1].readmit_30 == 1 and rows[1].complexity_score == pytest.approx(22 / 3)
    untested = prepare_encounters(raw, untested_values=("None", "Unknown"))
    assert {r.encounter_id: r.a1c_tested for r in untested.collect()} == {1: 1, 2: 0, 4: 1}


def test_preparation_looks_at_the_data_once(spark, raw_csv):
    raw = load_data(spark, raw_csv)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("prepare-once", "")
    try:
        prepare_encounters(raw)
    finally:
        jobs = tracker.getJobIdsForGroup("prepare-once")
        spark.sparkContext._jsc.clearJobGroup()
    assert 1 <= len(jobs) <= 3  # one aggregation, in up to three adaptive stages


def test_protected_columns_stay(spark):
    columns = "encounter_id,admission_type_id,admission_source_id,discharge_disposition_id".split(",")
    df = spark.createDataFrame([(1, 1, 1, 1, None)], ",".join(f"{c} int" for c in columns) + ", A1Cresult string")
    assert learn_preparation(df).dropped == ("A1Cresult",)
    assert learn_preparation(df, protect=["A1Cresult"]).dropped == ()
