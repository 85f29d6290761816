"""Encounters and model scores derived from order, customer, line item and event tables.

An order plays a hospital visit and its customer the patient; an event plays a
scored row. Only what the wanted columns need is read and joined: every join here
is a left join on a unique key, so leaving one out changes no other column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.history import with_visit_history

_LINE_COLUMNS = ("num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses")
_PRIOR_COLUMNS = {"number_outpatient": "O", "number_emergency": "F", "number_inpatient": "P"}
_HISTORY_COLUMNS = (*_PRIOR_COLUMNS, "readmitted")
_CUSTOMER_COLUMNS = ("race", "admission_source_id")

ENCOUNTER_COLUMNS = (
    "encounter_id", "patient_nbr", "admitted_at", "race", "gender", "age", "weight", "payer_code",
    "medical_specialty", "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", *_LINE_COLUMNS, *_PRIOR_COLUMNS, "max_glu_serum", "A1Cresult", "insulin",
    "change", "diabetesMed", "readmitted",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under visit names: encounter, patient, time, status, priority."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").alias("patient_nbr"),
        F.col("o_orderdate").alias("admitted_at"),
        "o_orderstatus",
        "o_orderpriority",
    )


def _line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("_order")).agg(
        F.sum("l_quantity").cast("int").alias("num_lab_procedures"),
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("num_procedures"),
        F.count_distinct("l_partkey").cast("int").alias("num_medications"),
        F.count(F.lit(1)).cast("int").alias("number_diagnoses"),
    )


def prior_kinds() -> dict[str, Column]:
    return {name: F.col("o_orderstatus") == status for name, status in _PRIOR_COLUMNS.items()}


def _choose(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def encounters(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ENCOUNTER_COLUMNS) -> DataFrame:
    """The encounter table with the wanted columns, one row per order."""
    wanted = set(columns)
    df = visits(spark, sf_dir)
    if wanted.intersection(_HISTORY_COLUMNS):
        df = with_visit_history(df, "patient_nbr", "admitted_at", "encounter_id", prior_kinds())
    if wanted.intersection(_LINE_COLUMNS):
        df = df.join(_line_facts(spark, sf_dir), F.col("encounter_id") == F.col("_order"), "left")
    if wanted.intersection(_CUSTOMER_COLUMNS):
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        df = df.join(customer, F.col("patient_nbr") == F.col("c_custkey"), "left")

    k, p = F.col("encounter_id"), F.col("patient_nbr")
    decade = (p % 10 * 10).cast("int")
    derived = {
        "race": lambda: F.when(k % 50 == 0, "?").otherwise(F.col("c_mktsegment")),
        "gender": lambda: F.when(p % 97 == 0, "Unknown/Invalid").when(p % 2 == 0, "Female").otherwise("Male"),
        "age": lambda: F.format_string("[%d-%d)", decade, decade + 10),
        "weight": lambda: F.when(k % 100 < 97, "?").otherwise("[75-100)"),
        "payer_code": lambda: F.when(k % 100 < 40, "?").otherwise("MC"),
        "medical_specialty": lambda: F.when(k % 100 < 49, "?").otherwise("Cardiology"),
        "admission_type_id": lambda: F.substring("o_orderpriority", 1, 1).cast("int"),
        "discharge_disposition_id": lambda: (k % 30 + 1).cast("int"),
        "admission_source_id": lambda: F.col("c_nationkey") + 1,
        "time_in_hospital": lambda: (k % 14 + 1).cast("int"),
        "max_glu_serum": lambda: F.when(k % 20 < 19, "None").otherwise(">200"),
        "A1Cresult": lambda: _choose((k % 6).cast("int"), "None", "None", "None", ">7", ">8", "Norm"),
        "insulin": lambda: _choose((k % 4).cast("int"), "No", "Steady", "Up", "Down"),
        "change": lambda: F.when(k % 2 == 0, "Ch").otherwise("No"),
        "diabetesMed": lambda: F.when(k % 4 == 0, "No").otherwise("Yes"),
    }
    return df.select(*[derived[c]().alias(c) if c in derived else F.col(c) for c in columns])


def model_scores(spark: SparkSession, sf_dir: str, models: Sequence[str] = ("m1", "m2", "m3")) -> DataFrame:
    """Events as scored rows of up to three models, from one scan of the table."""
    saturating = F.col("value") / (F.col("value") + 35.0)
    score_of = {
        "m1": saturating,
        "m2": 1 - saturating,
        "m3": (F.col("event_id") % 100) / F.lit(100.0),
    }
    scored = F.explode(
        F.array(*[F.struct(F.lit(m).alias("model"), score_of[m].alias("score")) for m in models])
    )
    events = read_table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
        scored.alias("_scored"),
    )
    return events.select(
        "event_id", "ts", F.col("_scored.model").alias("model"), "label", F.col("_scored.score").alias("score"),
        F.when(F.col("_scored.score") >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
    )
