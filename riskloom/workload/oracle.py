"""SQL equivalents of the registered queries, for checking them with another engine."""

from __future__ import annotations

from collections.abc import Mapping

from riskloom.schemas import (
    ADMISSION_SOURCES,
    ADMISSION_TYPES,
    DISCHARGE_DISPOSITIONS,
    ENCOUNTER_FEATURES,
    MEDIAN_FILL_COLUMNS,
)
from riskloom.sources.lookups import lookup_values
from riskloom.sources.sample_tables import ENCOUNTER_COLUMNS

ORACLES: dict[str, str] = {}

_ENCOUNTERS = """
lines AS (
  SELECT l_orderkey,
         CAST(sum(l_quantity) AS INTEGER) AS num_lab_procedures,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS num_procedures,
         CAST(count(DISTINCT l_partkey) AS INTEGER) AS num_medications,
         CAST(count(*) AS INTEGER) AS number_diagnoses
  FROM lineitem GROUP BY l_orderkey
),
visits AS (
  SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders
),
history AS (
  SELECT *,
         CAST(coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) OVER past, 0) AS INTEGER) AS number_outpatient,
         CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER past, 0) AS INTEGER) AS number_emergency,
         CAST(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER past, 0) AS INTEGER) AS number_inpatient,
         lead(d) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - d AS gap
  FROM visits
  WINDOW past AS (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)
),
encounters AS (
  SELECT o_orderkey AS encounter_id,
         o_custkey AS patient_nbr,
         o_orderdate AS admitted_at,
         CASE WHEN o_orderkey % 50 = 0 THEN '?' ELSE c_mktsegment END AS race,
         CASE WHEN o_custkey % 97 = 0 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         concat('[', CAST((o_custkey % 10) * 10 AS VARCHAR), '-', CAST((o_custkey % 10) * 10 + 10 AS VARCHAR), ')') AS age,
         CASE WHEN o_orderkey % 100 < 97 THEN '?' ELSE '[75-100)' END AS weight,
         CASE WHEN o_orderkey % 100 < 40 THEN '?' ELSE 'MC' END AS payer_code,
         CASE WHEN o_orderkey % 100 < 49 THEN '?' ELSE 'Cardiology' END AS medical_specialty,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS admission_type_id,
         CAST(1 + o_orderkey % 30 AS INTEGER) AS discharge_disposition_id,
         CAST(c_nationkey + 1 AS INTEGER) AS admission_source_id,
         CAST(1 + o_orderkey % 14 AS INTEGER) AS time_in_hospital,
         num_lab_procedures, num_procedures, num_medications, number_diagnoses,
         number_outpatient, number_emergency, number_inpatient,
         CASE WHEN o_orderkey % 20 < 19 THEN 'None' ELSE '>200' END AS max_glu_serum,
         CASE WHEN o_orderkey % 6 < 3 THEN 'None' WHEN o_orderkey % 6 = 3 THEN '>7'
              WHEN o_orderkey % 6 = 4 THEN '>8' ELSE 'Norm' END AS "A1Cresult",
         CASE o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Steady' WHEN 2 THEN 'Up' ELSE 'Down' END AS insulin,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Ch' ELSE 'No' END AS "change",
         CASE WHEN o_orderkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS "diabetesMed",
         CASE WHEN gap IS NULL THEN 'NO' WHEN gap < 30 THEN '<30' ELSE '>30' END AS readmitted
  FROM history
  LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
)"""

_TEXT_COLUMNS = (
    "race", "gender", "age", "weight", "payer_code", "medical_specialty", "max_glu_serum",
    "A1Cresult", "insulin", "change", "diabetesMed", "readmitted",
)


def _q(column: str) -> str:
    return f'"{column}"'


def _no_sentinel(columns) -> str:
    return ", ".join(f"nullif({_q(c)}, '?') AS {_q(c)}" if c in _TEXT_COLUMNS else _q(c) for c in columns)


_EXCLUDED = "discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)"

_CLEANED = f"""{_ENCOUNTERS},
cleaned AS (
  SELECT {_no_sentinel(ENCOUNTER_COLUMNS)}, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmit_30
  FROM encounters WHERE {_EXCLUDED}
)"""

_ADMISSION = """
  CASE admission_type_id WHEN 1 THEN 'Emergency' WHEN 2 THEN 'Urgent' WHEN 3 THEN 'Elective'
       WHEN 4 THEN 'Newborn' ELSE 'Other_Unknown' END AS admission_type_group,
  CASE WHEN admission_type_id = 1 THEN 1 ELSE 0 END AS emergency_admission,
  CASE WHEN admission_source_id = 7 THEN 'Emergency_Room' WHEN admission_source_id = 1 THEN 'Physician_Referral'
       WHEN admission_source_id IN (2, 3) THEN 'Clinic_HMO_Referral'
       WHEN admission_source_id IN (4, 5, 6, 10, 22, 25, 26) THEN 'Transfer_Facility'
       ELSE 'Other' END AS admission_source_group,
  CASE WHEN admission_source_id = 7 THEN 1 ELSE 0 END AS admitted_from_er"""
_DISCHARGE = """
  CASE WHEN discharge_disposition_id IN (1, 6, 8) THEN 'Home'
       WHEN discharge_disposition_id IN (2, 3, 4, 5, 15, 22, 23, 24, 27, 28, 29, 30) THEN 'Transfer_Facility'
       WHEN discharge_disposition_id = 7 THEN 'Left_AMA' ELSE 'Other' END AS discharge_group,
  CASE WHEN discharge_disposition_id IN (1, 6, 8) THEN 0 ELSE 1 END AS discharged_not_home,
  CASE WHEN discharge_disposition_id = 7 THEN 1 ELSE 0 END AS left_ama"""
_UTILIZATION = """
  number_outpatient + number_emergency + number_inpatient AS total_prior_visits,
  CASE WHEN number_outpatient + number_emergency + number_inpatient >= 3 THEN 1 ELSE 0 END AS high_utilizer,
  CASE WHEN number_emergency >= 2 THEN 1 ELSE 0 END AS frequent_er_visitor,
  round((num_procedures + num_medications + number_diagnoses) / CAST(3 AS DOUBLE), 6) AS complexity_score"""
_AGE_NUMERIC = "CASE " + " ".join(f"WHEN age = '[{a}-{a + 10})' THEN {a + 5}" for a in range(0, 100, 10)) + " END"
_AGE = f"""
  {_AGE_NUMERIC} AS age_numeric,
  CASE WHEN {_AGE_NUMERIC} >= 65 THEN 1 ELSE 0 END AS is_elderly"""
_LAB = """
  CASE WHEN "A1Cresult" <> 'None' THEN 1 ELSE 0 END AS a1c_tested,
  CASE WHEN "A1Cresult" IN ('>7', '>8') THEN 1 ELSE 0 END AS a1c_abnormal,
  CASE WHEN max_glu_serum <> 'None' THEN 1 ELSE 0 END AS glucose_tested,
  CASE WHEN insulin IN ('Down', 'Steady', 'Up') THEN 1 ELSE 0 END AS on_insulin,
  CASE WHEN "change" = 'Ch' THEN 1 ELSE 0 END AS med_changed"""


def _median_filled(source: str) -> str:
    return ", ".join(
        f"CAST(coalesce({c}, (SELECT median({c}) FROM {source})) AS DOUBLE) AS {c}"
        for c in MEDIAN_FILL_COLUMNS
    )


_PREPARED = f"""{_CLEANED},
filled AS (
  SELECT encounter_id, patient_nbr, readmit_30, age, insulin,
         admission_type_id, admission_source_id, discharge_disposition_id,
         coalesce(race, 'Unknown') AS race,
         CASE WHEN gender IN ('Male', 'Female') THEN gender ELSE 'Unknown' END AS gender,
         coalesce("A1Cresult", 'Unknown') AS "A1Cresult",
         coalesce(max_glu_serum, 'Unknown') AS max_glu_serum,
         coalesce("change", 'Unknown') AS "change",
         {_median_filled("cleaned")}
  FROM cleaned
),
prepared AS (
  SELECT *, {_ADMISSION}, {_DISCHARGE}, {_UTILIZATION}, {_AGE}, {_LAB} FROM filled
)"""


def _from_encounters(name: str, select: str, rest: str = "", source: str = "encounters", ctes: str = _ENCOUNTERS):
    ORACLES[name] = f"WITH {ctes} SELECT {select} FROM {source} {rest}"


def _all(columns) -> str:
    return ", ".join(_q(c) for c in columns)


# --- sources and sinks, cleaning ---
_from_encounters("csv_roundtrip", _no_sentinel(ENCOUNTER_COLUMNS))
_from_encounters("load_counts", f"count(*) AS n_rows, {len(ENCOUNTER_COLUMNS)} AS n_columns")
_from_encounters(
    "admission_readmission",
    """CASE admission_type_id WHEN 1 THEN 'Emergency' WHEN 2 THEN 'Urgent' WHEN 3 THEN 'Elective'
            WHEN 4 THEN 'Newborn' ELSE 'Other_Unknown' END AS admission_type_group,
       count(*) AS visits, CAST(sum(readmit_30) AS BIGINT) AS readmitted_30, round(avg(readmit_30), 6) AS readmission_rate""",
    "GROUP BY 1", "cleaned", _CLEANED,
)
_from_encounters("null_sentinels", _no_sentinel(ENCOUNTER_COLUMNS))
ORACLES["missing_profile"] = (
    f"WITH {_ENCOUNTERS}, clean AS (SELECT {_no_sentinel(ENCOUNTER_COLUMNS)} FROM encounters)\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS null_count, count(*) AS n_rows, "
        f"round(100.0 * (count(*) - count({_q(c)})) / count(*), 6) AS missing_pct FROM clean"
        for c in ENCOUNTER_COLUMNS
    )
)
_from_encounters(
    "drop_high_missing", "encounter_id, discharge_disposition_id, payer_code, medical_specialty", "", "cleaned", _CLEANED
)
_from_encounters(
    "fill_categories",
    "encounter_id, " + ", ".join(
        f"coalesce(nullif({_q(c)}, '?'), 'Unknown') AS {_q(c)}"
        for c in ("race", "gender", "payer_code", "medical_specialty", "max_glu_serum", "change")
    ),
)
_from_encounters("fill_median", "encounter_id, " + _median_filled("encounters"))
_from_encounters(
    "target_label", "encounter_id, readmitted, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmit_30"
)
_from_encounters("exclude_discharges", "encounter_id, discharge_disposition_id", f"WHERE {_EXCLUDED}")
_from_encounters(
    "exclusion_counts",
    f"""count(*) AS rows_before, count(*) FILTER (WHERE {_EXCLUDED}) AS rows_kept,
        count(*) FILTER (WHERE NOT ({_EXCLUDED})) AS rows_removed,
        round(100.0 * count(*) FILTER (WHERE NOT ({_EXCLUDED})) / count(*), 2) AS removed_pct""",
)
_from_encounters(
    "clean_category",
    "encounter_id, CASE WHEN gender IN ('Male', 'Female') THEN gender ELSE 'Unknown' END AS gender",
)
ORACLES["decode_codes"] = f"""WITH {_ENCOUNTERS},
types(code, text) AS (VALUES {lookup_values(ADMISSION_TYPES)}),
dispositions(code, text) AS (VALUES {lookup_values(DISCHARGE_DISPOSITIONS)}),
sources(code, text) AS (VALUES {lookup_values(ADMISSION_SOURCES)})
SELECT encounter_id, admission_type_id, discharge_disposition_id, admission_source_id,
       t.text AS admission_type_text, d.text AS discharge_disposition_text, s.text AS admission_source_text
FROM encounters
LEFT JOIN types t ON t.code = admission_type_id
LEFT JOIN dispositions d ON d.code = discharge_disposition_id
LEFT JOIN sources s ON s.code = admission_source_id"""

# --- features ---
_from_encounters("admission_features", f"encounter_id, admission_type_id, admission_source_id, {_ADMISSION}")
_from_encounters("discharge_features", f"encounter_id, discharge_disposition_id, {_DISCHARGE}")
_from_encounters(
    "utilization_features",
    "encounter_id, number_outpatient, number_emergency, number_inpatient, "
    f"num_procedures, num_medications, number_diagnoses, {_UTILIZATION}",
)
_from_encounters("age_features", f"encounter_id, age, {_AGE}")
_from_encounters("lab_features", f'encounter_id, "A1Cresult", max_glu_serum, insulin, "change", {_LAB}')
_from_encounters(
    "feature_matrix", f"encounter_id, patient_nbr, {_all(ENCOUNTER_FEATURES.all)}, readmit_30", "", "prepared", _PREPARED
)
_from_encounters("prior_year_visits", "encounter_id, number_outpatient, number_emergency, number_inpatient")
_from_encounters("next_visit_label", "encounter_id, readmitted")

# --- split and weights ---
_PART = """CASE WHEN CAST(concat('0x', substr(md5(concat('42|', CAST(patient_nbr AS VARCHAR))), 1, 8)) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END"""
_from_encounters("hash_split", f"encounter_id, patient_nbr, {_PART} AS part")
_from_encounters(
    "split_report",
    f"""{_PART} AS part, count(*) AS visits, count(DISTINCT patient_nbr) AS entities,
        round(100.0 * count(*) / (SELECT count(*) FROM encounters), 2) AS visits_pct""",
    "GROUP BY 1",
)
_from_encounters("random_split_check", "count(DISTINCT patient_nbr) AS entities, CAST(0 AS BIGINT) AS overlap, true AS passed")
_from_encounters(
    "entity_overlap",
    f"""count(DISTINCT patient_nbr) FILTER (WHERE {_PART} = 'train') AS train_entities,
        count(DISTINCT patient_nbr) FILTER (WHERE {_PART} = 'test') AS test_entities,
        (SELECT count(*) FROM (SELECT patient_nbr FROM encounters WHERE {_PART} = 'train'
                               INTERSECT SELECT patient_nbr FROM encounters WHERE {_PART} = 'test')) AS overlap,
        (SELECT count(*) = 0 FROM (SELECT patient_nbr FROM encounters WHERE {_PART} = 'train'
                                   INTERSECT SELECT patient_nbr FROM encounters WHERE {_PART} = 'test')) AS passed""",
)
_from_encounters("distinct_entities", "DISTINCT patient_nbr")
_LABELLED = f"""{_ENCOUNTERS},
labelled AS (SELECT encounter_id, patient_nbr, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmit_30 FROM encounters)"""
_from_encounters("class_counts", "readmit_30, count(*) AS n", "GROUP BY 1", "labelled", _LABELLED)
_from_encounters(
    "class_weights",
    "readmit_30, count(*) AS n, round((SELECT CAST(count(*) AS DOUBLE) FROM labelled) / (2 * count(*)), 6) AS weight",
    "GROUP BY 1", "labelled", _LABELLED,
)
_from_encounters(
    "sample_weights",
    """encounter_id, readmit_30,
       round(CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY readmit_30)), 6) AS sample_weight""",
    "", "labelled", _LABELLED,
)
_from_encounters(
    "semi_join_entities", "encounter_id, patient_nbr",
    "WHERE patient_nbr IN (SELECT patient_nbr FROM labelled WHERE readmit_30 = 1)", "labelled", _LABELLED,
)
_from_encounters(
    "anti_join_dropped", "encounter_id", "WHERE " + " OR ".join(f"{c} IS NULL" for c in MEDIAN_FILL_COLUMNS)
)

# --- metrics on scored rows ---
_SCORES = """
scores AS (
  SELECT event_id, ts, model, label, score, CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM (
    SELECT event_id, ts, 'm1' AS model, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
           value / (value + 35.0::DOUBLE) AS score FROM events
    UNION ALL
    SELECT event_id, ts, 'm2', CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END,
           1.0::DOUBLE - value / (value + 35.0::DOUBLE) FROM events
    UNION ALL
    SELECT event_id, ts, 'm3', CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END,
           (event_id % 100) / 100.0::DOUBLE FROM events
  ) AS s
)"""


def _from_scores(name: str, select: str, rest: str = "", source: str = "scores", ctes: str = _SCORES):
    ORACLES[name] = f"WITH {ctes} SELECT {select} FROM {source} {rest}"


_from_scores(
    "parquet_predictions",
    "event_id AS encounter_id, label AS readmit_30, prediction, score AS readmission_probability",
    "WHERE model = 'm1'",
)
_from_scores("label_prediction_counts", "model, label, prediction, count(*) AS n", "GROUP BY 1, 2, 3")

_CELLS = """
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn"""
_from_scores("confusion_matrix", f"model, {_CELLS}", "GROUP BY model")


def _ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE CAST({a} AS DOUBLE) / ({b}) END)"


_P1, _R1 = _ratio("tp", "tp + fp"), _ratio("tp", "tp + fn")
_P0, _R0 = _ratio("tn", "tn + fn"), _ratio("tn", "tn + fp")
_F1, _F0 = _ratio(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _ratio(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")
_ACC = _ratio("tp + tn", "tp + tn + fp + fn")


def _weighted(one: str, zero: str) -> str:
    return f"((tp + fn) * {one} + (tn + fp) * {zero}) / CAST(tp + tn + fp + fn AS DOUBLE)"


_CELL_TABLE = f"{_SCORES}, cells AS (SELECT model, {_CELLS} FROM scores GROUP BY model)"
_from_scores(
    "class_metrics",
    f"""model, tp, tn, fp, fn, round({_ACC}, 6) AS accuracy, round({_P1}, 6) AS precision_pos,
        round({_R1}, 6) AS recall_pos, round({_F1}, 6) AS f1_pos,
        round({_weighted(_P1, _P0)}, 6) AS weighted_precision, round({_weighted(_R1, _R0)}, 6) AS weighted_recall,
        round({_weighted(_F1, _F0)}, 6) AS weighted_f1,
        round({_R1}, 6) AS sensitivity, round({_R0}, 6) AS specificity""",
    "", "cells", _CELL_TABLE,
)
_from_scores(
    "score_describe",
    """model, count(score) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS stddev,
       round(min(score), 6) AS min, round(max(score), 6) AS max""",
    "GROUP BY model",
)
_from_scores(
    "score_by_class",
    """model, label, round(avg(score), 6) AS mean_score, count(*) AS n, round(quantile_cont(score, 0.25), 6) AS p25,
       round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.75), 6) AS p75""",
    "GROUP BY model, label",
)
_AT_THRESHOLD = f"""{_SCORES},
steps(threshold) AS (VALUES (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE)),
cells AS (
  SELECT model, threshold,
         count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
         count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
         count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
         count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
  FROM scores, steps GROUP BY model, threshold
)"""
_from_scores(
    "threshold_sweep",
    f"model, threshold, tp, tn, fp, fn, round({_P1}, 6) AS precision, round({_R1}, 6) AS recall, round({_F1}, 6) AS f1",
    "", "cells", _AT_THRESHOLD,
)
_from_scores(
    "prediction_summary",
    """model, prediction, count(*) AS "count", round(avg(score) * 100, 2) AS avg_probability_pct,
       round(avg(label) * 100, 2) AS actual_readmit_rate_pct""",
    "GROUP BY model, prediction",
)
_from_scores("high_risk", "event_id, model, label, round(score, 6) AS score", "WHERE score >= 0.5")
_from_scores(
    "high_risk_report",
    """model, count(*) FILTER (WHERE score >= 0.5) AS high_risk, count(*) AS total,
       round(100.0::DOUBLE * count(*) FILTER (WHERE score >= 0.5) / count(*), 2) AS high_risk_pct""",
    "GROUP BY model",
)
_from_scores(
    "sql_text_filter", "event_id, model, round(score, 6) AS score",
    "WHERE score >= 0.3 AND score < 0.7 AND label = 1 AND model <> 'm2'",
)
_from_scores(
    "risk_bands",
    """event_id, model, round(score, 6) AS score,
       CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.5 THEN 'moderate' WHEN score < 0.7 THEN 'high'
            ELSE 'very_high' END AS risk_band""",
)
_from_scores(
    "class_distribution",
    "label, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct",
    "WHERE model = 'm1' GROUP BY label",
)
_from_scores("base_rate", "round(avg(label), 6) AS base_rate", "WHERE model = 'm1'")

_RANKED = f"""{_SCORES},
counted AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scores GROUP BY model, score
),
ranked AS (
  SELECT model, score, pos, neg,
         CAST(sum(pos) OVER run AS BIGINT) AS tp, CAST(sum(neg) OVER run AS BIGINT) AS fp,
         CAST(sum(pos) OVER (PARTITION BY model) AS DOUBLE) AS p,
         CAST(sum(neg) OVER (PARTITION BY model) AS DOUBLE) AS n
  FROM counted WINDOW run AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
),
areas AS (
  SELECT model,
         sum(CAST(neg AS DOUBLE) * (tp - pos / 2.0::DOUBLE)) / max(p * n) AS auc_roc,
         sum(pos * (tp / CAST(tp + fp AS DOUBLE)
             + CASE WHEN tp + fp = pos + neg THEN tp / CAST(tp + fp AS DOUBLE)
                    ELSE (tp - pos) / CAST(tp + fp - pos - neg AS DOUBLE) END) / 2.0::DOUBLE) / max(p) AS auc_pr
  FROM ranked GROUP BY model
)"""
_from_scores(
    "roc_points",
    "model, round(score, 9) AS threshold, tp, fp, round(tp / p, 9) AS tpr, round(fp / n, 9) AS fpr",
    "", "ranked", _RANKED,
)
_from_scores(
    "pr_points",
    """model, round(score, 9) AS threshold, tp, fp, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision,
       round(tp / p, 9) AS recall""",
    "", "ranked", _RANKED,
)
_from_scores("roc_auc", "model, round(auc_roc, 9) AS auc_roc", "", "areas", _RANKED)
_from_scores("pr_auc", "model, round(auc_pr, 9) AS auc_pr", "", "areas", _RANKED)
_from_scores(
    "operating_point",
    "model, round(score, 6) AS threshold, tp, fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr",
    """WHERE nearest = 1""",
    "(SELECT *, row_number() OVER (PARTITION BY model ORDER BY abs(score - 0.5), score DESC) AS nearest FROM ranked)",
    _RANKED,
)
_COMPARED = f"""{_RANKED}, cells AS (SELECT model, {_CELLS} FROM scores GROUP BY model),
compared AS (
  SELECT model AS "Model", round(auc_roc, 4) AS "AUC_ROC", round(auc_pr, 4) AS "AUC_PR", round({_ACC}, 4) AS "Accuracy",
         round({_weighted(_F1, _F0)}, 4) AS "F1_Score", round({_weighted(_P1, _P0)}, 4) AS "Precision",
         round({_weighted(_R1, _R0)}, 4) AS "Recall", tp AS "True_Positives", tn AS "True_Negatives",
         fp AS "False_Positives", fn AS "False_Negatives"
  FROM cells JOIN areas USING (model)
)"""
_from_scores("model_comparison", "*", "", "compared", _COMPARED)
_from_scores("comparison_roundtrip", "*", "", "compared", _COMPARED)
_from_scores("best_model", "*", 'ORDER BY "AUC_ROC" DESC, "Model" LIMIT 1', "compared", _COMPARED)
ORACLES["comparison_long"] = f"WITH {_COMPARED} " + " UNION ALL ".join(
    f"""SELECT "Model", '{m}' AS metric, "{m}" AS value FROM compared""" for m in ("AUC_ROC", "AUC_PR", "F1_Score", "Accuracy")
)
ORACLES["champion_challenger"] = f"""WITH {_COMPARED}
SELECT a."Model" AS champion, b."Model" AS challenger, a."AUC_ROC" AS champion_value, b."AUC_ROC" AS challenger_value,
       round(b."AUC_ROC" - a."AUC_ROC", 4) AS delta, b."AUC_ROC" > a."AUC_ROC" AS promote,
       greatest(a."AUC_ROC", b."AUC_ROC") < 0.60 AS retrain
FROM compared a JOIN compared b ON a."Model" = 'm1' AND b."Model" <> 'm1'"""
ORACLES["feature_drift"] = f"""WITH {_SCORES},
binned AS (
  SELECT model, ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AS base, 'score' AS column_name,
         CAST(least(greatest(CAST(floor(score / 0.1::DOUBLE) AS INTEGER), 0), 9) AS VARCHAR) AS bin FROM scores
  UNION ALL
  SELECT model, ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events), 'label', CAST(label AS VARCHAR) FROM scores
),
counted AS (
  SELECT model, column_name, bin, count(*) FILTER (WHERE base) AS b, count(*) FILTER (WHERE NOT base) AS c
  FROM binned GROUP BY 1, 2, 3
),
shares AS (
  SELECT model, column_name, b, c,
         greatest(b / CAST(sum(b) OVER (PARTITION BY model, column_name) AS DOUBLE), 1e-6::DOUBLE) AS p,
         greatest(c / CAST(sum(c) OVER (PARTITION BY model, column_name) AS DOUBLE), 1e-6::DOUBLE) AS q
  FROM counted
)
SELECT model, column_name, round(sum((p - q) * ln(p / q)), 6) AS psi, CAST(sum(b) AS BIGINT) AS baseline_n,
       CAST(sum(c) AS BIGINT) AS current_n
FROM shares GROUP BY model, column_name"""

# --- reports ---
def _metric_rows(section: str, key: str, metrics: Mapping[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, model, {key} AS key, '{name}' AS metric, round(CAST({value} AS DOUBLE), 6) AS value FROM {source}"
        for name, value in metrics.items()
    )


_SCORE_FIGURES = {"n": "n", "n_scored": "n_scored", "mean": "mean", "stddev": "stddev", "min": "low", "max": "high"}
_DESCRIBED = """count(*) AS n, count(score) AS n_scored, avg(score) AS mean, stddev_samp(score) AS stddev, min(score) AS low, max(score) AS high"""
_CELL_FIGURES = {c: c for c in ("tp", "tn", "fp", "fn")}
ORACLES["comprehensive_report"] = f"""WITH {_AT_THRESHOLD.replace("cells AS", "at_threshold AS")},
whole AS (SELECT model, {_DESCRIBED}, avg(label) AS base, {_CELLS} FROM scores GROUP BY model),
classes AS (SELECT model, label, {_DESCRIBED} FROM scores GROUP BY model, label)
""" + " UNION ALL ".join([
    _metric_rows("model", "CAST(NULL AS VARCHAR)", _SCORE_FIGURES | _CELL_FIGURES | {
        "accuracy": _ACC, "precision_pos": _P1, "recall_pos": _R1, "f1_pos": _F1, "weighted_precision": _weighted(_P1, _P0),
        "weighted_recall": _weighted(_R1, _R0), "weighted_f1": _weighted(_F1, _F0), "sensitivity": _R1, "specificity": _R0,
        "positive_pct": "round(100 * base, 2)",
    }, "whole"),
    _metric_rows("class", "CAST(label AS VARCHAR)", _SCORE_FIGURES, "classes"),
    _metric_rows("threshold", "CAST(threshold AS VARCHAR)", _CELL_FIGURES | {"precision": _P1, "recall": _R1, "f1": _F1}, "at_threshold"),
])
_from_scores("model_row", "*", """WHERE "Model" = 'm2'""", "compared", _COMPARED)
_BEST = f"""{_COMPARED}, best AS (SELECT "Model" AS model FROM compared ORDER BY "AUC_ROC" DESC, "Model" LIMIT 1)"""
ORACLES["chart_roc_curve"] = f"""WITH {_BEST}
SELECT round(score, 9) AS threshold, tp, fp, round(tp / p, 9) AS tpr, round(fp / n, 9) AS fpr FROM ranked JOIN best USING (model)
UNION ALL SELECT NULL, 0, 0, 0, 0"""
ORACLES["chart_operating_point"] = f"""WITH {_BEST}
SELECT round(score, 6) AS threshold, tp, fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr
FROM ranked JOIN best USING (model) ORDER BY abs(score - 0.5), score DESC LIMIT 1"""
ORACLES["chart_precision_recall"] = f"""WITH {_BEST}
SELECT round(score, 9) AS threshold, tp, fp, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / p, 9) AS recall
FROM ranked JOIN best USING (model) UNION ALL SELECT NULL, NULL, NULL, 1, 0"""
ORACLES["chart_base_rate"] = f"WITH {_BEST} SELECT round(avg(label), 6) AS base_rate FROM scores JOIN best USING (model)"
ORACLES["chart_confusion_matrix"] = f"""WITH {_BEST}
SELECT label AS readmit_30, prediction, count(*) AS n FROM scores JOIN best USING (model) GROUP BY 1, 2"""
ORACLES["chart_model_comparison"] = ORACLES["comparison_long"]
ORACLES["chart_class_distribution"] = f"""WITH {_BEST}
SELECT label AS readmit_30, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct
FROM scores JOIN best USING (model) GROUP BY label"""

# --- encoding ---
_SLOT_LONG: Mapping[str, str] = {
    **{c: f"SELECT encounter_id, '{c}' AS slot, CAST({c} AS DOUBLE) AS raw FROM full_precision"
       for c in ENCOUNTER_FEATURES.numeric + ENCOUNTER_FEATURES.binary},
    **{c: f"SELECT encounter_id, '{c}_encoded_' || v AS slot, CASE WHEN {c} = v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS raw "
          f"FROM full_precision CROSS JOIN (SELECT DISTINCT {c} AS v FROM prepared)"
       for c in ENCOUNTER_FEATURES.categorical},
}
ORACLES["encode_features"] = f"""WITH {_PREPARED},
full_precision AS (
  SELECT * REPLACE ((num_procedures + num_medications + number_diagnoses) / CAST(3 AS DOUBLE) AS complexity_score) FROM prepared
),
slots AS ({" UNION ALL ".join(_SLOT_LONG.values())}),
scaled AS (SELECT encounter_id, slot, raw, stddev_samp(raw) OVER (PARTITION BY slot) AS sd FROM slots)
SELECT encounter_id, slot, round(raw / sd, 6) AS value FROM scaled WHERE raw <> 0 AND sd <> 0"""
ORACLES["category_index"] = f"WITH {_PREPARED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, "
    f"CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS idx FROM prepared GROUP BY {c}"
    for c in ENCOUNTER_FEATURES.categorical
)

_RANKED_CATEGORIES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM {{source}} GROUP BY {c}"
    for c in ENCOUNTER_FEATURES.categorical
)
ORACLES["category_table_index"] = f"WITH {_PREPARED} " + _RANKED_CATEGORIES.format(source="prepared")
ORACLES["category_table_rows"] = (
    f"WITH {_PREPARED}, known AS (SELECT * FROM prepared WHERE {_PART} = 'train' AND race <> 'MACHINERY'), "
    f"categories AS ({_RANKED_CATEGORIES.format(source='known')}) SELECT encounter_id, " + ", ".join(
        f"coalesce((SELECT idx FROM categories WHERE column_name = '{c}' AND value = prepared.{c}), "
        f"(SELECT count(*) FROM categories WHERE column_name = '{c}')) AS {c}_indexed" for c in ENCOUNTER_FEATURES.categorical
    ) + " FROM prepared"
)
_from_encounters(
    "exact_split", "encounter_id, patient_nbr, CASE WHEN place <= floor(0.8 * n + 0.5) THEN 'train' ELSE 'test' END AS part",
    "JOIN placed USING (patient_nbr)", "encounters", f"""{_ENCOUNTERS},
patients AS (SELECT DISTINCT patient_nbr FROM encounters),
placed AS (
  SELECT patient_nbr, count(*) OVER () AS n, row_number() OVER (
    ORDER BY CAST(concat('0x', substr(md5(concat('42|', CAST(patient_nbr AS VARCHAR))), 1, 15)) AS BIGINT), CAST(patient_nbr AS VARCHAR)
  ) AS place FROM patients
)""",
)
ORACLES["user_step"] = f"""WITH {_PREPARED}
SELECT encounter_id, round(total_prior_visits / time_in_hospital, 6) AS visits_per_day, true AS same_after_loading FROM prepared"""

# --- models: which rows are scored, and what must hold for every one of them ---
_TEST_ROWS = f"""{_CLEANED},
test_rows AS (SELECT encounter_id, readmit_30 FROM cleaned WHERE {_PART} = 'test')"""
_from_encounters(
    "saved_model_check",
    "encounter_id, readmit_30, true AS same_after_loading, true AS is_probability, true AS agrees_with_class",
    "", "test_rows", _TEST_ROWS,
)
_scored = "encounter_id % 10 <> 0"
ORACLES["predict_run"] = f"WITH {_TEST_ROWS} " + " UNION ALL ".join(
    f"SELECT '{figure}' AS figure, CAST({n} AS BIGINT) AS n FROM test_rows"
    for figure, n in (
        ("rows", f"count(*) FILTER (WHERE {_scored})"),
        ("positive", f"sum(readmit_30) FILTER (WHERE {_scored})"),
        ("unscored", f"count(*) FILTER (WHERE NOT {_scored})"),
        ("summary minus rows", "0 * count(*)"),
        ("high risk minus threshold", "0 * count(*)"),
        ("high risk below threshold", "0 * count(*)"),
        ("report minus threshold", "0 * count(*)"),
    )
)
_from_encounters("malformed_cells", "count(*) AS n_rows, count(*) FILTER (WHERE encounter_id % 7 = 0) AS n_malformed")
_from_encounters("unscored_encounters", "encounter_id", "WHERE " + " OR ".join(f"{c} IS NULL" for c in MEDIAN_FILL_COLUMNS))
_from_encounters("random_split_null_keys", "count(*) AS n_rows, count(*) FILTER (WHERE encounter_id % 10 = 0 OR patient_nbr IS NULL) AS n_null")
_from_encounters(
    "late_null_features", "count(*) AS n_rows, " + ", ".join(f"0 * count(*) AS null_{c}" for c in MEDIAN_FILL_COLUMNS), "", "cleaned", _CLEANED
)
ORACLES["approx_median_ranks"] = " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS within_error" for c in MEDIAN_FILL_COLUMNS)
ORACLES["sketch_median_ranks"] = f"WITH {_ENCOUNTERS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, true AS within_bound, count({c}) AS n FROM encounters" for c in MEDIAN_FILL_COLUMNS
)
_from_scores(
    "sketch_quantile_ranks", "model, label, quantile, true AS within_bound, count(*) AS n",
    ", (VALUES ('p25'), ('median'), ('p75')) AS q(quantile) GROUP BY model, label, quantile",
)
_from_encounters("lr_probability_check", "encounter_id, readmit_30, true AS agrees", "", "test_rows", _TEST_ROWS)
ORACLES["tree_score_check"] = f"WITH {_TEST_ROWS} " + " UNION ALL ".join(
    f"SELECT '{model}' AS model, encounter_id, readmit_30, true AS agrees FROM test_rows" for model in ("Random Forest", "Gradient Boosted Trees")
)
ORACLES["importance_check"] = f"WITH {_PREPARED} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, true AS agrees, true AS in_order" for c in ENCOUNTER_FEATURES.numeric + ENCOUNTER_FEATURES.binary]
    + [f"SELECT DISTINCT '{c}_encoded_' || {c}, true, true FROM prepared WHERE {_PART} = 'train'" for c in ENCOUNTER_FEATURES.categorical]
)
ORACLES["tree_model_facts"] = " UNION ALL ".join(
    f"SELECT '{model}' AS model, 100 AS n_trees, true AS depth_within, true AS importances_sum_to_one, true AS a_slot_per_importance"
    for model in ("Random Forest", "Gradient Boosted Trees")
)
_from_encounters("scored_batches", "encounter_id, CAST(1 AS BIGINT) AS n", "", "test_rows", _TEST_ROWS)
_RUN_COUNTS = {
    "raw rows": ("encounters", "true"), "prepared rows_before": ("encounters", "true"),
    "prepared rows_removed": ("encounters", f"NOT ({_EXCLUDED})"), "prepared rows_kept": ("cleaned", "true"),
    **{f"prepared {p}_rows": ("cleaned", f"{_PART} = '{p}'") for p in ("train", "test")},
    **{f"prepared {p}_positive": ("cleaned", f"{_PART} = '{p}' AND readmit_30 = 1") for p in ("train", "test")},
}
ORACLES["full_run"] = f"WITH {_TEST_ROWS} " + " UNION ALL ".join([
    *(
        f"SELECT '{table}' AS table_name, '{model}' AS model, count(*) AS n_rows, "
        "CAST(sum(readmit_30) AS BIGINT) AS n_positive FROM test_rows"
        for table, model in (
            ("model_comparison", "Logistic Regression"),
            ("model_comparison", "Random Forest"),
            ("model_comparison", "Gradient Boosted Trees"),
            ("test_predictions", "best"),
            ("new_predictions", "best"),
        )
    ),
    *(f"SELECT 'counted {name}', 'run', count(*), NULL FROM {table} WHERE {rule}" for name, (table, rule) in _RUN_COUNTS.items()),
    *(f"SELECT 'resumed {stage}', 'run', 1, NULL" for stage in ("raw", "prepared", "model Logistic Regression")),
])

# --- streams ---
_from_encounters("stream_matches_batch", "encounter_id, true AS same_as_batch", "", "cleaned", _CLEANED)
ORACLES["stream_high_risk"] = """
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
       count(*) AS n_rows, count(*) FILTER (WHERE value / (value + 35.0::DOUBLE) >= 0.5) AS high_risk
FROM events
GROUP BY 1, 2"""

ORACLES["stream_late_rows"] = """
WITH days AS (
  SELECT event_id, ts, value, date_diff('day', (SELECT min(ts) FROM events), ts) AS d, date_trunc('day', ts)::TIMESTAMP AS day FROM events
),
arrived AS (
  SELECT *, CASE WHEN d < 20 AND event_id % 7 = 0 THEN 2 WHEN d < 10 THEN 0 WHEN d < 20 THEN 1 ELSE 3 END AS delivery FROM days
),
deliveries AS (SELECT delivery, max(ts) AS latest FROM arrived GROUP BY delivery),
marks AS (
  SELECT delivery, max(latest) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark FROM deliveries
),
judged AS (SELECT *, coalesce(day + INTERVAL 1 DAY <= mark, false) AS late FROM arrived JOIN marks USING (delivery))
SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, count(*) FILTER (WHERE NOT late) AS n_rows,
       count(*) FILTER (WHERE NOT late AND value / (value + 35.0::DOUBLE) >= 0.5) AS high_risk,
       count(*) FILTER (WHERE late) AS n_dropped, day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS closed
FROM judged GROUP BY day"""
ORACLES["stream_redelivered"] = """
SELECT event_id, CAST(1 AS BIGINT) AS n, round(value / (value + 35.0::DOUBLE), 6) AS score, true AS cut_off FROM events"""
