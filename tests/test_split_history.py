import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import history, split
from riskloom.operators.scoring import unscored_rows


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(3)
    start = datetime.datetime(2020, 1, 1)
    rows = []
    for i in range(600):
        patient = 1 if i % 3 == 0 else rng.choice([None, *range(2, 60)])  # one patient holds a third
        rows.append((i, patient, start + datetime.timedelta(days=rng.randrange(900), hours=rng.randrange(3)), rng.choice("OFP")))
    return spark.createDataFrame(rows, "encounter_id long, patient_nbr long, at timestamp_ntz, kind string"), rows


def test_prior_visits_brute_force(visits):
    df, rows = visits
    kinds = {"n_o": F.col("kind") == "O", "n_f": F.col("kind") == "F"}
    found = {r.encounter_id: (r.n_o, r.n_f) for r in history.with_prior_visits(df, "patient_nbr", "at", kinds).collect()}
    assert len(found) == len(rows)
    for key, patient, at, _ in rows:
        def count(kind):
            return sum(
                1 for _, p, t, k in rows
                if p == patient and k == kind and 1 <= (at.date() - t.date()).days <= 365
            )
        assert found[key] == (count("O"), count("F"))


def test_next_visit_label_brute_force(visits):
    df, rows = visits
    found = {r.encounter_id: r.readmitted for r in history.with_next_visit_label(df, "patient_nbr", "at", "encounter_id").collect()}
    for key, patient, at, _ in rows:
        later = [(t, k) for k, p, t, _ in rows if p == patient and (t, k) > (at, key)]
        gap = (min(later)[0].date() - at.date()).days if later else None
        assert found[key] == ("NO" if gap is None else "<30" if gap < 30 else ">30")


def test_combined_history_equals_parts(visits):
    df, _ = visits
    kinds = {"n_o": F.col("kind") == "O"}
    both = history.with_visit_history(df, "patient_nbr", "at", "encounter_id", kinds)
    prior = history.with_prior_visits(df, "patient_nbr", "at", kinds)
    label = history.with_next_visit_label(df, "patient_nbr", "at", "encounter_id")
    assert sorted(both.select("encounter_id", "n_o").collect()) == sorted(prior.select("encounter_id", "n_o").collect())
    assert sorted(both.select("encounter_id", "readmitted").collect()) == sorted(label.select("encounter_id", "readmitted").collect())


def test_history_window_sees_days_not_visits(visits):
    df, _ = visits
    plan = history.with_prior_visits(df, "patient_nbr", "at", {"n": F.lit(True)})._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window ["):]
    assert "Aggregate [patient_nbr" in below


def test_hash_split_matches_its_definition(spark):
    df = spark.range(500).select(F.col("id").alias("patient_nbr"))
    for row in df.select("patient_nbr", split.entity_bucket("patient_nbr").alias("b")).collect():
        assert row.b == int(hashlib.md5(f"42|{row.patient_nbr}".encode()).hexdigest()[:8], 16) % 100


@pytest.mark.parametrize("method", ["hash", "random"])
def test_split_is_a_partition_without_overlap(visits, method):
    df = visits[0].filter("patient_nbr IS NOT NULL")
    train, test = split.prepare_train_test_split(df, method=method)
    ids = [r.encounter_id for r in train.collect()] + [r.encounter_id for r in test.collect()]
    assert sorted(ids) == sorted(r.encounter_id for r in df.collect())
    assert split.validate_data_leakage_prevention(train, test)


def test_hash_split_keeps_rows_without_entity_and_ignores_partitioning(visits):
    df = visits[0]
    train, test = split.prepare_train_test_split(df)
    assert train.count() + test.count() == df.count()
    again, _ = split.prepare_train_test_split(df.repartition(7))
    assert sorted(r.encounter_id for r in train.collect()) == sorted(r.encounter_id for r in again.collect())


def test_hash_split_does_not_shuffle(visits):
    train, _ = split.prepare_train_test_split(visits[0])
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_unknown_split_method(visits):
    with pytest.raises(ValueError, match="method"):
        split.prepare_train_test_split(visits[0], method="luck")


def test_overlap_is_found(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "patient_nbr int")
    b = spark.createDataFrame([(2,), (3,)], "patient_nbr int")
    assert split.entity_overlap(a, b).first() == (2, 2, 1, False)
    assert not split.validate_data_leakage_prevention(a, b)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "readmit_30 int")
    neg, pos = split.calculate_class_weights(df)
    assert (neg, pos) == (pytest.approx(8 / 12), pytest.approx(2.0))
    weighted = split.add_sample_weights(df, neg, pos)
    assert weighted.agg(F.sum("sample_weight")).first()[0] == pytest.approx(8.0)
    three = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "readmit_30 string")
    assert {r.readmit_30: r.weight for r in split.class_weight_table(three).collect()} == {
        "a": pytest.approx(4 / 6), "b": pytest.approx(4 / 3), "c": pytest.approx(4 / 3),
    }


def test_absent_class_is_named(spark):
    with pytest.raises(ValueError, match=r"\[1\]"):
        split.calculate_class_weights(spark.createDataFrame([(0,)], "readmit_30 int"))


def test_class_distribution(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "readmit_30 int")
    assert {r.readmit_30: (r.n, r.pct) for r in split.class_distribution(df).collect()} == {0: (2, 66.67), 1: (1, 33.33)}
    assert split.base_rate(df).first().base_rate == pytest.approx(1 / 3)


def test_unscored_rows(spark):
    data = spark.createDataFrame([(1,), (2,), (3,)], "encounter_id int")
    assert [r.encounter_id for r in unscored_rows(data, data.filter("encounter_id <> 2")).collect()] == [2]
