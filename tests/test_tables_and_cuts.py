"""Category tables, exact cuts and user steps against plain Python."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import category_table, split, training
from riskloom.plans.stages import ExpressionStep
from riskloom.sources.sinks import load_model, save_model


def test_categories_equal_plain_counting_and_the_indexer(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", "b", "c", None, "é"]), f"v{int(rnd.paretovariate(0.7)) % 900}", rnd.choice((1, 2, None))) for _ in range(5000)]
    df = spark.createDataFrame(rows, "x string, y string, z int").repartition(5)
    columns = ["x", "y", "z"]
    category_table.save_categories(category_table.category_table(df, columns), str(tmp_path))
    table = category_table.load_categories(spark, str(tmp_path))
    found = {(r.column_name, r.value): (r.n, r.idx) for r in table.collect()}
    wanted = {}
    for i, c in enumerate(columns):
        counts = collections.Counter(str(r[i]) for r in rows if r[i] is not None)
        for k, (v, n) in enumerate(sorted(counts.items(), key=lambda e: (-e[1], e[0]))):
            wanted[c, v] = (n, k)
    assert found == wanted
    encoder = training.create_feature_pipeline([], [], ["x", "y"])[0].fit(df.dropna())
    indexer = {(r.column_name, r.value): r.idx for r in training.category_index(encoder, spark).collect()}
    own = {(r.column_name, r.value): r.idx for r in category_table.category_table(df.dropna(), ["x", "y"]).collect()}
    assert own == indexer
    more = df.unionByName(spark.createDataFrame([("new", None, 7)], df.schema))
    indexed = category_table.index_categories(more, table, columns).collect()
    assert len(indexed) == 5001
    for r in indexed:
        for c in columns:
            value = None if r[c] is None else str(r[c])
            assert r[f"{c}_indexed"] == found.get((c, value), (0, sum(1 for k in found if k[0] == c)))[1]


def test_no_categories(spark):
    df = spark.createDataFrame([(None,)], "x string")
    table = category_table.category_table(df, ["x"])
    assert table.count() == 0 and category_table.index_categories(df, table, ["x"]).collect()[0].x_indexed == 0


def place(key, seed=42):
    text = str(seed) if key is None else f"{seed}|{key}"
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16), "" if key is None else str(key)


@pytest.mark.parametrize("share", [0.0, 0.001, 0.37, 0.8, 1.0])
def test_exact_cut_by_narrowing(spark, share):
    keys = [None, *range(900)]
    df = spark.createDataFrame([(k,) for k in keys for _ in range(2)], "patient_nbr long")
    ordered = sorted(map(place, keys))
    wanted = int(share * len(keys) + 0.5)
    for bits, few in ((12, 4096), (4, 3), (20, 1)):
        cut = split.exact_cut(df, "patient_nbr", share, bits=bits, few=few)
        assert cut == (ordered[wanted - 1] if wanted else None)
    train, test = split.prepare_train_test_split(df, share, 1 - share, method="random")
    assert train.distinct().count() == wanted and train.count() + test.count() == 2 * len(keys)
    assert {place(r.patient_nbr) for r in train.collect()} == set(ordered[:wanted])


def test_equal_places_are_told_apart_by_key(spark, monkeypatch):
    monkeypatch.setattr(split, "_place", lambda key, seed: F.lit(7).cast("bigint"))
    df = spark.createDataFrame([(k,) for k in range(10)], "patient_nbr long")
    part = split.exact_split_part(df, train_ratio=0.3, test_ratio=0.7)
    assert sorted(r.patient_nbr for r in df.filter(part == "train").collect()) == [0, 1, 2]


def test_user_step_survives_saving_and_names_what_does_not_fit(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    save_model(PipelineModel(stages=[ExpressionStep({"c": "a + b", "b": "b * 2"}, {"a": "int", "b": "double"})]), str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    assert loaded.transform(df).collect()[0].asDict() == {"a": 1, "b": 4.0, "c": 3.0}
    for wrong in (df.drop("b"), df.withColumn("a", F.col("a").cast("string"))):
        with pytest.raises(ValueError, match="needs"):
            loaded.transform(wrong)
