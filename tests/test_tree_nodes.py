"""Node tables walked by another engine, and fits that don't depend on the files of the input."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import layout, tree_nodes
from riskloom.operators.training import FEATURES, importances, make_classifier, train_all_models, training_rows
from riskloom.sources.sinks import save_model
from riskloom.workload import registry

SMALL = {"Random Forest": {"numTrees": 7, "maxDepth": 5}, "Gradient Boosted Trees": {"maxIter": 6, "maxDepth": 3}}
NUMBERS, FLAGS, WORDS = ["a", "b"], ["f"], ["w"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).selectExpr(
        "id AS encounter_id", "id % 500 AS patient_nbr", "cast((id * 7919) % 1013 AS double) AS a", "cast((id * 31) % 97 AS double) / 3 AS b",
        "cast(id % 5 = 0 AS int) AS f", "element_at(array('x', 'y', 'z', 'q'), cast(id % 4 AS int) + 1) AS w",
        "cast((id * 7919) % 1013 > 500 AND id % 3 > 0 OR id % 11 = 0 AS int) AS readmit_30",
    )


@pytest.fixture(scope="module")
def trained(spark, rows):
    return train_all_models(rows.filter("id % 5 > 0".replace("id", "encounter_id")), rows, NUMBERS, FLAGS, WORDS, SMALL)[0]


# the walk as one recursive query, and the sums of the leaves
WALK = """
    WITH RECURSIVE walk(k, tree, node) AS (
        SELECT DISTINCT r.k, n.tree, 0 FROM rows r, nodes n
        UNION ALL
        SELECT w.k, w.tree, CASE WHEN r.x[n.feature + 1] <= n.threshold THEN n.left_node ELSE n.right_node END
        FROM walk w JOIN nodes n USING (tree, node) JOIN rows r USING (k) WHERE n.left_node >= 0
    ),
    leaves AS (SELECT k, n.* FROM walk JOIN nodes n USING (tree, node) WHERE n.left_node < 0)
    SELECT k, {score} AS score FROM leaves GROUP BY k
"""
SCORES = {
    "Random Forest": "sum(class_weights[2] / (class_weights[1] + class_weights[2])) / count(*)",
    "Gradient Boosted Trees": "1 / (1 + exp(-2 * sum(prediction * tree_weight)))",
}


@pytest.mark.parametrize("name", list(SMALL))
def test_walk_equals_the_model_and_another_engine(spark, trained, tmp_path, name):
    save_model(trained[name].model, f"{tmp_path}/model")
    ensemble = tree_nodes.load_ensemble(spark, f"{tmp_path}/model")
    assert ensemble.n_trees == trained[name].model.stages[-1].getNumTrees
    scored = trained[name].predictions.select("encounter_id", "prediction", "readmission_probability", vector_to_array(FEATURES).alias("features"))
    again = {r.encounter_id: r for r in tree_nodes.tree_scores(scored, ensemble, ["encounter_id"], score="s").collect()}
    nodes, points = ensemble.nodes.toArrow(), scored.select(F.col("encounter_id").alias("k"), F.col("features").alias("x")).toArrow()  # noqa: F841
    con = duckdb.connect()
    con.execute("CREATE TABLE nodes AS SELECT * FROM nodes")
    con.execute("CREATE TABLE rows AS SELECT * FROM points")
    other = dict(con.execute(WALK.format(score=SCORES[name])).fetchall())
    model = scored.collect()
    assert len(model) == len(again) == len(other) == 4000
    for r in model:
        assert again[r.encounter_id].s == pytest.approx(r.readmission_probability, abs=1e-12)
        assert again[r.encounter_id].prediction == r.prediction
        assert other[r.encounter_id] == pytest.approx(r.readmission_probability, abs=1e-12)
    given = importances(trained[name].model.stages[-1])
    found = {r.feature: r.importance for r in tree_nodes.node_importance(ensemble).collect()}
    assert [found.get(i, 0.0) for i in range(len(given))] == pytest.approx(given, abs=1e-12)


def test_only_tree_models_have_nodes(spark, rows, tmp_path):
    linear = train_all_models(rows, rows, NUMBERS, FLAGS, WORDS, {"Logistic Regression": {"maxIter": 2}})[0]
    save_model(linear["Logistic Regression"].model, f"{tmp_path}/model")
    with pytest.raises(ValueError, match="no ensemble"):
        tree_nodes.load_ensemble(spark, f"{tmp_path}/model")


def test_same_model_for_any_files(spark, rows, tmp_path):
    found = []
    for files in (1, 8):
        rows.orderBy(F.hash("encounter_id", F.lit(files))).repartition(files).write.parquet(f"{tmp_path}/{files}")
        train = spark.read.parquet(f"{tmp_path}/{files}")
        results, _ = train_all_models(train, rows, NUMBERS, FLAGS, WORDS, SMALL, rows_per_task=700)
        trees = [t.toDebugString.split("\n", 1)[1] for r in results.values() for t in r.model.stages[-1].trees]
        scores = {name: {r.encounter_id: r.readmission_probability for r in result.predictions.collect()} for name, result in results.items()}
        found.append((trees, scores))
    assert found[0][0] == found[1][0]
    for name in SMALL:
        assert found[0][1][name] == pytest.approx(found[1][1][name], abs=1e-9)


def test_rows_are_dealt_evenly_and_in_one_order(spark, rows):
    columns = ["encounter_id", "a", "w"]
    first = layout.dealt(rows.repartition(3), columns, 4000, 500)
    assert first.rdd.getNumPartitions() == 8 and max(map(len, first.rdd.glom().collect())) < 700
    second = layout.dealt(rows.repartition(7, "b"), columns, 4000, 500)
    assert first.rdd.glom().collect() == second.rdd.glom().collect()
    assert layout.task_count(0) == 1 and layout.task_count(10**12) == layout.MOST_TASKS


def test_tasks_of_a_fit_do_not_grow_with_the_rows_before_they_are_full():
    assert [layout.task_count(n) for n in (12_500, 100_000, 600_000)] == [1, 8, 48]
    assert layout.task_count(600_001) == layout.task_count(6_000_000) == layout.ENOUGH_TASKS
    assert layout.task_count(36_000_000) == 72
    counts = [layout.task_count(10**6 * n, 700) for n in range(1, 200)]
    assert counts == sorted(counts)


def test_rows_of_a_forest_keep_their_nodes_and_the_trees_are_the_same(spark, rows):
    encoded, _ = training_rows(rows, NUMBERS, FLAGS, WORDS, rows_per_task=700)
    kept = make_classifier("Random Forest", **SMALL["Random Forest"])
    assert kept.getCacheNodeIds()
    walked = make_classifier("Random Forest", **SMALL["Random Forest"], cacheNodeIds=False)
    first, second = ([t.toDebugString.split("\n", 1)[1] for t in c.fit(encoded).trees] for c in (kept, walked))
    assert first == second


def test_walk_is_dealt_to_tasks_by_key(spark, trained, tmp_path):
    save_model(trained["Random Forest"].model, f"{tmp_path}/model")
    ensemble = tree_nodes.load_ensemble(spark, f"{tmp_path}/model")
    scored = trained["Random Forest"].predictions.select("encounter_id", vector_to_array(FEATURES).alias("features"))
    leaves = tree_nodes.reached_leaves(scored.coalesce(1), ensemble, ["encounter_id"])
    assert leaves.groupBy(F.spark_partition_id()).count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_fits_prepare_from_stored_encounters(spark, small, monkeypatch):
    class Seen(Exception):
        pass

    def seen(df):
        raise Seen(df.inputFiles())

    monkeypatch.setattr(registry, "prepare_encounters", seen)
    with pytest.raises(Seen) as found:
        registry._trained(spark, small, "Random Forest")
    files = found.value.args[0]
    assert files and all("/riskloom/encounters-" in f for f in files)
