"""Forests grown by tasks against Spark's own."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from beatgrid.learn import forest, nodes, train
from beatgrid.sources import files

X = [f"f{k}" for k in range(5)]
PLAIN = {"bootstrap": False, "featureSubsetStrategy": "all"}  # no random draws: Spark's trees and ours are the same


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        x = [round(rng.random(), 3), round(rng.random(), 3), float(rng.randrange(4)), rng.random() if rng.random() < 0.3 else 0.0]
        rows.append((i, *x, 7.0, int(x[0] + x[1] * x[2] / 3 + 0.2 * rng.random() > 0.9), int(3 * min(0.99, x[0] * 0.8 + 0.25 * rng.random()))))
    df = spark.createDataFrame(rows, "incident_id long, f0 double, f1 double, f2 double, f3 double, f4 double, y int, z int")
    return files.materialised(df.repartition(3), "table")


def growth(learner, params, n_rows):
    values = {p.name: v for p, v in learner.extractParamMap(params).items()}
    return forest.Growth.of(values, len(X), n_rows, train.SEED)


@pytest.mark.parametrize(("impurity", "rows_of_a_task"), [("gini", 1_000_000), ("entropy", 150)])
def test_a_search_by_tasks_scores_as_sparks_fits(table, monkeypatch, impurity, rows_of_a_task):
    """Large forests never come to the driver, large nodes are split by all tasks, and the scores stay the same."""
    learner = train.FAMILIES["random_forest"](PLAIN, "y")
    grid = train.param_grid(learner, {"numTrees": [2, 5], "maxDepth": [1, 12, 3], "minInstancesPerNode": [2], "impurity": [impurity]})
    whole = train._search(table, learner, grid, X, "y", "accuracy", 2, "incident_id", 4)
    monkeypatch.setattr(train, "FIT_NODES", 100)
    monkeypatch.setattr(train, "FEW_ROWS", 0, raising=False)
    monkeypatch.setattr(forest, "TASK_ROWS", rows_of_a_task)
    monkeypatch.setattr(nodes, "node_table", lambda *_: pytest.fail("the nodes of a large forest came to the driver"))
    found = train._search(table, learner, grid, X, "y", "accuracy", 2, "incident_id", 4)
    assert found.rows == whole.rows == [900] * 6
    assert [x for m in found.foldMetrics for x in m] == pytest.approx([x for m in whole.foldMetrics for x in m])


@pytest.mark.parametrize("rows_of_a_task", [1_000_000, 150])
def test_votes_of_three_classes_are_sparks(table, spark, monkeypatch, rows_of_a_task):
    monkeypatch.setattr(forest, "TASK_ROWS", rows_of_a_task)
    learner = train.FAMILIES["random_forest"](PLAIN, "z")
    data = files.materialised(train.vectors(table, X), "vectors")
    deep = {learner.numTrees: 2, learner.maxDepth: 9, learner.minInstancesPerNode: 2}
    rows = forest.binned(data, "z", len(X), 32, train.SEED)
    trees = forest.grow(spark, rows, growth(learner, deep, 900))
    assert sorted(r.tree for r in trees.collect()) == [0, 1] and rows.classes == 3
    both = data.select("features", F.col("incident_id").cast("int").alias("incident_id"))  # the id in the label's place comes back with each vote
    got = {r.incident_id: np.array(r.raw).reshape(2, 1, 3) for r in forest.votes(trees, both, "incident_id", rows, [2], [4, 9]).collect()}
    for at, depth in enumerate([4, 9]):
        model = learner.copy({**deep, learner.maxDepth: depth}).fit(data)
        for r in model.transform(data).select("incident_id", vector_to_array("rawPrediction").alias("raw")).collect():
            assert got[r.incident_id][at, 0] == pytest.approx(r.raw)


def test_random_trees_differ_and_agree_with_sparks(table, spark, monkeypatch):
    grid = {"numTrees": [10, 20], "maxDepth": [10]}
    whole = train.grid_search(table, X, "y", "random_forest", folds=2, grid=grid)
    monkeypatch.setattr(train, "FIT_NODES", 100)
    monkeypatch.setattr(train, "FEW_ROWS", 0)
    found = train.grid_search(table, X, "y", "random_forest", folds=2, grid=grid)
    assert found.rows == [900, 900] and found.avgMetrics == pytest.approx(whole.avgMetrics, abs=0.03)
    learner = train.FAMILIES["random_forest"]({}, "y")
    data = files.materialised(train.vectors(table, X), "vectors")
    trees = forest.grow(spark, forest.binned(data, "y", len(X), 32, train.SEED), growth(learner, {learner.numTrees: 6, learner.maxDepth: 12}, 900)).collect()
    assert len(trees) == 6 == len({bytes(r.feature) for r in trees})


def test_rows_are_drawn_as_often_as_poisson_says():
    g = forest.Growth(9, 5, 1, 0.0, "gini", 2, True, 1.0, 42)
    w = [forest.drawn(1 << 40, 20_000, t, g) for t in range(2)]
    for one in w:
        assert one.mean() == pytest.approx(1, abs=0.03) and one.var() == pytest.approx(1, abs=0.05)
    assert abs(np.corrcoef(*w)[0, 1]) < 0.03
    assert (forest.drawn((1 << 40) + 7, 100, 0, g) == w[0][7:107]).all()  # a row's draw does not hang on its block


def test_cuts_are_sparks(table):
    """Every threshold that Spark splits at is one of the cuts, with few values and with many."""
    data = train.vectors(table, X)
    model = train.FAMILIES["random_forest"]({"numTrees": 20, "maxDepth": 10}, "y").fit(data)
    used = nodes.Trees.of(nodes.node_table(model, table.sparkSession))
    cuts = [forest.cut_points(np.array([r[c] for r in table.select(c).collect()]), 900, 32) for c in X]
    assert [len(c) for c in cuts][2::2] == [3, 0] and all(len(c) <= 31 for c in cuts)
    for f, t in zip(used.feature, used.threshold):
        assert f < 0 or np.abs(cuts[f] - t).min() < 1e-12


def test_rows_without_a_label_are_an_error(table):
    data = train.vectors(table, X)
    with pytest.raises(ValueError, match="whole number"):
        forest.binned(data.withColumn("y", F.when(F.col("incident_id") > 3, F.col("y"))), "y", len(X), 32, 1)
    with pytest.raises(ValueError, match="no rows"):
        forest.binned(data.limit(0), "y", len(X), 32, 1)


def test_features_drawn_for_a_node_are_as_many_as_sparks():
    given = dict(numTrees=5, maxDepth=3, minInstancesPerNode=1, minWeightFractionPerNode=0.0, minInfoGain=0.0, impurity="gini", bootstrap=True, subsamplingRate=1.0)
    for how, n in (("auto", 4), ("sqrt", 4), ("log2", 4), ("onethird", 5), ("all", 15), ("7", 7), ("99", 15), ("0.5", 8), ("1.0", 15)):
        assert forest.Growth.of({**given, "featureSubsetStrategy": how}, 15, 100, 1).features == n
    assert forest.Growth.of({**given, "featureSubsetStrategy": "auto", "numTrees": 1}, 15, 100, 1).features == 15
