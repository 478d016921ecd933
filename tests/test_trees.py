"""Node tables, cut forests, searches that read them, patience, and trees with cuts and draws of their own."""

import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.functions.draws import draw, fold, uniform
from beatgrid.learn import nodes, singles, train
from beatgrid.sources import files

X = [f"f{k}" for k in range(5)]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        x = [round(rng.random(), 3) for _ in range(4)]
        rows.append((i, *x, 7.0, int(x[0] + x[1] * x[2] + 0.2 * rng.random() > 1.05)))
    df = spark.createDataFrame(rows, "incident_id long, f0 double, f1 double, f2 double, f3 double, f4 double, y int")
    return files.materialised(df, "table")


@pytest.fixture(scope="module")
def data(table):
    return files.materialised(train.prepared(train.vectors(table, X), "", "y"), "vectors")


def scores(model, data):
    return {r.incident_id: (r.prediction, r.score) for r in train.scored(model, data, "y").select("incident_id", "prediction", "score").collect()}


def same(one, two):
    assert one.keys() == two.keys()
    assert all(one[i][0] == two[i][0] and abs(one[i][1] - two[i][1]) < 1e-9 for i in one)


def cut(trees, data, n, depth):
    got = nodes.cut_scores(trees, data, ["incident_id"], [n], [depth]).collect()
    return {r.incident_id: (r.prediction, r.score) for r in got}


def test_draws_are_those_of_md5(spark):
    import hashlib

    got = spark.createDataFrame([(5,), (None,)], "i long").select(draw(F.col("i"), 42).alias("d"), uniform(F.col("i"), 1, 2).alias("u"), fold(F.col("i"), 7).alias("f")).collect()
    for row, text in zip(got, ("5", "")):
        digest = hashlib.md5(f"{text}:42".encode()).hexdigest()
        assert (row.d, row.f) == (int(digest[:15], 16), int(digest[:15], 16) % 7)
        assert row.u == int(hashlib.md5(f"{text}:1:2".encode()).hexdigest()[:13], 16) / 2**52


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_cut_forest_is_the_one_fitted_with_that_depth(spark, data, impurity):
    def fitted(depth):
        params = {"numTrees": 6, "maxDepth": depth, "impurity": impurity, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"}
        return train.FAMILIES["random_forest"](params, "y").fit(data)

    deep = fitted(15)
    trees = nodes.Trees.of(nodes.node_table(deep, spark))
    assert len(trees.feature) == deep.totalNumNodes and trees.depth.max() > 6
    same(cut(trees, data, 6, None), scores(deep, data))
    for depth in (0, 1, 3, 6):
        same(cut(trees, data, 6, depth), scores(fitted(depth), data))


def test_first_trees_vote_alone(spark, data):
    model = train.FAMILIES["random_forest"]({"numTrees": 7, "maxDepth": 4}, "y").fit(data)
    trees = nodes.Trees.of(nodes.node_table(model, spark))
    x = np.array([[r[c] for c in range(5)] for r in (v.features.toArray() for v in data.select("features").limit(50).collect())])
    (one,) = [raw for _, _, raw in trees.first_trees(3).votes(x, [None], [3])]
    found = {n: raw for _, n, raw in trees.votes(x, [None], [3, 7])}
    assert np.allclose(one, found[3]) and np.allclose(found[7].sum(axis=1), 7)
    with pytest.raises(ValueError):
        nodes.cut_scores(trees, data, [], [8])
    assert nodes.cut_scores(trees, data.limit(0), ["y"], [2]).count() == 0


def test_first_rounds_are_the_model_of_fewer_rounds(spark, data, tmp_path):
    learner = train.FAMILIES["xgboost"]({"maxIter": 12, "maxDepth": 3}, "y")
    long, short = learner.fit(data), learner.copy({learner.maxIter: 5}).fit(data)
    trees = nodes.Trees.of(nodes.node_table(long, spark))
    same(cut(trees, data, 12, None), scores(long, data))
    same(cut(trees, data, 5, None), scores(short, data))
    shorter = nodes.first_rounds(long, 5, spark)
    same(scores(shorter, data), scores(short, data))
    shorter.write().save(str(tmp_path / "m"))
    assert len(type(shorter).load(str(tmp_path / "m")).trees) == 5
    with pytest.raises(ValueError):
        nodes.first_rounds(long, 13, spark)
    curve = nodes.boosting_curve(trees, data, "y").orderBy("round").collect()
    p = scores(short, data)
    y = {r.incident_id: r.y for r in data.select("incident_id", "y").collect()}
    tp, wrong = sum(p[i][0] and y[i] for i in p), sum(p[i][0] != y[i] for i in p)
    assert len(curve) == 12 and curve[4].f1 == pytest.approx(2 * tp / (2 * tp + wrong)) and curve[4].n == 900


def test_importances_from_nodes_are_the_models(spark, data):
    model = train.FAMILIES["random_forest"]({"numTrees": 9, "maxDepth": 6}, "y").fit(data)
    ours = {r.feature: r.importance for r in train.importances_from_nodes(model, data, X).collect()}
    assert ours == {r.feature: pytest.approx(r.importance) for r in train.importance_table(model, data, X).collect()}
    assert ours["f4"] == 0.0  # constant


@pytest.mark.parametrize(
    ("curve", "patience", "want"),
    [
        ([0.1, 0.3, 0.2, 0.3, 0.29, 0.5], 3, (2, 5)),
        ([0.1, 0.3, 0.2, 0.3, 0.29, 0.5], 4, (6, 6)),
        ([0.0, 0.0, 0.0], 2, (1, 3)),
        ([0.2, 0.2, 0.2, 0.9], 2, (1, 3)),
        ([0.1, 0.2, 0.3], 1, (3, 3)),
        ([0.4], 20, (1, 1)),
    ],
)
def test_patience_on_known_curves(curve, patience, want):
    assert nodes.best_round(curve, patience) == want


def test_patience_on_given_rows(table):
    fit_on, given = table.filter("incident_id % 3 > 0"), table.filter("incident_id % 3 = 0")
    found = train.train_with_patience(fit_on, X, "y", "catboost", given, patience=3, overrides={"maxIter": 25, "maxDepth": 2})
    assert (found.n_fit, found.n_evaluation, len(found.scores)) == (600, 300, 25)
    assert (found.best, found.stopped) == nodes.best_round(found.scores, 3) and len(found.model.trees) == found.best
    # rounds after the end play no part, and without evaluation rows none is cut
    short = train.train_with_patience(fit_on, X, "y", "catboost", given, patience=3, overrides={"maxIter": found.stopped, "maxDepth": 2})
    assert (short.best, short.scores) == (found.best, found.scores[: found.stopped])
    none = train.train_with_patience(fit_on, X, "y", "catboost", given.limit(0), patience=3, overrides={"maxIter": 4, "maxDepth": 2})
    assert len(none.model.trees) == 4 and none.scores == []


def test_folds_hold_given_rows_only(table):
    tables = train.fold_tables(table, X, "y", 3, "incident_id", "smote")
    seen = []
    for fit, held in tables:
        ids = {r.incident_id for r in held.collect()}
        assert not ids & {r.incident_id for r in fit.select("incident_id").collect()}
        n = {(r.y, r.is_synthetic): r["count"] for r in fit.groupBy("y", "is_synthetic").count().collect()}
        small = min(n[0, False], n[1, False])
        assert n[0, False] + n.get((0, True), 0) == n[1, False] + n.get((1, True), 0) == 900 - len(ids) - small
        seen += ids
    assert sorted(seen) == list(range(900))
    with pytest.raises(ValueError):
        train.resampled(table, X, "y", "incident_id", "mirror")


def test_search_scores_are_those_of_fits_per_candidate(table):
    """Without random draws of features or rows, one fit answers the whole grid exactly."""
    learner = train.FAMILIES["random_forest"]({"bootstrap": False, "featureSubsetStrategy": "all"}, "y")
    grid = train.param_grid(learner, {"numTrees": [2, 5], "maxDepth": [1, 3, 12], "minInstancesPerNode": [1, 4]})
    fits = train._fits(learner, grid)
    assert sorted(sum((m for _, m in fits), [])) == list(range(12)) and len(fits) == 2
    found = train._search(table, learner, grid, X, "y", "accuracy", 3, "incident_id", 4)
    tables = train.fold_tables(table, X, "y", 3, "incident_id")
    for k in (0, 5, 7, 10):
        for f, (fit, held) in enumerate(tables):
            right = [r.y == r.prediction for r in learner.copy(grid[k]).fit(fit).transform(held).select("y", "prediction").collect()]
            assert found.foldMetrics[k][f] == pytest.approx(sum(right) / len(right))
    assert set(found.rows) == {900}
    assert found.bestModel.getNumTrees == found.best[learner.numTrees]


def test_folds_are_made_side_by_side(table, monkeypatch):
    together, plain = threading.Barrier(3, timeout=60), train.smote
    monkeypatch.setattr(train, "smote", lambda *a: (together.wait(), plain(*a))[1])
    assert len(train.fold_tables(table, X, "y", 3, "incident_id", "smote")) == 3


@pytest.mark.parametrize("name", ["ml7", "ml7b"])
def test_families_are_fitted_side_by_side(spark, table, monkeypatch, name):
    from workload import learn_queries

    families = train.available()
    together = threading.Barrier(len(families), timeout=60)
    small = train.estimator("random_forest", "y", {"numTrees": 2, "maxDepth": 2}).fit(train.vectors(table, X))
    monkeypatch.setattr(learn_queries, "INPUT", X)
    monkeypatch.setattr(learn_queries, "LABEL", "y")
    monkeypatch.setattr(learn_queries, "halves", lambda *_: (table, table))
    monkeypatch.setattr(train, "train", lambda *_: (together.wait(), small)[1])
    got = getattr(learn_queries, name)(spark, "").collect()
    assert [r.model for r in got] == families
    if name == "ml7b":
        assert {(r.n_rows, r.n_in_range, r.separates) for r in got} == {(900, 900, True)}


def test_large_forests_of_a_search_are_fitted_in_blocks(table, monkeypatch):
    """No fit grows more nodes than the driver may hold, and without random draws the scores stay the same."""
    learner = train.FAMILIES["random_forest"]({"bootstrap": False, "featureSubsetStrategy": "all"}, "y")
    grid = train.param_grid(learner, {"numTrees": [2, 5, 7], "maxDepth": [1, 3, 12], "minInstancesPerNode": [1]})
    whole = train._search(table, learner, grid, X, "y", "accuracy", 3, "incident_id", 4)
    grown, plain = [], nodes.node_table
    monkeypatch.setattr(train, "FIT_NODES", 250, raising=False)
    monkeypatch.setattr(nodes, "node_table", lambda model, spark: grown.append((model.getNumTrees, model.totalNumNodes)) or plain(model, spark))
    found = train._search(table, learner, grid, X, "y", "accuracy", 3, "incident_id", 4)
    assert sum(n for n, _ in grown) == 3 * 7 and all(n == 1 or size <= 1.5 * 250 for n, size in grown)
    assert found.rows == whole.rows and [x for m in found.foldMetrics for x in m] == pytest.approx([x for m in whole.foldMetrics for x in m])


def test_blocks_of_a_forest_have_trees_of_their_own(spark, table, monkeypatch):
    seen, plain = [], nodes.with_votes
    monkeypatch.setattr(train, "FIT_NODES", 250)
    monkeypatch.setattr(nodes, "with_votes", lambda trees, *rest: seen.append(trees) or plain(trees, *rest))
    found = train.grid_search(table, X, "y", "random_forest", folds=2, grid={"numTrees": [3, 6], "maxDepth": [12]}, parallelism=1)
    one = [sorted(zip(t.feature.tolist(), t.threshold.tolist())) for t in seen]
    assert len(one) > 2 and all(a != b for k, a in enumerate(one) for b in one[:k])
    assert found.rows == [900, 900] and min(found.avgMetrics) > 0.8


def test_out_of_fold_scores(spark, table):
    families = {"random_forest": {"numTrees": 4, "maxDepth": 3}, "xgboost": {"maxIter": 3, "maxDepth": 2}}
    data = train.vectors(table, X).withColumn("fold", F.pmod("incident_id", F.lit(3)).cast("int"))
    scored, bases = train.out_of_fold(data, "y", families, 3, "incident_id")
    got = {r.incident_id: r for r in scored.collect()}
    assert sorted(got) == list(range(900)) and set(bases) == set(families)
    rest = train.prepared(data.filter("fold <> 1"), "xgboost", "y", "incident_id")
    model = train.estimator("xgboost", "y", families["xgboost"]).fit(rest.select("features", "y", "weight"))
    for i, s in ((r.incident_id, r.s) for r in train.positive_score(model, data.filter("fold = 1"), "s").select("incident_id", "s").collect()):
        assert got[i].base_xgboost == pytest.approx(s)
    with pytest.raises(ValueError, match="scores"):
        train.out_of_fold(data.unionByName(data.limit(1)), "y", families, 3, "incident_id")


def test_boosted_search_reads_rounds_off_one_fit(table):
    found = train.grid_search(table, X, "y", "xgboost", folds=2, grid={"maxIter": [2, 6], "maxDepth": [2, 3]}, resample="undersample")
    learner = train.FAMILIES["xgboost"]({}, "y")
    assert len(train._fits(learner, train.param_grid(learner, {"maxIter": [2, 6], "maxDepth": [2, 3]}))) == 2
    assert len(found.points) == 4 and all(len(m) == 2 and 0 < min(m) for m in found.foldMetrics)


def test_extra_trees_have_cuts_of_their_own(spark, table):
    model = train.train(table, X, "y", "extra_trees", overrides={"numTrees": 6, "maxDepth": 5})
    t = model.trees
    assert len(t.roots) == 6 and model.featureImportances.sum() == pytest.approx(1)
    cuts = [set(zip(part.feature[part.feature >= 0], part.threshold[part.feature >= 0])) for part in (t.first_trees(k) for k in range(1, 7))]
    sizes = [len(c) for c in cuts]
    assert sizes == sorted(set(sizes))  # every further tree adds points that none had before
    assert all(f != 4 for f, _ in cuts[-1]) and all(0 <= v <= 1 for _, v in cuts[-1])
    drawn = singles.random_cuts(np.zeros(2), np.array([1.0, 0.0]), 3, 42)
    assert len(drawn[0]) == singles.CUTS and drawn[1].tolist() == [0.0]
    # the first tree of the ensemble ends where a tree on the binned values ends
    low, high = [np.array([float(table.agg(f(c)).first()[0]) for c in X]) for f in (F.min, F.max)]
    points = singles.random_cuts(low, high, 0, train.SEED)
    assert cuts[0] <= {(j, v) for j, c in enumerate(points) for v in c}
    assert train.scored(model, train.vectors(table, X), "y").filter("prediction = y").count() > 700


def test_every_tree_of_a_balanced_forest_has_its_own_draw(table):
    rare = table.withColumn("y", F.when(F.col("incident_id") % 9 == 0, F.col("y")).otherwise(0))
    few = rare.filter("y = 1").count()
    drawn = singles.balanced_draws(rare.select("incident_id", "y"), "y", 20, "incident_id", 42).collect()
    by = {t: {r.incident_id for r in drawn if r.tree == t} for t in range(20)}
    assert all(few * 1.2 < len(s) < few * 3 for s in by.values()) and len({frozenset(s) for s in by.values()}) == 20
    positive = {r.incident_id for r in rare.filter("y = 1").collect()}
    assert all(positive <= s for s in by.values())
    model = train.train(rare, X, "y", "balanced_random_forest", overrides={"numTrees": 20, "maxDepth": 4})
    assert len(model.trees.roots) == 20
