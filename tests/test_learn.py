"""Evaluation, resampling, training and scoring."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.learn import anomaly, evaluate, importance, neighbours, prep, resample, score, train
from beatgrid.sources import files

X = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        y = int(i % 6 == 0)
        rows.append((i, rng.gauss(2.0 * y, 1.0), rng.gauss(0, 1), float(rng.randint(0, 3)), y))
    return spark.createDataFrame(rows, "incident_id bigint, x1 double, x2 double, x3 double, y int")


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_zero_division_gives_zero(spark):
    df = scored(spark, [(0, 0, 0.1)] * 4 + [(1, 0, 0.2)] * 2)
    row = evaluate.metrics(df).first()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)
    assert row.accuracy == pytest.approx(4 / 6)
    assert {(r.label, r.prediction): r.n for r in evaluate.confusion_matrix(df).collect()} == {
        (0, 0): 4, (0, 1): 0, (1, 0): 2, (1, 1): 0,
    }


def test_auc_with_ties_and_one_class(spark):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.3), 0, round(rng.random(), 1)) for _ in range(200)]
    got = evaluate.roc_auc(scored(spark, rows)).first().roc_auc
    pos = [s for y, _, s in rows if y]
    neg = [s for y, _, s in rows if not y]
    assert got == pytest.approx(
        sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    )
    assert evaluate.roc_auc(scored(spark, [(0, 0, 0.5)])).first().roc_auc is None


def test_gate_and_risk(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.69), ("c", 0.59)], "model string, f1_score double")
    got = {r.model: (r.approved, r.risk) for r in evaluate.quality_gate(df).collect()}
    assert got == {"a": (True, "Low"), "b": (False, "Low"), "c": (False, "High")}


def test_votes(spark):
    df = spark.createDataFrame([(0.9, 0.2, 0.4), (0.9, 0.6, 0.1)], "a double, b double, c double")
    w = {"a": 1.0, "b": 1.0, "c": 1.0}
    assert [r.prediction for r in evaluate.vote(df, w, "soft").collect()] == [0, 1]
    assert [r.prediction for r in evaluate.vote(df, w, "hard").collect()] == [0, 1]
    assert [r.prediction for r in evaluate.vote(df, {"a": 1.0, "b": 1.0}, "hard").collect()] == [0, 1]


@pytest.mark.parametrize("leaf_rows", [40, 10**6])
def test_neighbours_are_exact(spark, leaf_rows):
    rng = np.random.default_rng(2)
    points = np.round(rng.normal(size=(700, 4)), 1)
    points[:, 2] = points[:, 2] > 0
    points[:200] = points[200]  # a third of the rows are copies of one point
    distinct, counts = np.unique(points, axis=0, return_counts=True)
    df = spark.createDataFrame(
        [(i, [float(v) for v in p], int(n)) for i, (p, n) in enumerate(zip(distinct, counts))],
        "vid bigint, point array<double>, n bigint",
    )
    got = neighbours.nearest(df, 5, leaf_rows).collect()
    assert len(got) == len(distinct)
    for row in got:
        here = np.array(row.point)
        want = np.sort(np.sqrt(((points - here) ** 2).sum(axis=1)))[1:6]
        found = np.sort([math.dist(here, nb) for nb in row.neighbours])
        assert found == pytest.approx(want)


def test_smote_balances_and_stays_between_points(spark, data):
    out = resample.smote(data, X, "y").cache()
    sizes = {r.y: r.n for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 500, 1: 500}
    minority = np.array([[r.x1, r.x2, r.x3] for r in data.filter("y = 1").collect()])
    by_id = {r.incident_id: np.array([r.x1, r.x2, r.x3]) for r in data.filter("y = 1").collect()}
    for r in out.filter("is_synthetic").limit(60).collect():
        base, made = by_id[r.incident_id], np.array([r.x1, r.x2, r.x3])
        near = minority[np.argsort(((minority - base) ** 2).sum(axis=1))[1:6]]
        gaps = [
            np.linalg.norm(made - base) + np.linalg.norm(made - nb) - np.linalg.norm(nb - base)
            for nb in near
        ]
        assert min(gaps) < 1e-9  # on the line to one of its five nearest
    again = resample.smote(data, X, "y")
    assert out.exceptAll(again).count() == 0
    out.unpersist()


def test_smote_of_balanced_classes_adds_nothing(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 1)], "incident_id bigint, x1 double, y int")
    assert resample.smote(df, ["x1"], "y").filter("is_synthetic").count() == 0


def test_smote_with_a_single_minority_row(spark):
    df = spark.createDataFrame(
        [(i, float(i), 0) for i in range(5)] + [(9, 4.0, 1)], "incident_id bigint, x1 double, y int"
    )
    made = resample.smote(df, ["x1"], "y").filter("is_synthetic").collect()
    assert [r.x1 for r in made] == [4.0] * 4


def test_undersample(data):
    sizes = {r.y: r["count"] for r in resample.undersample(data, "y").groupBy("y").count().collect()}
    assert sizes[1] == 100 and 60 <= sizes[0] <= 140


def test_unknown_model_type(data):
    with pytest.raises(ValueError):
        train.train(data, X, "y", "perceptron")
    with pytest.raises(ValueError):
        train.random_search(data, X, "y", "extra_trees")


def test_train_save_load_score(spark, data):
    model = train.train(data, X, "y", "random_forest", overrides={"numTrees": 5, "maxDepth": 4})
    plain = train.scored(model, train.vectors(data, X), "y")
    assert evaluate.metrics(plain).first().accuracy > 0.8
    path = score.save(score.scoring_chain(model, X), files.scratch_path(spark, "model"))
    rows = files.write_table(data.select("incident_id", *X), files.scratch_path(spark, "rows"), "json")
    again = score.score_files(
        spark, path, rows, "json", "incident_id bigint, x1 double, x2 double, x3 double", X
    )
    a = {r.incident_id: r.prediction for r in again.collect()}
    assert a == {r.incident_id: r.prediction for r in plain.collect()}
    assert again.filter("abs(probability_0 + probability_1 - 1) > 1e-9").count() == 0


def test_importances(spark, data):
    model = train.train(data, X, "y", "random_forest", overrides={"numTrees": 5, "maxDepth": 4})
    table = train.importance_table(model, data, X)
    assert train.top_features(table, 1).first().feature == "x1"
    grouped = train.importance_by_group(table, {"first": ["x1"], "rest": ["x2", "x3"]})
    assert sum(r.importance for r in grouped.collect()) == pytest.approx(1.0)
    permuted = {r.feature: r.importance for r in importance.permutation_importance(model, data, X, "y").collect()}
    assert set(permuted) == set(X) and max(permuted, key=permuted.get) == "x1"
    few = importance.permutation_importance(model, data, X, "y", sample_rows=100)
    assert few.count() == 3


def test_reconstruction_flags_about_a_fifth_of_normal_rows(data):
    model = anomaly.fit_reconstruction(data, X, "y")
    flagged = anomaly.flag_errors(model.transform(data), "recon_error", "y")
    share = flagged.filter("y = 0").agg(F.avg("is_anomaly")).first()[0]
    assert share == pytest.approx(0.2, abs=0.01)


def test_scaling_fills_with_the_mean(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, None)], "incident_id bigint, x1 double")
    got = {r.incident_id: r.x1 for r in prep.min_max_scaled(df, ["x1"]).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 0.5}


def test_runs_are_listed_newest_first(spark):
    base = files.scratch_path(spark, "runs")
    df = spark.range(3)
    for run in ("run_1", "run_2"):
        files.write_run(df, base, "models", run)
    assert [r.run_id for r in files.list_runs(spark, base, "models").collect()] == ["run_2", "run_1"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip_keeps_awkward_text(spark, fmt):
    df = spark.createDataFrame(
        [(1, 'a "quoted", text'), (2, None), (3, "back\\slash")], "id bigint, s string"
    )
    path = files.write_table(df, files.scratch_path(spark, "t"), fmt)
    back = files.read_table(spark, path, fmt, "id bigint, s string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        files.read_table(spark, "/tmp/none", "xml")


def test_grid_search_query_has_the_published_points(spark, data, monkeypatch):
    from workload import learn_queries

    seen = []
    monkeypatch.setattr(learn_queries, "INPUT", X)
    monkeypatch.setattr(learn_queries, "LABEL", "y")
    monkeypatch.setattr(learn_queries, "halves", lambda *_: (data, data))
    monkeypatch.setattr(train, "_search", lambda df, learner, grid, *_: seen.extend(grid))
    monkeypatch.setattr(train, "search_results", lambda *_: None)
    learn_queries.ml9(spark, "")
    points = [{p.name: v for p, v in point.items()} for point in seen]
    assert len(points) == 24
    assert all({p[name] for p in points} == set(values) for name, values in train.SEARCH_GRIDS["random_forest"].items())
