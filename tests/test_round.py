"""Splits, cross-tabs, staging, pairing, crowded hours and stored ensembles."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from beatgrid.learn import score, train
from beatgrid.operators import grains, profile, splits
from beatgrid.operators.joins import join_unique
from beatgrid.operators.trail import incident_trail
from beatgrid.sources import files

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def hours(spark, rows):
    df = spark.createDataFrame(rows, "incident_id long, hour string, area int")
    return df.select("incident_id", F.col("hour").cast("timestamp_ntz").alias("hour_ts"), "area")


def sizes(df, *by):
    return {tuple(r)[:-1] if by else r["split"]: r["count"] for r in df.groupBy(*by, "split").count().collect()}


def test_undated_rows_are_the_last_ones(spark):
    rows = [(i, f"2024-01-01 {i:02d}:00:00", 1) for i in range(7)] + [(i, None, 1) for i in range(7, 10)]
    got = splits.split_by_time(hours(spark, rows))
    assert sizes(got) == {"train": 8, "test": 2}
    assert [r.incident_id for r in got.filter("split = 'test'").orderBy("incident_id").collect()] == [8, 9]
    by_area = splits.split_by_group(hours(spark, rows + [(20 + i, None, 2) for i in range(5)]))
    assert sizes(by_area, "area") == {(1, "train"): 8, (1, "test"): 2, (2, "train"): 4, (2, "test"): 1}


def test_repeated_ids_at_the_cut_are_an_error(spark):
    df = hours(spark, [(1, "2024-01-01 00:00:00", 1)] * 10)
    for split in (splits.split_by_time, splits.split_by_group):
        with pytest.raises(ValueError, match="repeats"):
            split(df).collect()


def test_split_in_another_time_zone_of_the_driver():
    code = """
import sys; sys.path.insert(0, %r)
from tests.conftest import make_session
from tests.test_round import hours, sizes
from beatgrid.operators import splits
spark = make_session()
df = hours(spark, [(i, f"2024-01-01 {i:02d}:00:00", 1) for i in range(10)])
assert sizes(splits.split_by_time(df)) == {"train": 8, "test": 2}, sizes(splits.split_by_time(df))
""" % ROOT
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_cross_tab_has_a_column_for_each_value(spark):
    df = spark.createDataFrame([("a", "F"), ("a", "Q"), ("b", "O"), ("b", None)], "row string, code string")
    got = profile.pivot_counts(df, "row", "code", "c_", fill=0).orderBy("row")
    assert got.columns == ["row", "c_F", "c_O", "c_Q"]
    assert [tuple(r) for r in got.collect()] == [("a", 1, 0, 1), ("b", 0, 1, 0)]
    with pytest.raises(Exception, match="unlisted value of code: Q"):
        profile.pivot_counts(df, "row", "code", "c_", ["F", "O"]).collect()


def test_a_missing_staged_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_table(spark, str(tmp_path / "nothing"))


def test_greedy_pairing_like_a_walk(spark):
    import random

    rng = random.Random(0)
    rows = [(rng.randrange(12), f"c{rng.randrange(9)}") for _ in range(800)]
    counts = {}
    for r in rows:
        counts[r] = counts.get(r, 0) + 1
    areas, categories, want = set(), set(), []
    for (a, c), n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if a not in areas and c not in categories:
            areas.add(a), categories.add(c), want.append((a, c, n))
    got = profile.top_area_per_category(spark.createDataFrame(rows, "area int, category string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert profile.top_area_per_category(got.limit(0)).count() == 0


def test_join_unique_with_a_hot_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n")).filter("k % 2 = 1")
    got = join_unique(left, right, ["k"], "n")
    assert sorted(map(str, got.select("k", "id", "n").collect())) == sorted(map(str, left.join(right, "k", "left").select("k", "id", "n").collect()))


def test_days_count_rows_without_an_hour(spark):
    df = spark.createDataFrame([(1, "2024-01-05", 3), (1, "2024-01-05", 3), (1, "2024-01-05", None)], "area int, date string, hour int")
    df = df.withColumn("date", F.col("date").cast("date"))
    df = df.withColumn("hour_ts", F.expr("make_timestamp_ntz(year(date), month(date), day(date), hour, 0, 0)"))
    people = spark.createDataFrame([(1, 1000)], "area int, population long")
    cube = grains.hour_cube(df, people).first()
    assert (cube.n_hour, cube.n_day, cube.n_month, cube.n_year) == (2, 3, 3, 3)
    for grain in ("daily", "monthly", "yearly"):
        assert grains.rates(df, people, grain).first().n == 3
    assert grains.rates(df, people, "hourly").first().n == 2


def test_crowded_hours_agree_with_and_without_broadcast(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("incident_id"), (F.col("id") % 2).cast("int").alias("area"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(least(id div 100, 20) as int), 0, 0)").alias("hour_ts"),
    ).withColumn("date", F.to_date("hour_ts")).withColumn("hour", F.hour("hour_ts"))
    people = spark.createDataFrame([(0, 1000), (1, 2000)], "area int, population long")
    columns = ["incident_id", "hourly_rate", "rolling_mean", "is_hourly_hot", "rate_last_6_sum", "was_hourly_hot_last_row"]
    one = sorted(map(str, incident_trail(rows, people).select(columns).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        two = sorted(map(str, incident_trail(rows, people).select(columns).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert one == two and len(one) == 4000
    assert incident_trail(rows, people).filter("rolling_mean is null").count() < 100


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(600).select(
        F.col("id").alias("incident_id"), (F.xxhash64("id") % 1000 / 1000).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000 / 1000).alias("b")
    )
    return files.materialised(df.withColumn("y", (F.col("a") + F.col("b") > 0.6).cast("int")), "table")


SMALL = {
    "random_forest": {"numTrees": 5, "maxDepth": 4}, "xgboost": {"maxIter": 4, "maxDepth": 3}, "catboost": {"maxIter": 4, "maxDepth": 3},
    "catboost_weighted": {"maxIter": 4, "maxDepth": 3}, "extra_trees": {"numTrees": 5, "maxDepth": 4}, "balanced_random_forest": {"numTrees": 5, "maxDepth": 4},
}


def check_stored(spark, model, table, path):
    chain = score.scoring_chain(model, ["a", "b"])
    rows = table.select("incident_id", "a", "b")
    want = sorted(map(tuple, score.score(chain, rows, ["a", "b"]).collect()))
    again = score.load(score.save(chain, path), spark)
    assert sorted(map(tuple, score.score(again, rows, ["a", "b"]).collect())) == want
    assert all(abs(r[-1] + r[-2] - 1) < 1e-9 for r in want)
    right = table.join(spark.createDataFrame([(r[0], r[-3]) for r in want], "incident_id long, p int"), "incident_id")
    assert right.filter("p = y").count() > 450


@pytest.mark.parametrize("family", train.available())
def test_every_family_learns_and_is_stored(spark, table, tmp_path, family):
    check_stored(spark, train.train(table, ["a", "b"], "y", family, overrides=SMALL[family]), table, str(tmp_path / "m"))


def test_ensembles_are_stored(spark, table, tmp_path):
    families = {k: SMALL[k] for k in ("random_forest", "xgboost")}
    check_stored(spark, train.stack(table, ["a", "b"], "y", families, folds=2), table, str(tmp_path / "stacked"))
    members = {k: train.train(table, ["a", "b"], "y", k, overrides=v) for k, v in families.items()}
    check_stored(spark, train.VotingModel(members, {"random_forest": 2.0, "xgboost": 1.0}), table, str(tmp_path / "voting"))


def test_searches_try_every_candidate(spark, table):
    found = train.random_search(table, ["a", "b"], "y", "random_forest", draws=3, folds=2, ranges={"numTrees": [2, 3], "maxDepth": [2, 3]})
    rows = train.search_results(found, table).collect()
    assert len(rows) == 3 == len({r.params for r in rows}) and all(0 <= r.score <= 1 for r in rows)
    found = train.grid_search(table, ["a", "b"], "y", "random_forest", folds=2, grid={"numTrees": [2], "impurity": ["gini", "entropy"]})
    assert {r.params for r in train.search_results(found, table).collect()} == {"impurity=gini, numTrees=2", "impurity=entropy, numTrees=2"}


def test_leading_trends_of_few_categories(spark):
    rows = [(c, float(v)) for c, v in zip("abcde", (5, 1, 5, 0, 3))] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "category string, rolling_mean double")
    got = sorted((r.from_top, r.from_bottom, r.category, r.is_top, r.is_bottom) for r in profile.leading_trends(df, "category", 2, 3).collect())
    assert got == [(1, 6, "a", 1, 0), (2, 5, "c", 1, 0), (4, 3, None, 0, 1), (5, 2, "b", 0, 1), (6, 1, "d", 0, 1)]
    every = profile.leading_trends(df, "category", 6, 6).collect()
    assert sorted((r.from_top, r.from_bottom) for r in every) == [(i, 7 - i) for i in range(1, 7)]
    assert profile.leading_trends(df.limit(0), "category").count() == 0
