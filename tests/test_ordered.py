"""Quantiles, rank cuts, splits and statistics against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.functions import numeric
from beatgrid.operators import ordered, profile, splits, stats

random.seed(5)


def test_quantiles_match_numpy(spark):
    rows = [(g, random.choice([1.0, 2.5, 7.0, random.random() * 100])) for g in "aab" for _ in range(301)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {
        r.g: (r.q25, r.q50, r.q90)
        for r in ordered.quantiles(df, "v", {"q25": 0.25, "q50": 0.5, "q90": 0.9}, ["g"]).collect()
    }
    for g in "ab":
        values = [v for k, v in rows if k == g]
        assert got[g] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.9])))


def test_quantile_with_one_value_holding_most_rows(spark):
    values = [3.0] * 900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = ordered.quantiles(df, "v", {"q05": 0.05, "q95": 0.95, "q99": 0.99}).first()
    assert tuple(row) == pytest.approx(tuple(np.quantile(values, [0.05, 0.95, 0.99])))


def test_quantile_ignores_null_and_weights(spark):
    df = spark.createDataFrame([(1.0, 3), (10.0, 1), (None, 5)], "v double, w bigint")
    row = ordered.quantiles(df, "v", {"q75": 0.75}, weight="w").first()
    assert row.q75 == pytest.approx(np.quantile([1, 1, 1, 10], 0.75))


@pytest.mark.parametrize("ids", [list(range(500)), [i * i * 10**7 for i in range(500)], [7]])
def test_rank_cut(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    for rank in {1, len(ids) // 2 or 1, len(ids)}:
        target = spark.createDataFrame([(rank,)], "rank bigint")
        assert ordered.rank_cut(rows, "id", target).first().cut_id == sorted(ids)[rank - 1]


def test_rank_cut_over_the_whole_id_range(spark):
    ids = [0, 1, 2**40, 2**61, 2**62 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    target = spark.createDataFrame([(4,)], "rank bigint")
    assert ordered.rank_cut(rows, "id", target).first().cut_id == 2**61


def test_rank_cut_next_to_a_range_border(spark):
    ids = [0, 3 * 2**48 - 1, 3 * 2**48, 3 * 2**48 + 1, 2**62]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    for rank in range(1, 6):
        target = spark.createDataFrame([(rank,)], "rank bigint")
        assert ordered.rank_cut(rows, "id", target).first().cut_id == ids[rank - 1]


def test_quantile_leaves_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "v double")
    assert ordered.quantiles(df, "v", {"q50": 0.5}).first().q50 == 2.0


def split_rows(spark):
    base = dt.datetime(2020, 1, 1)
    hours = [0, 1, 2, 3, 4, 5, 9, 9, 9, 9]  # four rows share the hour of the cut
    return spark.createDataFrame(
        [(i, "a", base + dt.timedelta(hours=h)) for i, h in enumerate(hours)],
        "incident_id bigint, area string, hour_ts timestamp_ntz",
    )


def test_time_split_is_exact_inside_the_boundary_hour(spark):
    got = {r.incident_id: r.split for r in splits.split_by_time(split_rows(spark)).collect()}
    assert [i for i, s in sorted(got.items()) if s == "test"] == [8, 9]


@pytest.mark.parametrize("ratio", [0.0, 0.05, 0.55, 1.0])
def test_time_split_sizes(spark, ratio):
    got = [r.split for r in splits.split_by_time(split_rows(spark), ratio=ratio).collect()]
    assert got.count("train") == math.floor(10 * ratio)


def test_group_split_equals_sorting_each_group(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [
        (i, random.choice("abbbbc"), base + dt.timedelta(hours=random.choice([0, 1, 1, 1, 2])))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "incident_id bigint, area string, hour_ts timestamp_ntz")
    got = {r.incident_id: r.split for r in splits.split_by_group(df).collect()}
    for area in "abc":
        members = sorted((t, i) for i, a, t in rows if a == area)
        k = math.floor(len(members) * 0.8)
        assert [got[i] for _, i in members] == ["train"] * k + ["test"] * (len(members) - k)


def test_group_split_keeps_tiny_groups(spark):
    df = split_rows(spark).limit(1)
    assert [r.split for r in splits.split_by_group(df).collect()] == ["test"]


def test_stratified_split_keeps_shares(spark):
    df = spark.range(1000).select(F.col("id").alias("incident_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    rows = splits.split_stratified(df, "y").groupBy("y", "split").count().collect()
    assert {(r.y, r.split): r["count"] for r in rows} == {
        (0, "train"): 720, (0, "test"): 180, (1, "train"): 80, (1, "test"): 20,
    }


def brute_u(a, b):
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n1, n2 = len(a), len(b)
    n = n1 + n2
    pooled = a + b
    tie = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    sigma = math.sqrt(n1 * n2 / 12 * (n + 1 - tie / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma
    return u, min(1.0, math.erfc(z / math.sqrt(2)))


def test_mann_whitney(spark):
    a = [random.randint(0, 20) for _ in range(60)]
    b = [random.randint(5, 25) for _ in range(45)]
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b], "v int, a boolean")
    row = stats.mann_whitney(df, "v", F.col("a")).first()
    u, p = brute_u(a, b)
    assert row.u_stat == u and row.p_value == pytest.approx(p, rel=1e-9)


def test_mann_whitney_equal_samples(spark):
    df = spark.createDataFrame([(1, True), (2, True), (1, False), (2, False)], "v int, a boolean")
    row = stats.mann_whitney(df, "v", F.col("a")).first()
    assert row.p_value == 1.0 and not row.significant


def test_normal_tail_matches_erfc(spark):
    zs = [0.0, 0.1, 1.0, 1.96, 3.3, 6.9, 7.2, 12.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r.p for r in df.select(numeric.normal_upper_tail(F.col("z")).alias("p")).collect()]
    assert got == pytest.approx([math.erfc(z / math.sqrt(2)) / 2 for z in zs], rel=1e-7)


def test_chi2_tail(spark):
    # reference points of the chi-square table
    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.344866730144373, 3, 0.01),
             (18.307038053275146, 10, 0.05), (24.99579013972863, 15, 0.05), (0.0, 4, 1.0)]
    df = spark.createDataFrame([(x, k) for x, k, _ in cases], "x double, k bigint")
    got = [r.p for r in df.select(numeric.chi2_upper_tail(F.col("x"), F.col("k")).alias("p")).collect()]
    assert got == pytest.approx([p for _, _, p in cases], rel=1e-6)


def test_chi_square_with_an_empty_cell(spark):
    table = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "z"): 5, ("a", "z"): 7}
    df = spark.createDataFrame([k for k, n in table.items() for _ in range(n)], "r string, c string")
    n = sum(table.values())
    rt = {r: sum(v for (i, _), v in table.items() if i == r) for r in "ab"}
    ct = {c: sum(v for (_, j), v in table.items() if j == c) for c in "xyz"}
    chi2 = sum((table.get((r, c), 0) - rt[r] * ct[c] / n) ** 2 / (rt[r] * ct[c] / n) for r in rt for c in ct)
    row = stats.chi_square(df, "r", "c").first()
    assert row.chi2 == pytest.approx(chi2) and row.dof == 2
    assert row.p_value == pytest.approx(math.exp(-chi2 / 2))


def test_greedy_pairing_uses_nothing_twice(spark):
    rows = [("a", "x")] * 9 + [("a", "y")] * 8 + [("b", "x")] * 7 + [("b", "y")] * 2 + [("c", "y")] * 3
    df = spark.createDataFrame(rows, "area string, category string")
    got = {(r.area, r.category, r.n) for r in profile.top_area_per_category(df).collect()}
    assert got == {("a", "x", 9), ("c", "y", 3)}


def test_rolling_needs_all_days(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    rows = [(d, "x") for d in days] + [(days[0], "y"), (days[2], "y"), (days[3], "y")]
    df = spark.createDataFrame(rows, "date date, category string")
    got = profile.rolling_by_category(df, rows=2).filter("category = 'y'").orderBy("date").collect()
    assert [r.rolling_mean for r in got] == [None, None, 1.0]  # days 0, 2 and 3


def test_histogram_top_edge_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "v double")
    got = {r.bin: r.n for r in profile.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 4: 2}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r.bin, r.n) for r in profile.histogram(flat, "v", 5).collect()] == [(0, 2)]
