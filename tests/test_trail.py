"""Rolling and lag features on hand-made incident sequences."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from beatgrid.config import HotspotParams
from beatgrid.operators import grains
from beatgrid.operators.trail import incident_trail, leading_ids
from beatgrid.plans import features
from beatgrid.sources import files

BASE = dt.datetime(2021, 3, 1)
SCHEMA = "incident_id bigint, area string, hour_ts timestamp_ntz"


def incidents(spark, rows):
    """rows: (area, hour offset, how many)"""
    out, n = [], 0
    for area, hour, size in rows:
        for _ in range(size):
            out.append((n, area, BASE + dt.timedelta(hours=hour)))
            n += 1
    return spark.createDataFrame(out, SCHEMA)


def population(spark, areas, n=1000):
    return spark.createDataFrame([(a, n) for a in areas], "area string, population bigint")


def plain_trail(df, pop, p):
    """The same features with windows over all incident rows of an area."""
    rate = df.groupBy("area", "hour_ts").agg(F.count("*").alias("n"))
    rows = df.join(rate, ["area", "hour_ts"]).join(pop, "area", "left")
    rows = rows.withColumn("hourly_rate", F.col("n") / F.col("population") * 1000)
    o = Window.partitionBy("area").orderBy("hour_ts", "incident_id")
    w = o.rowsBetween(-(p.window_rows - 1), 0)
    r = F.col("hourly_rate")
    enough = F.count(r).over(w) >= p.min_rows
    rows = rows.withColumns(
        {
            "rolling_mean": F.when(enough, F.avg(r).over(w)),
            "rolling_std": F.when(enough, F.stddev_samp(r).over(w)),
            "rate_last_row": F.lag(r).over(o),
            "rate_last_3_avg": F.avg(r).over(o.rowsBetween(-3, -1)),
            "rate_last_6_sum": F.sum(r).over(o.rowsBetween(-6, -1)),
        }
    )
    z = F.when(F.col("rolling_std") > 0, (r - F.col("rolling_mean")) / F.col("rolling_std"))
    rows = rows.withColumn("z_score", z).withColumn(
        "is_hourly_hot",
        F.coalesce((F.round("z_score", 9) > p.z_threshold).cast("int"), F.lit(0)),
    )
    return rows.withColumn("was_hourly_hot_last_row", F.lag("is_hourly_hot").over(o))


COLUMNS = [
    "hourly_rate",
    "rolling_mean",
    "rolling_std",
    "z_score",
    "is_hourly_hot",
    "rate_last_row",
    "rate_last_3_avg",
    "rate_last_6_sum",
    "was_hourly_hot_last_row",
]


@pytest.mark.parametrize("window, least", [(24, 12), (5, 2), (3, 1)])
def test_skeleton_equals_plain_windows(spark, window, least):
    sizes = [1, 2, 30, 1, 1, 24, 25, 3, 1, 60, 2, 1, 23, 26, 7, 8, 6, 1, 1, 40]
    rows = [("a", h * 2, n) for h, n in enumerate(sizes)] + [("b", h, 1 + h % 3) for h in range(20)]
    df, pop = incidents(spark, rows), population(spark, ["a", "b"])
    p = HotspotParams(window_rows=window, min_rows=least)
    got = {r.incident_id: r for r in incident_trail(df, pop, p).collect()}
    want = plain_trail(df, pop, p).collect()
    assert len(got) == len(want)
    for w in want:
        for c in COLUMNS:
            a, b = got[w.incident_id][c], w[c]
            assert (a is None) == (b is None), (w.incident_id, c, a, b)
            assert a is None or a == pytest.approx(b, abs=1e-9), (w.incident_id, c)


def test_tied_rows_and_first_row_of_second_area(spark):
    df = incidents(spark, [("a", 0, 10), ("a", 1, 20), ("b", 0, 30)])
    got = incident_trail(df, population(spark, ["a", "b"])).orderBy("incident_id").collect()
    assert got[0].rate_last_row is None and got[0].rate_last_3_avg is None
    assert got[30].area == "b" and got[30].rate_last_3_avg is None  # nothing leaks from area a
    assert got[10].rate_last_row == 10 and got[11].rate_last_row == 20  # previous row, same hour
    assert got[10].rolling_mean is None  # 11 rows are fewer than 12
    expected = [10.0] * 10 + [20.0] * 2
    assert got[11].rolling_mean == pytest.approx(statistics.mean(expected))
    assert got[11].rolling_std == pytest.approx(statistics.stdev(expected))


def test_constant_rate_is_never_hot(spark):
    df = incidents(spark, [("a", h, 1) for h in range(24)])
    got = incident_trail(df, population(spark, ["a"])).collect()
    assert all(r.is_hourly_hot == 0 and r.z_score is None for r in got)
    assert sorted(got, key=lambda r: r.incident_id)[-1].rolling_std == 0


def test_area_without_population_has_no_rate(spark):
    df = incidents(spark, [("a", h, 1 + h % 2) for h in range(24)])
    got = incident_trail(df, population(spark, ["other"])).collect()
    assert len(got) == 36
    assert all(r.hourly_rate is None and r.is_hourly_hot == 0 for r in got)


def test_incidents_without_area_or_hour_stay(spark):
    df = incidents(spark, [("a", 0, 2)]).unionByName(
        spark.createDataFrame([(90, None, BASE), (91, "a", None)], SCHEMA)
    )
    got = {r.incident_id: r for r in incident_trail(df, population(spark, ["a"])).collect()}
    assert set(got) == {0, 1, 90, 91}
    assert got[90].hourly_rate is None and got[91].is_hourly_hot == 0


def test_quantile_weights_areas_by_incidents_and_is_strict(spark):
    # one day: a has 15 incidents, b 4, c 1; over rows the 75 % quantile is a's own rate
    df = incidents(spark, [("a", 0, 15), ("b", 1, 4), ("c", 2, 1)])
    cube = grains.hour_cube(df, population(spark, ["a", "b", "c"]))
    hot = grains.hot_cells(grains.period_cells(cube, "daily"), ["date"], 0.75)
    flags = {r.area: (r.cut, r.is_hot) for r in hot.collect()}
    assert flags == {"a": (15.0, 0), "b": (15.0, 0), "c": (15.0, 0)}


def test_history_across_leap_day(spark):
    days = [dt.date(2019, 2, 28), dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2021, 2, 28)]
    flags = [1, 0, 1, 1]
    df = spark.createDataFrame(
        [("a", d, f) for d, f in zip(days, flags)], "area string, date date, is_daily_hot int"
    )
    got = {r.date: r for r in features.with_day_history(df).collect()}
    assert got[days[1]].was_hot_last_year == 1
    assert got[days[2]].was_hot_last_year == 1  # 29 Feb looks at 28 Feb
    assert got[days[3]].was_hot_last_year == 0  # 28 Feb 2020, not the 29th
    assert got[days[0]].was_hot_last_year is None
    assert got[days[2]].was_daily_hot_yesterday == 0
    assert got[days[3]].was_daily_hot_yesterday == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_limit_runs_before_the_exchange(spark):
    plan = plan_of(leading_ids(incidents(spark, [("a", 0, 50)]), 25))
    exchange = plan.index("Exchange hashpartitioning")
    # printed from the top: the partial limit stands below the exchange
    assert "row_number(), 24, Partial" in plan[exchange:]


def test_settled_rows_are_not_shuffled(spark):
    """The incident rows only meet small broadcast tables: crowded hours, other hours and leading ids,
    in both branches."""
    df = incidents(spark, [("a", 0, 500), ("a", 1, 400)])
    path = files.write_table(df, files.scratch_path(spark, "rows"))
    plan = plan_of(incident_trail(spark.read.parquet(path), population(spark, ["a"])))
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_model_table_from_cells_equals_row_level(spark):
    rows = [("a", h, 1 + (h * 7) % 30) for h in range(0, 60, 2)] + [("b", h, 1) for h in range(50)]
    base = incidents(spark, rows).select(
        "incident_id", "area", F.to_date("hour_ts").alias("date"), F.hour("hour_ts").alias("hour")
    )
    pop = population(spark, ["a", "b"])
    weather = spark.createDataFrame(
        [("a", dt.date(2021, 3, 1), 60.0, 3.0), ("b", dt.date(2021, 3, 2), 50.0, None)],
        "area string, date date, temp double, wspeed double",
    )
    params = features.WeatherParams(keys=("area", "date"))
    by_rows = features.model_table(
        features.engineer(base, pop, weather, weather_params=params), drop=()
    )
    by_cells = features.model_table_from_cells(base, pop, weather, weather_params=params, drop=())
    assert by_rows.columns == by_cells.columns
    assert sorted(map(str, by_rows.collect())) == sorted(map(str, by_cells.collect()))
