"""Calendar expressions."""

import datetime as dt

from pyspark.sql import functions as F

from beatgrid.functions import calendar as cal
from beatgrid.functions import encode


def days(spark, *dates):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in dates], "d date")


def holidays(spark, *dates):
    got = days(spark, *dates).select("d", cal.is_us_holiday(F.col("d")).alias("h")).collect()
    return {str(r.d): r.h for r in got}


def test_observed_days(spark):
    got = holidays(
        spark, "2021-07-04", "2021-07-05", "2020-07-03", "2020-07-06", "2021-12-31", "2022-01-01",
        "2022-12-26", "2023-01-02", "2021-12-24",
    )
    assert got["2021-07-04"] and got["2021-07-05"]  # Sunday, observed on Monday
    assert got["2020-07-03"] and not got["2020-07-06"]  # Saturday, observed on Friday
    assert got["2021-12-31"] and got["2022-01-01"]  # across the year end
    assert got["2022-12-26"] and got["2023-01-02"] and got["2021-12-24"]


def test_weekday_rules_and_juneteenth(spark):
    got = holidays(
        spark, "2023-01-16", "2023-02-20", "2023-05-29", "2023-09-04", "2023-10-09", "2023-11-23",
        "2020-06-19", "2021-06-18", "2021-06-19", "2022-06-20", "2023-11-10", "2023-11-24",
    )
    assert [d for d, h in got.items() if not h] == ["2020-06-19", "2023-11-24"]


def test_two_weekends_and_monday_is_zero(spark):
    # Thursday to Monday
    df = days(spark, "2021-07-01", "2021-07-02", "2021-07-03", "2021-07-04", "2021-07-05")
    flags = cal.week_flags(F.col("d"))
    rows = df.select(
        F.weekday("d").alias("w"), *[c.alias(n) for n, c in flags.items()]
    ).collect()
    assert [r.w for r in rows] == [3, 4, 5, 6, 0]
    assert [r.weekend for r in rows] == ["Weekday", "Weekend", "Weekend", "Weekend", "Weekday"]
    assert [r.is_weekend for r in rows] == [0, 0, 1, 1, 0]
    assert [r.is_weekend_or_holiday for r in rows] == [False, False, True, True, True]


def test_year_back_and_hhmm(spark):
    got = days(spark, "2020-02-29", "2021-02-28", "2020-02-28").select(
        cal.same_day_last_year(F.col("d")).alias("p")
    )
    assert [str(r.p) for r in got.collect()] == ["2019-02-28", "2020-02-28", "2019-02-28"]
    times = spark.createDataFrame([(0,), (45,), (130,), (2359,)], "t int")
    assert [r.h for r in times.select(cal.hour_of_hhmm(F.col("t")).alias("h")).collect()] == [0, 0, 1, 23]


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(50.0,), (50.1,), (70.0,), (85.0,), (85.5,), (None,)], "t double")
    got = [r.b for r in df.select(encode.temperature_band(F.col("t")).alias("b")).collect()]
    assert got == ["Cold", "Mild", "Mild", "Warm", "Hot", None]


def test_descent_and_severity(spark):
    df = spark.createDataFrame([("W", 1), ("K", 2), ("O", 3), (None, None)], "c string, s int")
    got = df.select(encode.descent_group(F.col("c")).alias("c"), encode.severity(F.col("s")).alias("s"))
    assert [tuple(r) for r in got.collect()] == [
        ("White", "Serious"), ("Asian", "Less Serious"), ("Other", None), ("Other", None),
    ]
