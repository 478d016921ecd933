"""Cleaning steps and their order."""

import datetime as dt

from beatgrid import dimensions
from beatgrid.config import CleaningParams, WeatherParams
from beatgrid.operators import clean, enrich
from beatgrid.plans import cleaning
from beatgrid.plans.features import engineer, model_table
from beatgrid.sources import incidents as src


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "m string")
    assert sorted(r.m for r in clean.fill_mode(df, "m").collect()) == ["a", "a", "a", "b", "b"]


def test_mode_of_an_empty_column_changes_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "m string")
    assert [r.m for r in clean.fill_mode(df, "m").collect()] == [None, None]


def test_age_repair(spark):
    df = spark.createDataFrame([(-5,), (0,), (30,), (120,)], "`Vict Age` int")
    got = sorted(r[0] for r in clean.repair_age(df, "Vict Age").collect())
    assert got == [0.0, 30.0, 75.0, 100.0]  # the mean of 30 and 120 replaces -5


def test_age_default_without_positive_values(spark):
    df = spark.createDataFrame([(-5,), (0,), (None,)], "`Vict Age` int")
    assert sorted((r[0] for r in clean.repair_age(df, "Vict Age").collect()), key=str) == [0.0, 30.0, None]


RAW = [
    # id, date, sex, premis, status, area, age
    (1, "01/08/2020 12:00:00 AM", None, 1.0, "ic", "Central", 20),
    (2, "2021-05-06", "-", 1.0, "ic", "Central", 20),
    (3, "2022-02-03 10:00:00", "H", 1.0, "ic", "Central", -1),
    (4, "2022-02-04", "M", None, "ic", "Central", 20),
    (5, "2022-02-05", "F", 1.0, None, "Central", 20),
    (6, "bad", "F", 1.0, "ic", "Central", 20),
    (7, None, "F", 1.0, "ic", "Central", 20),
    (8, "2024-01-01", "F", 1.0, "ic", "Central", 60),
]


def raw(spark):
    df = spark.createDataFrame(
        RAW,
        "`DR_NO` bigint, `DATE OCC` string, `Vict Sex` string, `Premis Cd` double, `Status` string, "
        "`AREA NAME` string, `Vict Age` int",
    )
    return df.selectExpr(
        "*", "`DATE OCC` as `Date Rptd`", "130 as `TIME OCC`", "1 as `Part 1-2`",
        "'burglary' as `Crm Cd Desc`", "'ic' as `Status Desc`", "cast(null as string) as Mocodes",
        "cast(null as string) as `Vict Descent`", "cast(null as string) as `Premis Desc`",
        "cast(null as double) as `Weapon Used Cd`", "cast(null as string) as `Weapon Desc`",
        "1.0D as `Crm Cd 4`", "'x' as `Cross Street`",
    )


def test_clean_reports_order(spark):
    got = {r.DR_NO: r for r in cleaning.clean_reports(raw(spark)).collect()}
    assert set(got) == {1, 3}  # -, null codes, bad and null dates and 2024 are gone
    assert got[1]["Vict Sex"] == "X" and got[3]["Vict Sex"] == "X"
    # the mean is taken before the year filter: rows 1, 6, 7, 8 are positive
    assert got[3]["Vict Age"] == 30.0
    assert got[1]["AREA NAME"] == "CENTRAL" and got[1]["Status"] == "IC"
    assert got[1]["Weapon Used Cd"] == "Weapon Usage Not Known"
    assert got[1]["DATE OCC"] == dt.datetime(2020, 1, 8)
    assert "Cross Street" not in got[1].asDict()


def test_raw_reports_to_model_table(spark):
    cleaned = cleaning.clean_reports(raw(spark))
    tidy = src.tidy(cleaned, dimensions.offence_groups(spark))
    row = tidy.filter("incident_id = 1").first()
    assert row.category == "PROPERTY CRIMES" and row.severity == "Serious" and row.hour == 1
    table = model_table(engineer(tidy, dimensions.population(spark)), drop=())
    rates = {r["Year"]: r["Yearly_Crime_Rate_per_1000"] for r in table.collect()}
    assert rates == {2020: 1 / 180700 * 1000, 2022: 1 / 182150 * 1000}


def test_missing_columns_fail_early(spark):
    try:
        src.tidy(spark.createDataFrame([(1,)], "`DR_NO` bigint"))
    except ValueError as e:
        assert "DATE OCC" in str(e)
    else:
        raise AssertionError


def test_dimension_sizes(spark):
    assert dimensions.population(spark).count() == 84
    assert dimensions.offence_groups(spark).count() == 139


def weather_case(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "incident_id bigint")
    weather = spark.createDataFrame(
        [(1, "9", "1"), (1, "5", "2"), (1, "5", "2"), (2, "x", "7")],
        "incident_id bigint, temp string, wspeed string",
    )
    return rows, clean.coerce_numbers(weather, ["temp", "wspeed"])


def test_weather_first_reading_and_median(spark):
    rows, weather = weather_case(spark)
    got = {r.incident_id: (r.temp, r.wspeed) for r in enrich.add_weather(rows, weather).collect()}
    # both readings of id 1 count for the median: temp 5, 9 -> 7; wspeed 1, 2, 7 -> 2
    assert got == {1: (5.0, 2.0), 2: (7.0, 7.0), 3: (7.0, 2.0)}


def test_weather_zero_fill(spark):
    rows, weather = weather_case(spark)
    out = enrich.add_weather(rows, weather, WeatherParams(fill=0.0), unique_ids=True)
    assert {r.incident_id: r.temp for r in out.collect()} == {1: 5.0, 2: 0.0, 3: 0.0}


def test_weather_without_any_reading_stays_null(spark):
    rows, weather = weather_case(spark)
    out = enrich.add_weather(rows, weather.filter("false"))
    assert [r.temp for r in out.collect()] == [None, None, None]


def test_clean_weather(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", "50.5", "n/a"), (1, "2020-01-01", "50.5", "n/a")],
        "`DR_NO` bigint, `DATE OCC` string, `Temp` string, `Wspeed` string",
    )
    rows = cleaning.clean_weather(df).collect()
    assert len(rows) == 1 and rows[0].Temp == 50.5 and rows[0].Wspeed is None


def test_keep_first_puts_null_last(spark):
    df = spark.createDataFrame([(1, None), (1, 4), (1, 3), (2, None)], "k int, v int")
    assert {r.k: r.v for r in clean.keep_first(df, ["k"], ["v"]).collect()} == {1: 3, 2: None}


def test_until_year_parameter():
    assert CleaningParams().max_year == 2023
