"""The feature plan: time, category, rates, hotspots, lags and weather, then the model table.

All incident-level numbers that depend on other incidents come from the hour cube, one row
per (area, hour). Lookups to other hours, days and years are windows on the cube; the incident
table itself is read for the counts, for the leading ids and for the final join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.config import HotspotParams, WeatherParams
from beatgrid.functions import calendar as cal
from beatgrid.operators import enrich
from beatgrid.operators.grains import hot_cells, hour_cube, period_cells
from beatgrid.operators.trail import trail, with_trail
from beatgrid.sources.files import materialised

# Published column names of the model table, in order.
MODEL_COLUMNS = {
    "Datetime_Key": "hour_ts",
    "Hour_sin": "hour_sin",
    "Hour_cos": "hour_cos",
    "DayOfWeek_sin": "day_of_week_sin",
    "DayOfWeek_cos": "day_of_week_cos",
    "Month_sin": "month_sin",
    "Month_cos": "month_cos",
    "Year": "year",
    "IsHoliday": "is_holiday",
    "IsWeekendorHoliday": "is_weekend_or_holiday",
    "Weekend": "weekend",
    "AREA NAME": "area",
    "Hourly_Crime_Rate_per_1000": "hourly_rate",
    "Daily_Crime_Rate_per_1000": "daily_rate",
    "Monthly_Crime_Rate_per_1000": "monthly_rate",
    "Yearly_Crime_Rate_per_1000": "yearly_rate",
    "crime_rate_last_1h": "rate_last_row",
    "crime_rate_last_3h_avg": "rate_last_3_avg",
    "crime_rate_last_6h_sum": "rate_last_6_sum",
    "crime_rate_yesterday_same_hour": "rate_yesterday_same_hour",
    "was_hourly_hotspot_last_hour": "was_hourly_hot_last_row",
    "was_daily_hotspot_yesterday": "was_daily_hot_yesterday",
    "was_hotspot_last_year_same_day": "was_hot_last_year",
    "Temp": "temp",
    "Wspeed": "wspeed",
    "is_hourly_hotspot": "is_hourly_hot",
}
LABEL = "is_hourly_hotspot"

# Features dropped because they repeat others.
CORRELATED = (
    "Yearly_Crime_Rate_per_1000",
    "crime_rate_last_3h_avg",
    "crime_rate_last_6h_sum",
    "Month_cos",
)

# The numeric columns that reach a model.
MODEL_INPUT = (
    "Hour_sin",
    "Hour_cos",
    "DayOfWeek_sin",
    "DayOfWeek_cos",
    "Month_sin",
    "Year",
    "Daily_Crime_Rate_per_1000",
    "Monthly_Crime_Rate_per_1000",
    "crime_rate_last_1h",
    "crime_rate_yesterday_same_hour",
    "was_hourly_hotspot_last_hour",
    "was_daily_hotspot_yesterday",
    "was_hotspot_last_year_same_day",
    "Temp",
    "Wspeed",
)

# Groups used to sum feature importances.
FEATURE_GROUPS = {
    "temporal": [
        "Hour_sin",
        "Hour_cos",
        "DayOfWeek_sin",
        "DayOfWeek_cos",
        "Month_sin",
        "Month_cos",
        "Year",
    ],
    "holiday": ["IsHoliday", "IsWeekendorHoliday", "Weekend"],
    "crime_rates": [
        "Hourly_Crime_Rate_per_1000",
        "Daily_Crime_Rate_per_1000",
        "Monthly_Crime_Rate_per_1000",
    ],
    "lag_features": [
        "crime_rate_last_1h",
        "crime_rate_last_3h_avg",
        "crime_rate_last_6h_sum",
        "crime_rate_yesterday_same_hour",
    ],
    "hotspot_history": [
        "was_hourly_hotspot_last_hour",
        "was_daily_hotspot_yesterday",
        "was_hotspot_last_year_same_day",
    ],
    "weather": ["Temp", "Wspeed"],
}


def with_day_history(df: DataFrame, flag: str = "is_daily_hot") -> DataFrame:
    """Add the area's daily flag of the day before and of the same day a year ago.

    ``df`` has any number of rows per (area, date) that agree on the flag. Range frames over
    the day number replace two lookups: one year back is 365 or 366 days back.
    """
    days = Window.partitionBy("area").orderBy("day_no")

    def back(n: int):
        return F.max(flag).over(days.rangeBetween(-n, -n))

    year_length = F.datediff("date", cal.same_day_last_year(F.col("date")))
    return (
        df.withColumn("day_no", F.unix_date("date"))
        .withColumns({"_1": back(1), "_365": back(365), "_366": back(366)})
        .withColumns(
            {
                "was_daily_hot_yesterday": F.coalesce("_1", F.lit(0)),
                "was_hot_last_year": F.when(year_length == 365, F.col("_365")).otherwise(
                    F.col("_366")
                ),
            }
        )
        .drop("day_no", "_1", "_365", "_366")
    )


def with_yesterday(cube: DataFrame) -> DataFrame:
    """Add the area's hourly rate of the same hour one day before."""
    hours = Window.partitionBy("area").orderBy("hour_no")
    hour_no = F.unix_date("date").cast("bigint") * 24 + F.hour("hour_ts")
    return (
        cube.withColumn("hour_no", hour_no)
        .withColumn(
            "rate_yesterday_same_hour", F.max("hourly_rate").over(hours.rangeBetween(-24, -24))
        )
        .drop("hour_no")
    )


def day_flags(cube: DataFrame, params: HotspotParams = HotspotParams()) -> DataFrame:
    """(area, date) -> daily hot flag and its history."""
    days = hot_cells(period_cells(cube, "daily"), ["date"], params.quantile)
    return with_day_history(days.select("area", "date", F.col("is_hot").alias("is_daily_hot")))


CELL_COLUMNS = [
    "hourly_rate",
    "daily_rate",
    "monthly_rate",
    "yearly_rate",
    "is_daily_hot",
    "is_monthly_hot",
    "is_yearly_hot",
    "was_daily_hot_yesterday",
    "was_hot_last_year",
    "rate_yesterday_same_hour",
]


def staged_cube(incidents: DataFrame, population: DataFrame) -> DataFrame:
    """The cube as a written table: the incidents are counted once for all its uses."""
    return materialised(hour_cube(incidents, population), "cube")


def cell_features(cube: DataFrame, params: HotspotParams = HotspotParams()) -> DataFrame:
    """Cube with the flags and lookups that are equal for all incidents of an (area, hour).

    The period quantiles weight each hour cell by its incidents, which is the quantile over
    incident rows; they are three small tables. The rest are windows by area on the cube.
    """
    out = cube
    for grain, period in (
        ("daily", ["date"]),
        ("monthly", ["year", "month"]),
        ("yearly", ["year"]),
    ):
        rate = f"{grain}_rate"
        cut = cube.groupBy(*period).agg(
            F.percentile(rate, F.lit(params.quantile), F.col("n_hour")).alias("cut")
        )
        flag = F.coalesce((F.col(rate) > F.col("cut")).cast("int"), F.lit(0))
        out = out.join(cut, period, "left").withColumn(f"is_{grain}_hot", flag).drop("cut")
    return with_yesterday(with_day_history(out))


def with_cell_weather(
    cells: DataFrame, weather: DataFrame, params: WeatherParams
) -> DataFrame:
    """Readings keyed by area and time, joined to the cells instead of the incidents."""
    timed = cells.withColumn("hour", F.hour("hour_ts"))
    return enrich.join_readings(timed, weather, params).drop("hour")


def engineer(
    incidents: DataFrame,
    population: DataFrame,
    weather: DataFrame | None = None,
    hotspot: HotspotParams = HotspotParams(),
    weather_params: WeatherParams = WeatherParams(),
    unique_ids: bool = True,
) -> DataFrame:
    """Incidents (incident_id, area, date, hour, ...) -> incidents with all features.

    Weather keyed by area and time travels with the cells, so the incident table is joined
    once. Weather keyed by incident id is joined to the incidents.
    """
    hour_ts = cal.hour_stamp(F.col("date"), F.col("hour"))
    base = incidents.withColumn("hour_ts", hour_ts)
    cells = cell_features(staged_cube(base, population), hotspot)
    carry = list(CELL_COLUMNS)
    by_cell = weather is not None and set(weather_params.keys) <= {"area", "date", "hour"}
    if by_cell:
        cells = with_cell_weather(cells, weather, weather_params)
        carry += list(weather_params.features)
    out = cal.with_temporal(with_trail(base, cells, carry, hotspot)).withColumns(
        {
            c: F.coalesce(c, F.lit(0))
            for c in ("is_hourly_hot", "is_daily_hot", "is_monthly_hot", "is_yearly_hot",
                      "was_daily_hot_yesterday")
        }
    )
    if by_cell:
        weights = base.groupBy(*weather_params.keys).agg(F.count("*").alias("w"))
        return enrich.fill_readings(out, weather, weather_params, weights)
    if weather is not None:
        return enrich.add_weather(
            out, weather, weather_params, unique_ids=unique_ids, counted=base
        )
    return out


def model_table(
    features: DataFrame,
    drop: Sequence[str] = CORRELATED,
    keep: Sequence[str] = (),
    dedupe: bool = True,
) -> DataFrame:
    """Published columns, NULL -> 0, whole-row duplicates removed.

    ``keep`` carries further columns along (an id for splits); with one the rows are unique.
    """
    present = {new: old for new, old in MODEL_COLUMNS.items() if old in features.columns}
    named = features.select(
        *keep, *[F.col(old).alias(new) for new, old in present.items() if new not in drop]
    )
    filled = named.fillna(0)
    return filled.distinct() if dedupe and not keep else filled


def model_rows(features: DataFrame, drop: Sequence[str] = CORRELATED) -> DataFrame:
    """Model table with an id: of equal rows the lowest incident id stays.

    Grouping on all published columns combines duplicates before the exchange.
    """
    named = model_table(features, drop, keep=["incident_id"])
    keys = [c for c in named.columns if c != "incident_id"]
    return named.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(
        F.min("incident_id").alias("incident_id")
    )


def model_table_from_cells(
    incidents: DataFrame,
    population: DataFrame,
    weather: DataFrame | None = None,
    hotspot: HotspotParams = HotspotParams(),
    weather_params: WeatherParams = WeatherParams(keys=("area", "date", "hour")),
    drop: Sequence[str] = CORRELATED,
) -> DataFrame:
    """The distinct model table without building the incident rows.

    Every model column is settled by (area, hour, position in the hour), so the skeleton of
    the trail already holds all distinct rows. The incidents are only counted: one column-pruned
    scan and one small exchange, however many incidents there are. Needs weather keyed by area
    and time, and leaves out incidents without an area or hour.
    """
    hours = incidents.select(
        "area", cal.hour_stamp(F.col("date"), F.col("hour")).alias("hour_ts")
    )
    cells = cell_features(staged_cube(hours, population), hotspot).withColumn(
        "hour", F.hour("hour_ts")
    )
    rows = cal.with_temporal(trail(cells, hotspot))
    if weather is not None:
        weights = cells.groupBy(*weather_params.keys).agg(F.sum("n_hour").alias("w"))
        rows = enrich.attach_readings(rows, weather, weather_params, weights)
    return model_table(rows, drop)
