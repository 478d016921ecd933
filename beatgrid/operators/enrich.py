"""Weather enrichment and weather-by-time interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.config import WeatherParams
from beatgrid.functions import encode
from beatgrid.operators.clean import keep_first
from beatgrid.operators.ordered import bucket_edges, quantiles
from beatgrid.sources.files import materialised


def readings_of(weather: DataFrame, params: WeatherParams) -> DataFrame:
    values = [F.col(f).cast("double").alias(f) for f in params.features]
    return weather.select(*params.keys, *values).distinct()


def join_readings(rows: DataFrame, weather: DataFrame, params: WeatherParams) -> DataFrame:
    """Left join one reading per key: of several the first in value order."""
    keys = list(params.keys)
    single = keep_first(readings_of(weather, params), keys, list(params.features))
    return rows.join(single, keys, "left")


def fill_readings(
    rows: DataFrame, weather: DataFrame, params: WeatherParams, weights: DataFrame
) -> DataFrame:
    """Fill missing readings with a number or with the median over the incident rows.

    ``weights`` holds the incident count ``w`` per key. The median is taken over weighted
    readings (all of a key count), so the joined rows are never built for it.
    """
    features = list(params.features)
    if params.fill != "median":
        return rows.fillna(float(params.fill), subset=features)
    weighted = materialised(readings_of(weather, params).join(weights, list(params.keys)), "weighted")
    edges = bucket_edges(weighted, features)
    medians = {
        f: quantiles(weighted, f, {"median": 0.5}, weight="w", edges=edges[f]).scalar()
        for f in features
    }
    return rows.withColumns({f: F.coalesce(F.col(f), m) for f, m in medians.items()})


def attach_readings(
    rows: DataFrame, weather: DataFrame, params: WeatherParams, weights: DataFrame
) -> DataFrame:
    return fill_readings(join_readings(rows, weather, params), weather, params, weights)


def add_weather(
    incidents: DataFrame,
    weather: DataFrame,
    params: WeatherParams = WeatherParams(),
    ident: str = "incident_id",
    unique_ids: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Incidents with weather, one row per incident id.

    ``fill`` is ``"median"`` (over the joined rows) or a number. With ``unique_ids`` the final
    deduplication, a no-op then, is left out. ``counted`` may hold the same incidents without
    their other features, so that the median does not compute those again.
    """
    weights = (incidents if counted is None else counted).groupBy(*params.keys).agg(
        F.count("*").alias("w")
    )
    out = attach_readings(incidents, weather, params, weights)
    return out if unique_ids else keep_first(out, [ident], [ident, *params.features])


def high_flag(df: DataFrame, value: str, name: str, quantile: float = 0.75) -> DataFrame:
    """1 where the value lies above its own quantile over the whole table."""
    cut = quantiles(df, value, {"cut": quantile}).scalar()
    return df.withColumn(name, F.coalesce((F.col(value) > cut).cast("int"), F.lit(0)))


def weather_interactions(df: DataFrame) -> DataFrame:
    """Night temperature, high wind flag and temperature band; the rows are staged, as the flag's
    quantile reads them as well."""
    df = materialised(df, "weather-rows")
    return high_flag(df, "wspeed", "high_wind").withColumns(
        {
            "temp_night": encode.night_value(F.col("temp"), F.col("hour")),
            "temp_category": encode.temperature_band(F.col("temp")),
        }
    )


def request_keys(incidents: DataFrame, cells: DataFrame) -> DataFrame:
    """Distinct (area position, hour) pairs for which readings are needed."""
    return (
        incidents.select("area", "hour_ts")
        .filter(F.col("area").isNotNull() & F.col("hour_ts").isNotNull())
        .distinct()
        .join(cells, "area", "left")
    )
