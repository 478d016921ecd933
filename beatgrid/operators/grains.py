"""Counts and rates per area and time grain.

Every grain derives from one aggregate: incidents per (area, hour). It is counted with
map-side combine, so a hot area-hour costs one partial row per task. What follows works on
that aggregate, whose size is bounded by areas x hours of the calendar and not by the
number of incidents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.functions.numeric import rate_per_1000

GRAINS: dict[str, tuple[str, ...]] = {
    "hourly": ("area", "date", "hour"),
    "daily": ("area", "date"),
    "monthly": ("area", "year", "month"),
    "yearly": ("area", "year"),
}


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Grouping keys that are NULL form no group."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def with_population(cells: DataFrame, population: DataFrame) -> DataFrame:
    """Left join the population dimension on area, and on year when it has one."""
    on = [c for c in ("area", "year") if c in population.columns]
    return cells.join(population, on, "left")


def grain_expr(name: str) -> Column:
    date = F.col("date")
    return {
        "area": F.col("area"),
        "date": date,
        "hour": F.col("hour"),
        "year": F.year(date),
        "month": F.month(date),
    }[name].alias(name)


def counts(incidents: DataFrame, grain: str) -> DataFrame:
    keys = GRAINS[grain]
    base = not_null(incidents, [c for c in ("area", "date", "hour") if c in keys or c == "date"])
    return base.select(*[grain_expr(k) for k in keys]).groupBy(*keys).agg(F.count("*").alias("n"))


def rates(incidents: DataFrame, population: DataFrame, grain: str) -> DataFrame:
    """Incidents per 1000 residents for each cell of the grain."""
    cells = counts(incidents, grain)
    if "year" not in cells.columns:
        cells = cells.withColumn("year", F.year("date"))
    return with_population(cells, population).select(
        *GRAINS[grain], "n", rate_per_1000(F.col("n"), F.col("population")).alias(f"{grain}_rate")
    )


def hour_cube(incidents: DataFrame, population: DataFrame) -> DataFrame:
    """One row per (area, hour) that has incidents, with counts and rates at all four grains.

    All windows share the distribution by area, so the cube needs one exchange for counting
    and one for the windows. An area has at most 9,150 rows per year here, however many
    incidents it has. Incidents with a date but no hour count for their day, month and year, as
    in ``counts``.
    """
    day = F.to_date("hour_ts")
    if "date" in incidents.columns:
        day = F.coalesce(F.to_date("date"), day)
    hourly = (
        not_null(incidents.select("area", "hour_ts", day.alias("date")), ["area", "date"])
        .groupBy("area", "date", "hour_ts")
        .agg(F.count("*").alias("n_hour"))
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )
    with_counts = hourly.withColumns(
        {
            "n_day": F.sum("n_hour").over(Window.partitionBy("area", "date")),
            "n_month": F.sum("n_hour").over(Window.partitionBy("area", "year", "month")),
            "n_year": F.sum("n_hour").over(Window.partitionBy("area", "year")),
        }
    )
    residents = F.col("population")
    return with_population(with_counts.filter(F.col("hour_ts").isNotNull()), population).select(
        "area",
        "hour_ts",
        "date",
        "year",
        "month",
        "n_hour",
        "n_day",
        "n_month",
        "n_year",
        rate_per_1000(F.col("n_hour"), residents).alias("hourly_rate"),
        rate_per_1000(F.col("n_day"), residents).alias("daily_rate"),
        rate_per_1000(F.col("n_month"), residents).alias("monthly_rate"),
        rate_per_1000(F.col("n_year"), residents).alias("yearly_rate"),
    )


def period_cells(cube: DataFrame, grain: str) -> DataFrame:
    """Cube folded to (area, period): incident count and rate of the cell."""
    period = {"daily": ("date",), "monthly": ("year", "month"), "yearly": ("year",)}[grain]
    size = {"daily": "n_day", "monthly": "n_month", "yearly": "n_year"}[grain]
    return cube.groupBy("area", *period).agg(
        F.max(size).alias("n"), F.max(f"{grain}_rate").alias("rate")
    )


def hot_cells(cells: DataFrame, period: Sequence[str], quantile: float) -> DataFrame:
    """Flag cells whose rate lies above the period's quantile over incident rows.

    The quantile weights each area by its incident count. Cells are few per period (one per
    area), so the exact ``percentile`` with a frequency column holds only that many values.
    """
    cut = cells.groupBy(*period).agg(
        F.percentile("rate", F.lit(quantile), F.col("n")).alias("cut")
    )
    return cells.join(cut, list(period), "left").select(
        "area",
        *period,
        "n",
        "rate",
        "cut",
        F.coalesce((F.col("rate") > F.col("cut")).cast("int"), F.lit(0)).alias("is_hot"),
    )


def rates_to_rows(incidents: DataFrame, cube: DataFrame) -> DataFrame:
    """All four rates on every incident row with one join on (area, hour).

    AQE broadcasts the cube when it is small and splits hot area-hours when it is not.
    """
    cols = ["hourly_rate", "daily_rate", "monthly_rate", "yearly_rate"]
    return incidents.join(cube.select("area", "hour_ts", *cols), ["area", "hour_ts"], "left")


def centroids(incidents: DataFrame, x: str, y: str) -> DataFrame:
    """Mean position per area."""
    return (
        not_null(incidents, ["area"])
        .groupBy("area")
        .agg(F.avg(x).alias(f"center_{x}"), F.avg(y).alias(f"center_{y}"))
    )


def with_centroids(incidents: DataFrame, x: str, y: str) -> DataFrame:
    return incidents.join(centroids(incidents, x, y), "area", "left")
