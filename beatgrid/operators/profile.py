"""Descriptive profile of an incident table: counts, cross-tabs, summaries, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.operators.grains import not_null
from beatgrid.operators.ordered import quantiles
from beatgrid.sources.files import materialised

#: Columns that a cross-tab may have.
MAX_COLUMNS = 10_000


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Counts per value, largest first; ties by value. ``limit`` gives the top-k report."""
    out = (
        not_null(df, [column])
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )
    return out if limit is None else out.limit(limit)


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return not_null(df, keys).groupBy(*keys).agg(F.count("*").alias("n"))


def average_per_year(df: DataFrame, part: str, year: str = "year") -> DataFrame:
    """Rows per calendar part divided by the number of distinct years.

    Counted once per (part, year); both figures come from that small table.
    """
    cells = df.groupBy(part, year).agg(F.count("*").alias("n"))
    years = cells.agg(F.count_distinct(year).alias("years")).scalar()
    return (
        not_null(cells, [part])
        .groupBy(part)
        .agg(F.sum("n").alias("n"))
        .select(part, "n", (F.col("n") / years).alias("avg_n"))
    )


def pivot_counts(
    df: DataFrame, row: str, column: str, prefix: str, values: Sequence | None = None, fill: int | None = None
) -> DataFrame:
    """Cross-tab with one column per value of ``column`` in the data.

    Rows are counted per pair first, so finding the values and folding them read that small
    table. With ``values`` (a closed domain, such as the hours of a day) there is one column for
    each of them, and a value outside it is an error when the rows are read.
    """
    cells = count_by(df, [row, column])
    if values is None:
        cells = materialised(cells, "pairs")
        values = sorted(r[0] for r in cells.select(column).distinct().limit(MAX_COLUMNS + 1).collect())
        if len(values) > MAX_COLUMNS:
            raise ValueError(f"column {column} has more than {MAX_COLUMNS} values")
    else:
        known = F.col(column).isin(list(values))
        stray = F.raise_error(F.concat(F.lit(f"unlisted value of {column}: "), F.col(column).cast("string")))
        cells = cells.withColumn(column, F.when(known, F.col(column)).otherwise(stray.cast(cells.schema[column].dataType)))
    picked = [F.sum(F.when(F.col(column) == F.lit(v), F.col("n"))).alias(f"{prefix}{v}") for v in values]
    named = cells.groupBy(row).agg(*picked)
    return named if fill is None else named.fillna(fill)


def shares(df: DataFrame, within: str, key: str) -> DataFrame:
    """Percentage of each key inside its group."""
    cells = count_by(df, [within, key])
    total = F.sum("n").over(Window.partitionBy(within))
    return cells.withColumn("pct", F.col("n") / total * 100)


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max in one row; quartiles are exact."""
    basics = df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return basics.join(
        F.broadcast(quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75}))
    )


def five_numbers(df: DataFrame, column: str, by: str) -> DataFrame:
    """Minimum, quartiles and maximum per group: the data under a box plot."""
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    return quantiles(not_null(df, [by]), column, probs, [by])


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the value range; the top edge belongs to the last bin."""
    edges = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.floor(F.try_divide(F.col(column) - F.col("lo"), width))
    return (
        not_null(df.select(column), [column])
        .join(F.broadcast(edges))
        .select(
            F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"),
            "lo",
            "hi",
        )
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.max("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
            "n",
        )
    )


def table_summary(df: DataFrame, columns: Sequence[str], date: str, area: str) -> DataFrame:
    """Row count, NULLs per column, date range and number of areas in one pass."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        *nulls,
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count_distinct(area).alias("n_areas"),
    )


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def headline(df: DataFrame, weekend: str, area: str, category: str) -> DataFrame:
    """Weekend share, busiest area and most frequent category.

    One aggregate per (weekend, area, category); the figures come from that small table.
    """
    cells = df.groupBy(weekend, area, category).agg(F.count("*").alias("n"))
    parts = cells.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col(weekend) == "Weekend", F.col("n")).otherwise(0)).alias("n_weekend"),
    ).withColumn("weekend_pct", F.col("n_weekend") / F.col("n_rows") * 100)
    out = parts
    for column, name in ((area, "top_area"), (category, "top_category")):
        top = (
            not_null(cells, [column])
            .groupBy(F.col(column).alias(name))
            .agg(F.sum("n").alias(f"{name}_n"))
            .orderBy(F.desc(f"{name}_n"), F.asc(name))
            .limit(1)
        )
        out = out.join(F.broadcast(top), F.lit(True), "left")
    return out


def rolling_daily(df: DataFrame, date: str = "date", rows: int = 30) -> DataFrame:
    """Rows per day and their mean over the last ``rows`` days that have rows."""
    daily = count_by(df, [date])
    # one row per day: the calendar bounds this window
    recent = Window.orderBy(date).rowsBetween(-(rows - 1), 0)
    return daily.withColumn(
        "rolling_mean", F.when(F.count("n").over(recent) == rows, F.avg("n").over(recent))
    )


def rolling_by_category(
    df: DataFrame, category: str = "category", date: str = "date", rows: int = 30
) -> DataFrame:
    """The same per category over all days of the table; a day without rows blanks its windows.

    Days are numbered across all categories and the frame runs over that number, so the grid
    of days x categories is never built; a missing (day, category) has no row and no mean.
    """
    cells = count_by(df, [date, category])
    # one row per day: the calendar bounds this window
    days = cells.select(date).distinct().withColumn("day_no", F.row_number().over(Window.orderBy(date)))
    recent = Window.partitionBy(category).orderBy("day_no").rangeBetween(-(rows - 1), 0)
    return (
        cells.join(days, date)
        .withColumn(
            "rolling_mean", F.when(F.count("n").over(recent) == rows, F.avg("n").over(recent))
        )
        .drop("day_no")
    )


def leading_trends(rolled: DataFrame, category: str, top: int = 3, bottom: int = 4) -> DataFrame:
    """Categories with the largest and smallest summed rolling mean."""
    sums = rolled.groupBy(category).agg(
        F.coalesce(F.sum("rolling_mean"), F.lit(0.0)).alias("trend_sum")
    )
    sums = materialised(sums, "trend-sums")
    down, up = [F.desc("trend_sum"), F.asc(category)], [F.asc("trend_sum"), F.desc(category)]
    n = sums.agg(F.count("*").cast("int").alias("n_all"))
    # two top-k's; only these few rows are numbered
    first = sums.orderBy(*down).limit(top).withColumn("from_top", F.row_number().over(Window.orderBy(*down)))
    last = sums.orderBy(*up).limit(bottom).withColumn("from_bottom", F.row_number().over(Window.orderBy(*up)))
    first = first.join(F.broadcast(n)).withColumn("from_bottom", F.col("n_all") - F.col("from_top") + 1)
    last = last.join(F.broadcast(n)).withColumn("from_top", F.col("n_all") - F.col("from_bottom") + 1)
    ranked = first.drop("n_all").unionByName(last.drop("n_all")).distinct()
    return ranked.withColumns(
        {
            "is_top": (F.col("from_top") <= top).cast("int"),
            "is_bottom": (F.col("from_bottom") <= bottom).cast("int"),
        }
    )


def most_recent(df: DataFrame, n: int, order: str, ident: str) -> DataFrame:
    """The latest n rows: a top-k, not a full sort."""
    return df.orderBy(F.desc(order), F.desc(ident)).limit(n)


def area_counts_on_districts(
    incidents: DataFrame, districts: DataFrame, station: str, how: str
) -> DataFrame:
    """District attributes with the incident count of the area of that name."""
    per_area = not_null(incidents, ["area"]).groupBy("area").agg(F.count("*").alias("n"))
    return districts.join(per_area, districts[station] == per_area["area"], how)


def top_area_per_category(df: DataFrame, area: str = "area", category: str = "category") -> DataFrame:
    """Greedy pairing: largest (area, category) counts first, no area or category twice.

    In rounds: a pair that is first both for its area and for its category is taken, as the greedy
    walk would, and all pairs of that area or category go. Each round works on the summary with one
    row per pair and is distributed by area and by category; every round takes the largest pair left
    at least, and usually many.
    """
    left = materialised(count_by(df, [area, category]).toDF("area", "category", "n"), "pairs")
    first = lambda by: Window.partitionBy(by).orderBy(F.desc("n"), "area", "category")
    chosen = None
    while not left.isEmpty():
        ranked = left.withColumn("by_area", F.row_number().over(first("area")))
        ranked = ranked.withColumn("by_category", F.row_number().over(first("category")))
        taken = materialised(ranked.filter("by_area = 1 and by_category = 1").select("area", "category", "n"), "taken")
        chosen = taken if chosen is None else chosen.unionByName(taken)
        left = left.join(taken.select("area"), "area", "left_anti").join(taken.select("category"), "category", "left_anti")
        left = materialised(left, "pairs")
    return left if chosen is None else chosen
