"""Rolling and lag features over the incident sequence of an area.

The windows run over incident rows, not hours: the sequence of an area is its incidents
ordered by (hour, id), each carrying the rate of its area-hour. Partitioning the incidents
by area would give a handful of huge tasks. Two facts make that unnecessary:

* inside one hour the rate is constant, so with a window of w rows every row from the w-th
  on has the same window (w equal values); the flag of the row before it settles one row
  later, so from row s = w + 1 on all rows of the hour have equal features, and
* a window reaches at most w - 1 rows into earlier hours, whose last rows are all alike.

So each area-hour shortened to its first min(n, s) rows (the *skeleton*) gives the same
result for each kept position, and rows beyond position s share the result of position s.
The skeleton has at most s rows per calendar hour and area, whatever the number of incidents;
ordinary window functions run on it.

Incidents then find their position. The first s - 1 ids of an hour (*leading* rows) are a
top-k that Spark limits before the shuffle. All later rows are settled: they need one row per
(area, hour). Both tables are written to the shared folder first. Area-hours with more than a
1024th of all settled incidents, of which there are fewer than 1024 at any size, are joined by
broadcast and so never shuffled; the others are shuffled and none of them is large. Nothing is
dropped or approximated. Ids must be unique within an area-hour; a repeated one among the leading
rows is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.config import HotspotParams
from beatgrid.operators.grains import hour_cube
from beatgrid.operators.joins import join_unique
from beatgrid.sources.files import materialised

TRAIL_COLUMNS = [
    "rolling_mean",
    "rolling_std",
    "z_score",
    "is_hourly_hot",
    "rate_last_row",
    "rate_last_3_avg",
    "rate_last_6_sum",
    "was_hourly_hot_last_row",
]


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """NULL where the deviation is zero or unknown, so it can never pass a threshold."""
    return F.when(std > 0, (value - mean) / std)


def settled_position(params: HotspotParams) -> int:
    """Position in an hour from which the features no longer change (at least six rows back)."""
    return max(params.window_rows + 1, 7)


def skeleton(cells: DataFrame, size: int) -> DataFrame:
    """Each (area, hour) repeated for its first ``size`` positions at most."""
    positions = F.sequence(F.lit(1), F.least(F.col("n_hour"), F.lit(size)).cast("int"))
    return cells.select("*", F.explode(positions).alias("pos"))


def trail(cells: DataFrame, params: HotspotParams = HotspotParams()) -> DataFrame:
    """Rolling and lag features per (area, hour, position); other cell columns are kept.

    A cell table that is distributed by area already needs no further exchange.
    """
    order = Window.partitionBy("area").orderBy("hour_ts", "pos")
    recent = order.rowsBetween(-(params.window_rows - 1), 0)
    rate = F.col("hourly_rate")
    enough = F.count(rate).over(recent) >= params.min_rows
    stats = skeleton(cells, settled_position(params)).withColumns(
        {
            "rolling_mean": F.when(enough, F.avg(rate).over(recent)),
            "rolling_std": F.when(enough, F.stddev_samp(rate).over(recent)),
            "rate_last_row": F.lag(rate, 1).over(order),
            "rate_last_3_avg": F.avg(rate).over(order.rowsBetween(-3, -1)),
            "rate_last_6_sum": F.sum(rate).over(order.rowsBetween(-6, -1)),
        }
    )
    flagged = stats.withColumn(
        "z_score", zscore(rate, F.col("rolling_mean"), F.col("rolling_std"))
    ).withColumn(
        "is_hourly_hot",
        F.coalesce(
            (F.round("z_score", params.z_digits) > params.z_threshold).cast("int"), F.lit(0)
        ),
    )
    return flagged.withColumn(
        "was_hourly_hot_last_row", F.lag("is_hourly_hot", 1).over(order)
    )


def leading_ids(incidents: DataFrame, last: int) -> DataFrame:
    """(area, hour, pos, id): the lowest ids of each hour, up to position ``last`` - 1.

    Position ``last`` repeats the id before it, the bound above which ids are settled. The rank
    filter becomes a group limit in front of the exchange, so a hot area-hour sends only that
    many rows per task.
    """
    rank = Window.partitionBy("area", "hour_ts").orderBy("incident_id")
    places = F.when(
        F.col("rn") == last - 1, F.array(F.lit(last - 1), F.lit(last))
    ).otherwise(F.array("rn"))
    return (
        incidents.select("area", "hour_ts", "incident_id")
        .filter(F.col("area").isNotNull() & F.col("hour_ts").isNotNull())
        .withColumn("rn", F.row_number().over(rank))
        .filter(F.col("rn") <= last - 1)
        .select("area", "hour_ts", "incident_id", F.explode(places).alias("pos"))
    )


def with_trail(
    incidents: DataFrame,
    cells: DataFrame,
    carry: list[str],
    params: HotspotParams = HotspotParams(),
) -> DataFrame:
    """Incident rows with the trail features and the carried cell columns.

    Rows without an area or hour stay, with NULL features.
    """
    last = settled_position(params)
    key, columns = ["area", "hour_ts"], [*carry, *TRAIL_COLUMNS]
    places = (
        trail(cells, params)
        .join(leading_ids(incidents, last), [*key, "pos"])
        .select(*key, "incident_id", *columns, "n_hour", "pos")
    )
    places = materialised(places, "places")
    leading = places.filter(F.col("pos") < last).select(*key, "incident_id", *columns)
    if leading.groupBy(*key, "incident_id").count().filter("count > 1").limit(1).count():
        raise ValueError("incident_id repeats within an area and hour")
    settled = places.filter(F.col("pos") == last)

    bound = settled.withColumnRenamed("incident_id", "lead_max").drop("pos")
    rows = join_unique(incidents, bound, key, "n_hour")
    is_settled = F.col("incident_id") > F.col("lead_max")
    late = rows.filter(is_settled).select(*incidents.columns, *columns)
    early = (
        rows.filter(~F.coalesce(is_settled, F.lit(False)))
        .select(*incidents.columns)
        .join(leading, [*key, "incident_id"], "left")
        .select(*incidents.columns, *columns)
    )
    return early.unionByName(late)


def incident_trail(
    incidents: DataFrame, population: DataFrame, params: HotspotParams = HotspotParams()
) -> DataFrame:
    """Incident rows with hourly rate, rolling statistics, z-score, hot flag and row lags."""
    cube = hour_cube(incidents, population)
    return with_trail(incidents, cube, ["hourly_rate"], params).withColumn(
        "is_hourly_hot", F.coalesce("is_hourly_hot", F.lit(0))
    )
