"""Exact ranks, quantiles and cuts over a total order, without sorting everything in one task.

Two tools:

* ``cumulative`` gives each distinct value the number of rows below it. Values are counted
  first, then spread over buckets whose edges come from a quantile sketch; only bucket totals
  are summed in one place.
* ``rank_cut`` finds the id at a given rank by counting ids in equal-width ranges and then
  looking into the one range that holds the rank. Every step is a plain aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.sources.files import materialised

FANOUT = 65536  # ranges counted per narrowing step


def bucket_edges(
    df: DataFrame, values: Sequence[str], buckets: int | None = None
) -> dict[str, list[float]]:
    """Approximate quantiles of numeric columns, all in one pass: a few numbers per column.

    They only balance the buckets, so their error does not touch the result. The number of
    buckets follows the shuffle partitions the cluster is set to.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2, min(buckets, 10000))
    probs = [i / buckets for i in range(1, buckets)]
    found = df.select(*[F.col(v).cast("double").alias(v) for v in values]).approxQuantile(
        list(values), probs, 1 / (4 * buckets)
    )
    return {
        v: sorted({x for x in xs if x is not None and math.isfinite(x)})
        for v, xs in zip(values, found)
    }


def with_bucket(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    splits = [-math.inf, *edges, math.inf]
    if len(splits) < 3:
        return df.withColumn("bucket", F.lit(0.0))
    bucketizer = Bucketizer(splits=splits, inputCol="bucket_key", outputCol="bucket")
    return bucketizer.transform(df.withColumn("bucket_key", F.col(value).cast("double"))).drop(
        "bucket_key"
    )


def cumulative(
    counted: DataFrame, value: str, n: str, edges: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``below`` (rows with a smaller value) and ``total`` to a table of counted values.

    ``counted`` has one row per (by, value). A task sorts one (by, bucket) at a time.
    """
    by = list(by)
    spread = with_bucket(counted, value, edges)
    whole = Window.partitionBy(*by)
    totals = (
        spread.groupBy(*by, "bucket")
        .agg(F.sum(n).alias("in_bucket"))
        .withColumn(
            "offset",
            F.sum("in_bucket").over(whole.orderBy("bucket")) - F.col("in_bucket"),
        )
        .withColumn("total", F.sum("in_bucket").over(whole))
        .drop("in_bucket")
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(value)
    before = F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(n)
    return (
        spread.withColumn("before", before)
        .join(totals, [*by, "bucket"])
        .withColumn("below", F.col("offset") + F.col("before"))
        .drop("bucket", "before", "offset")
    )


def count_values(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """One row per (by, value) with its row count ``_n``; NULL and NaN are not counted."""
    size = F.count("*") if weight is None else F.sum(weight)
    return (
        df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*by, F.col(value).cast("double").alias(value))
        .agg(size.alias("_n"))
    )


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per group with a column per entry of probs.

    Rows are counted per distinct value before anything else, so repeated values cost nothing
    and no group is held in one place. The counts are staged, so ``df`` is read once.
    """
    by = list(by)
    counted = materialised(count_values(df, value, by, weight), "counted")
    if edges is None:
        edges = bucket_edges(counted, [value])[value]
    placed = cumulative(counted, value, "_n", edges, by)
    picks: list[Column] = []
    for name, p in probs.items():
        target = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(target)), ("hi", F.ceil(target))):
            holds = (F.col("below") <= rank) & (rank < F.col("below") + F.col("_n"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"{name}_{side}"))
    found = placed.groupBy(*by).agg(F.max("total").alias("total"), *picks)
    out = []
    for name, p in probs.items():
        target = F.lit(float(p)) * (F.col("total") - 1)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo + (hi - lo) * (target - F.floor(target))).alias(name))
    return found.select(*by, *out)


def mode_value(df: DataFrame, value: str) -> DataFrame:
    """One row: the most frequent non-null value, the smallest one on a tie."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(value))
        .limit(1)
        .select(F.col(value).alias(f"{value}_mode"))
    )


def rank_cut(rows: DataFrame, ident: str, targets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The ``rank``-th smallest id (1-based) of each group: (by..., cut_id).

    ``rows`` holds (by..., ident) with ids unique in a group, ``targets`` (by..., rank) with
    one row per group. Each step counts ids in FANOUT ranges and keeps the range that holds
    the rank; a range of width 1 is the id itself. The number of steps follows from the id
    range (two for ids up to 4e9) and the state is one row per group.
    """
    by = list(by)

    def attach(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, by) if by else left.join(F.broadcast(right))

    spread = rows.groupBy(*by).agg(F.min(ident).alias("lo"), F.max(ident).alias("hi"))
    state = materialised(attach(targets, spread), "cut")
    wide = "decimal(20,0)"
    span = state.agg(F.max(F.col("hi").cast(wide) - F.col("lo").cast(wide))).first()[0]
    if span is None:
        return state.select(*by, F.lit(None).cast("bigint").alias("cut_id"))
    if span >= 2**63:
        raise ValueError(f"ids of column {ident} spread over more than 63 bits")
    steps = 1
    while FANOUT**steps <= span:
        steps += 1
    state = state.select(*by, "lo", "rank")
    for step in range(steps):
        width = FANOUT ** (steps - 1 - step)
        offset = F.col(ident) - F.col("lo")
        reach = min(width * FANOUT, 2**63) - 1
        inside = attach(rows, state).filter((F.col(ident) >= F.col("lo")) & (offset <= reach))
        # the remainder goes first: a plain quotient of large numbers would be rounded
        place = ((offset - offset % width) / width).cast("bigint")
        ranges = inside.groupBy(*by, "lo", "rank", place.alias("range")).agg(
            F.count("*").alias("n")
        )
        # at most FANOUT rows per group
        upto = Window.partitionBy(*by).orderBy("range")
        state = materialised(
            ranges.withColumn("upto", F.sum("n").over(upto))
            .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
            .select(
                *by,
                (F.col("lo") + F.col("range") * width).alias("lo"),
                (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"),
            ),
            "cut",
        )
    return state.select(*by, F.col("lo").alias("cut_id"))
