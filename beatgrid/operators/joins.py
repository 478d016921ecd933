"""Joins that keep a hot key from one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 1024


def join_unique(
    left: DataFrame, right: DataFrame, on: Sequence[str], count: str, how: str = "left", hot: int = HOT
) -> DataFrame:
    """Join to a table with one row per key and the key's number of left rows in ``count``.

    A key with more than a ``hot``-th of all those rows is joined by broadcast: there are fewer
    than ``hot`` such keys at any size. The other keys are shuffled and none of them is large.
    ``right`` is read more than once, so it should be staged. NULL keys match nothing.
    """
    on = list(on)
    total = right.agg(F.sum(count)).first()[0] or 0
    heavy = right.filter(F.col(count) > F.lit(total // hot)).limit(hot)
    light = right.filter(F.col(count) <= F.lit(total // hot))
    marked = left.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), on, "left")
    first = marked.filter("_hot").drop("_hot")
    rest = marked.filter(F.col("_hot").isNull()).select(left.columns).join(light, on, how)
    return first.unionByName(rest)
