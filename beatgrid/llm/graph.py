"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import few_tasks, join_unique
from beatgrid.sources.files import discard, materialised


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) edges with long ids; the component is its least node.

    Large-star and small-star steps in turn connect every node to ever smaller neighbours until
    all are connected to the least one; the number of rounds grows with the logarithm of the longest
    path. Each step counts and takes minima per node before it joins, and a node with a large share
    of the edges is joined by broadcast. Nothing but the end of the rounds is
    decided on the driver. ``edges`` are counted first, so they should be staged.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    n = edges.count()
    edges = materialised(few_tasks(edges.distinct(), n), "edges")
    while _unfinished(edges, n):
        for large in (True, False):
            last, edges = edges, _star(edges, large, n)
            discard(last)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(few_tasks(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct(), 2 * n))


def _unfinished(edges: DataFrame, n: int) -> bool:
    """Whether a node has two smaller neighbours, or a smaller and a larger one; n as in ``_star``."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return bool(few_tasks(found.filter("up > 1 or up = 1 and down = 1"), 2 * n).limit(1).count())


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """Connect each node's neighbours to the least of them: the larger ones, or the smaller ones and itself.
    The number of tasks follows from about n edges."""
    near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
    least = materialised(few_tasks(least, 2 * n), "least")
    moved = join_unique(near.filter("b > a") if large else near, least, "a", "n", "inner")
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    done = materialised(few_tasks(moved.filter("a <> b").distinct(), 2 * n), "edges")
    discard(least)
    return done
