"""Exact k nearest neighbours of every row within one table.

Spark partitions the points into boxes of similar size, each box is searched by itself, and a
point whose k-th distance reaches over the border of its box is also sent to the boxes it
reaches, and to those only. The result is exact; no pair of points is ever emitted as a row
unless it is among the k best of its box.

The boxes come from a sample of bounded size. Equal points are merged first and carry their
count, so copies can neither fill a box nor hide other neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.sources.files import materialised

SAMPLE_ROWS = 200_000  # upper bound of the rows used to place the boxes
QUERY_BLOCK = 512  # distances are computed for this many points at a time
CHUNK_ROWS = 20_000  # visiting points per task and box

FOUND = "vid bigint, nb_vid bigint, nb_point array<double>, nb_n bigint, dist double"


@dataclass(frozen=True)
class Boxes:
    """A binary tree of axis-parallel cuts; leaves are numbered from the left."""

    dim: list[int]  # cut dimension per node, -1 for a leaf
    cut: list[float]
    left: list[int]
    right: list[int]
    leaf: list[int]  # leaf number per node, -1 inside

    @property
    def n_leaves(self) -> int:
        return max(self.leaf) + 1


def place_boxes(sample: np.ndarray, n_leaves: int) -> Boxes:
    """Halve the sample along the widest usable dimension until there are enough leaves."""
    tree = Boxes([], [], [], [], [])
    smallest = max(1, len(sample) // max(1, n_leaves))

    def grow(rows: np.ndarray) -> int:
        node = len(tree.dim)
        for values, empty in ((tree.dim, -1), (tree.cut, 0.0), (tree.left, -1), (tree.right, -1), (tree.leaf, -1)):
            values.append(empty)
        cut = best_cut(rows) if len(rows) > 1.5 * smallest else None
        if cut is None:
            tree.leaf[node] = sum(1 for x in tree.leaf if x >= 0)
            return node
        tree.dim[node], tree.cut[node] = cut
        low = rows[:, cut[0]] <= cut[1]
        tree.left[node] = grow(rows[low])
        tree.right[node] = grow(rows[~low])
        return node

    def best_cut(rows: np.ndarray) -> tuple[int, float] | None:
        best = None
        for d in range(rows.shape[1]):
            values = rows[:, d]
            at = float(np.quantile(values, 0.5, method="lower"))
            if at == values.max():  # everything above the middle is one value
                below = values[values < at]
                if not len(below):
                    continue
                at = float(below.max())
            share = float((values <= at).mean())
            score = (min(share, 1 - share) >= 0.2, float(values.std()), min(share, 1 - share))
            if best is None or score > best[0]:
                best = (score, d, at)
        return None if best is None else (best[1], best[2])

    grow(sample)
    return tree


def home_leaf(boxes: Boxes, points: np.ndarray) -> np.ndarray:
    dim, cut = np.array(boxes.dim), np.array(boxes.cut)
    left, right, leaf = np.array(boxes.left), np.array(boxes.right), np.array(boxes.leaf)
    node = np.zeros(len(points), dtype=int)
    while True:
        inside = np.nonzero(leaf[node] < 0)[0]
        if not len(inside):
            return leaf[node]
        at = node[inside]
        low = points[inside, dim[at]] <= cut[at]
        node[inside] = np.where(low, left[at], right[at])


def reached_leaves(
    boxes: Boxes, points: np.ndarray, radius: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(point index, leaf) pairs for every leaf no further away than the point's radius."""
    dim, cut = np.array(boxes.dim), np.array(boxes.cut)
    left, right, leaf = np.array(boxes.left), np.array(boxes.right), np.array(boxes.leaf)
    who, node = np.arange(len(points)), np.zeros(len(points), dtype=int)
    gap = np.zeros_like(points)  # distance to the box per dimension
    limit = radius**2 * (1 + 1e-12)
    out_who, out_leaf = [], []
    while len(who):
        done = leaf[node] >= 0
        out_who.append(who[done])
        out_leaf.append(leaf[node[done]])
        who, node, gap = who[~done], node[~done], gap[~done]
        at, rows = dim[node], np.arange(len(who))
        side = points[who, at] - cut[node]
        low = side <= 0
        near = np.where(low, left[node], right[node])
        far = np.where(low, right[node], left[node])
        far_gap = gap.copy()
        far_gap[rows, at] = np.maximum(np.abs(side), np.abs(gap[rows, at]))
        keep = (far_gap**2).sum(axis=1) <= limit[who]
        who = np.concatenate([who, who[keep]])
        node = np.concatenate([near, far[keep]])
        gap = np.concatenate([gap, far_gap[keep]])
    return np.concatenate(out_who), np.concatenate(out_leaf)


def _search(queries: pd.DataFrame, box: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest points of the box for each query, a point is not its own neighbour."""
    if not len(queries) or not len(box):
        return pd.DataFrame(columns=["vid", "nb_vid", "nb_point", "nb_n", "dist"])
    there = np.stack(box["point"].to_numpy())
    there_id, there_n = box["vid"].to_numpy(), box["n"].to_numpy()
    parts = []
    take = min(k + 1, len(box))
    for start in range(0, len(queries), QUERY_BLOCK):
        block = queries.iloc[start : start + QUERY_BLOCK]
        here, here_id = np.stack(block["point"].to_numpy()), block["vid"].to_numpy()
        dist = np.zeros((len(here), len(there)))
        for d in range(there.shape[1]):
            dist += (here[:, d, None] - there[None, :, d]) ** 2
        near = np.argpartition(dist, take - 1, axis=1)[:, :take]
        rows = np.repeat(np.arange(len(here)), take)
        cols = near.ravel()
        other = here_id[rows] != there_id[cols]
        rows, cols = rows[other], cols[other]
        parts.append(
            pd.DataFrame(
                {
                    "vid": here_id[rows],
                    "nb_vid": there_id[cols],
                    "nb_point": pd.Series(list(there[cols]), dtype=object),
                    "nb_n": there_n[cols],
                    "dist": np.sqrt(dist[rows, cols]),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def nearest(
    points: DataFrame, k: int = 5, leaf_rows: int = 2000, seed: int = 42
) -> DataFrame:
    """Neighbours of each distinct point: (vid, point, n, neighbours).

    ``points`` has ``vid bigint, point array<double>, n bigint`` with one row per distinct point.
    ``neighbours`` lists up to k points, nearest first, copies of a point counted as often as
    they occur (the point's own copies first).
    """
    points = materialised(points.select("vid", "point", "n"), "points")
    total = points.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = points.select("point") if share == 1.0 else points.select("point").sample(share * 0.9, seed)
    drawn = [r[0] for r in sample.limit(SAMPLE_ROWS).collect()]
    boxes = place_boxes(np.array(drawn), -(-total // leaf_rows))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf = home_leaf(boxes, np.stack(batch["point"].to_numpy())) if len(batch) else []
            yield batch.assign(leaf=leaf)

    homed = materialised(
        points.mapInPandas(assign, "vid bigint, point array<double>, n bigint, leaf int"), "homed"
    )
    local = materialised(
        homed.groupBy("leaf").applyInPandas(lambda box: _search(box, box, k), FOUND), "local"
    )

    # k-th distance inside the own box; boxes with too few points leave it unlimited
    ranked = Window.partitionBy("vid").orderBy("dist", "nb_vid")
    so_far = F.sum("nb_n").over(ranked)
    reach = (
        local.select("vid", "nb_vid", "nb_n", "dist")
        .withColumn("have", so_far)
        .groupBy("vid")
        .agg(F.min(F.when(F.col("have") >= k, F.col("dist"))).alias("radius"))
    )
    asking = homed.join(reach, "vid", "left").filter(F.col("n") <= k)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            if not len(batch):
                continue
            radius = batch["radius"].astype(float).fillna(np.inf).to_numpy()
            who, leaf = reached_leaves(boxes, np.stack(batch["point"].to_numpy()), radius)
            other = leaf != batch["leaf"].to_numpy()[who]
            moved = batch.loc[who[other], ["vid", "point"]]
            yield moved.assign(leaf=leaf[other])

    visits = materialised(
        asking.mapInPandas(visit, "vid bigint, point array<double>, leaf int"), "visits"
    )
    # a box with many visitors is searched by several tasks, each with a copy of the box
    chunks = visits.groupBy("leaf").agg(
        F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks")
    )
    askers = visits.join(chunks, "leaf").withColumn(
        "chunk", F.pmod(F.xxhash64("vid"), F.col("chunks")).cast("int")
    )
    hosts = homed.join(chunks.toDF("leaf", "copies"), "leaf").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    )
    remote = (
        askers.groupBy("leaf", "chunk")
        .cogroup(hosts.groupBy("leaf", "chunk"))
        .applyInPandas(lambda q, box: _search(q, box, k), FOUND)
    )
    best = (
        local.unionByName(remote)
        .withColumn("rn", F.row_number().over(ranked))
        .filter(F.col("rn") <= k)
        .groupBy("vid")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("dist", "nb_vid", "nb_point", "nb_n"))
            ).alias("found")
        )
    )
    own = F.transform(
        F.sequence(F.lit(1), F.least(F.col("n") - 1, F.lit(k)).cast("int")), lambda _: F.col("point")
    )
    others = F.flatten(
        F.transform(
            F.coalesce("found", F.array().cast("array<struct<dist:double,nb_vid:bigint,nb_point:array<double>,nb_n:bigint>>")),
            lambda x: F.transform(
                F.sequence(F.lit(1), F.least(x["nb_n"], F.lit(k)).cast("int")),
                lambda _: x["nb_point"],
            ),
        )
    )
    mine = F.when(F.col("n") > 1, own).otherwise(F.array().cast("array<array<double>>"))
    return homed.join(best, "vid", "left").select(
        "vid", "point", "n", F.slice(F.concat(mine, others), 1, k).alias("neighbours")
    )
