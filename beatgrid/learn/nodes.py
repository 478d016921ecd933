"""Fitted tree ensembles as a table of nodes, and what can be read from it without another fit.

A forest's first trees are a smaller forest, a boosted model's first rounds the model of fewer rounds,
and a tree grown without random feature draws, cut at a depth, is the tree grown to that depth. So one
fit answers a whole range of tree counts and depths. The nodes are as many as in Spark's own model,
which lives on the driver and is shipped to every task that scores with it; the arrays here are too.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.sources.files import materialised, read_table, scratch_path, write_table

#: A model with more nodes is not turned into arrays.
MAX_NODES = 100_000_000
#: (row, tree) pairs that a task walks at a time.
_PAIRS = 1 << 21

NODE_COLUMNS = ("tree", "node", "feature", "threshold", "left", "right", "prediction", "stats", "gain", "weight", "boosted")


def node_table(model, spark: SparkSession) -> DataFrame:
    """One row a node of a fitted forest or boosted model, in a shared folder.

    ``feature`` and ``threshold`` say which rows go left (value <= threshold); a leaf has feature -1.
    ``stats`` holds the class weights of a classification node; ``weight`` is the tree's weight.
    """
    path = scratch_path(spark, "model-nodes")
    model.write().save(path)
    weights = read_table(spark, f"{path}/treesMetadata").toDF("tree", "about", "weight").drop("about")
    node = F.col("nodeData")
    nodes = read_table(spark, f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["prediction"].alias("prediction"),
        node["impurityStats"].alias("stats"),
        node["gain"].alias("gain"),
        (node["split"]["numCategories"] >= 0).alias("by_category"),
    )
    sound = F.when(F.col("by_category"), F.raise_error(F.lit("splits by category have no threshold"))).otherwise(F.col("threshold"))
    nodes = nodes.withColumn("threshold", sound).withColumn("boosted", F.lit(isinstance(model, GBTClassificationModel)))
    return nodes.join(F.broadcast(weights), "tree").select(*NODE_COLUMNS)  # a row a tree


def importances(nodes: DataFrame, n_features: int) -> DataFrame:
    """(feature index, importance): weighted gains summed by tree and feature, each tree scaled to one."""
    gained = nodes.filter(F.col("feature") >= 0).withColumn("part", F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, b: a + b))
    by_tree = gained.groupBy("tree", "feature").agg(F.sum("part").alias("part"))
    sums = by_tree.groupBy("tree").agg(F.sum("part").alias("whole")).filter(F.col("whole") > 0)
    by_feature = by_tree.join(sums, "tree").groupBy("feature").agg(F.sum(F.col("part") / F.col("whole")).alias("part"))
    every = nodes.sparkSession.range(n_features).select(F.col("id").cast("int").alias("feature"))
    total = by_feature.agg(F.sum("part").alias("total"))
    share = F.coalesce(F.col("part") / F.col("total"), F.lit(0.0))
    return every.join(by_feature, "feature", "left").join(F.broadcast(total)).select("feature", share.alias("importance"))


@dataclass
class Trees:
    """All nodes of an ensemble as arrays, tree after tree; children are positions in these arrays.

    ``value`` has a row per node: class shares in a forest, one prediction in a boosted model.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: np.ndarray
    boosted: bool

    @staticmethod
    def of(nodes: DataFrame) -> "Trees":
        table = nodes.toArrow().combine_chunks().sort_by([("tree", "ascending"), ("node", "ascending")])
        if table.num_rows > MAX_NODES:
            raise ValueError(f"{table.num_rows} nodes are too many for arrays; score with the model itself")
        column = {c: table.column(c).to_numpy() for c in NODE_COLUMNS if c != "stats"}
        tree = column["tree"]
        first = np.flatnonzero(np.diff(tree, prepend=-1))
        base = np.repeat(first, np.diff(np.append(first, len(tree))))
        inner = column["feature"] >= 0
        left = np.where(inner, column["left"] + base, -1)
        right = np.where(inner, column["right"] + base, -1)
        stats = table.column("stats").combine_chunks()
        width = len(stats[0]) if len(stats) else 0
        values = stats.flatten().to_numpy().reshape(len(tree), width) if width else np.zeros((len(tree), 0))
        boosted = bool(column["boosted"].any())
        if boosted:
            value = column["prediction"][:, None].copy()
        else:
            total = values.sum(axis=1, keepdims=True)
            value = np.divide(values, total, out=np.zeros_like(values), where=total > 0)
        depth = np.zeros(len(tree), np.int32)
        level, k = first, 0
        while len(level):
            depth[level] = k
            level = level[inner[level]]
            level, k = np.concatenate([left[level], right[level]]), k + 1
        return Trees(column["feature"], column["threshold"], left, right, column["prediction"], value, first, column["weight"][first], depth, boosted)

    @staticmethod
    def joined(parts: Sequence["Trees"]) -> "Trees":
        """The trees of several ensembles of one kind as one ensemble."""
        shift = np.cumsum([0, *[len(p.feature) for p in parts[:-1]]])

        def moved(name: str) -> np.ndarray:
            return np.concatenate([np.where(getattr(p, name) >= 0, getattr(p, name) + s, -1) for p, s in zip(parts, shift)])

        def put(name: str) -> np.ndarray:
            return np.concatenate([getattr(p, name) for p in parts])

        return Trees(
            put("feature"), put("threshold"), moved("left"), moved("right"), put("prediction"), put("value"), moved("roots"), put("weights"), put("depth"), parts[0].boosted
        )

    def first_trees(self, n: int) -> "Trees":
        """The ensemble of the first ``n`` trees."""
        end = self.roots[n] if n < len(self.roots) else len(self.feature)
        return Trees(
            self.feature[:end], self.threshold[:end], self.left[:end], self.right[:end], self.prediction[:end], self.value[:end], self.roots[:n], self.weights[:n], self.depth[:end], self.boosted
        )

    def table(self) -> pa.Table:
        """The nodes as ``Trees.of`` reads them, with shares in place of class weights and without gains."""
        sizes = np.diff(np.append(self.roots, len(self.feature)))
        base = np.repeat(self.roots, sizes)
        stats = self.value if not self.boosted else np.zeros((len(self.feature), 0))
        columns = {
            "tree": np.repeat(np.arange(len(self.roots), dtype=np.int32), sizes),
            "node": (np.arange(len(self.feature)) - base).astype(np.int32),
            "feature": self.feature.astype(np.int32),
            "threshold": self.threshold,
            "left": np.where(self.left >= 0, self.left - base, -1).astype(np.int32),
            "right": np.where(self.right >= 0, self.right - base, -1).astype(np.int32),
            "prediction": self.prediction,
            "stats": pa.array(list(stats), pa.list_(pa.float64())),
            "gain": np.zeros(len(self.feature)),
            "weight": np.repeat(self.weights, sizes),
            "boosted": np.full(len(self.feature), self.boosted),
        }
        return pa.table({c: columns[c] for c in NODE_COLUMNS})

    def stops(self, limit: int | None) -> np.ndarray:
        """Where rows end when trees are cut at a depth: at leaves, at the limit and, as Spark merges
        leaves that predict the same class, above subtrees that predict one class throughout."""
        leaf = self.feature < 0
        if limit is None:
            return leaf
        end = leaf | (self.depth >= limit)
        if self.boosted:
            return end
        same = end.copy()
        for k in range(min(limit, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == k) & ~end)
            a, b = self.left[at], self.right[at]
            same[at] = same[a] & same[b] & (self.prediction[a] == self.prediction[b])
        return same

    def ends(self, x: np.ndarray, stops: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
        """For each of ``stops``, which get ever fewer: the node each row ends in, a column a tree."""
        trees = len(self.roots)
        at = np.tile(self.roots, len(x))
        for stop in stops:
            going = np.flatnonzero(~stop[at])
            while len(going):
                node = at[going]
                goes_left = x[going // trees, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
                at[going] = node
                going = going[~stop[node]]
            yield at.reshape(len(x), trees)

    def votes(self, x: np.ndarray, depths: Sequence[int | None], counts: Sequence[int]) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(depth, trees, raw score by class) for every depth, ascending with None last, and tree count."""
        for depth, ends in zip(depths, self.ends(x, [self.stops(d) for d in depths])):
            if self.boosted:
                margin = np.cumsum(self.value[ends, 0] * self.weights, axis=1)
                for n in counts:
                    yield depth, n, np.stack([-margin[:, n - 1], margin[:, n - 1]], axis=1)
                continue
            total, done = np.zeros((len(x), self.value.shape[1])), 0
            for n in sorted(counts):
                total = total + self.value[ends[:, done:n]].sum(axis=1)
                done = n
                yield depth, n, total

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row after each boosting round, a column a round."""
        (ends,) = self.ends(x, [self.stops(None)])
        return np.cumsum(self.value[ends, 0] * self.weights, axis=1)

    def score_of(self, raw: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the raw scores."""
        if self.boosted:
            return 1 / (1 + np.exp(-2 * raw[:, 1]))
        total = raw.sum(axis=1)
        return np.divide(raw[:, 1], total, out=np.zeros(len(raw)), where=total > 0)

    def rows_at_a_time(self) -> int:
        return max(1, _PAIRS // max(1, len(self.roots)))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def cut_scores(
    trees: Trees, df: DataFrame, keep: Sequence[str], counts: Sequence[int], depths: Sequence[int | None] = (None,), vector: str = "features"
) -> DataFrame:
    """(keep..., trees, depth, prediction, score) of each row for every tree count and depth limit.

    A depth of null is the whole tree. Rows are not shuffled; an empty table gives an empty result.
    """
    if not counts or max(counts) > len(trees.roots) or min(counts) < 1:
        raise ValueError(f"tree counts must lie between 1 and {len(trees.roots)}")
    order = sorted((d for d in depths if d is not None)) + [None] * (None in depths)
    shared = df.sparkSession.sparkContext.broadcast(trees)
    rows = df.select(vector_to_array(vector).alias("_x"), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size = model.rows_at_a_time()
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                n = part.num_rows
                for depth, count, raw in model.votes(_matrix(part, 0), order, counts):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns[1:],
                            pa.array(np.full(n, count, np.int32)),
                            pa.array([depth] * n, pa.int32()),
                            pa.array(np.argmax(raw, axis=1).astype(np.int32)),
                            pa.array(model.score_of(raw)),
                        ],
                        names=[*keep, "trees", "depth", "prediction", "score"],
                    )

    return rows.mapInArrow(run, f"{fields + ', ' if fields else ''}trees int, depth int, prediction int, score double")


def cut_counts(trees: Trees, df: DataFrame, label: str, counts: Sequence[int], depths: Sequence[int | None] = (None,)) -> DataFrame:
    """(trees, depth, n, n_right, tp, fp, fn) over all rows; class 1 is the positive one."""
    y, p = F.col(label).cast("int"), F.col("prediction")
    return cut_scores(trees, df, [label], counts, depths).groupBy("trees", "depth").agg(
        F.count("*").alias("n"),
        F.count_if(y == p).alias("n_right"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y != 1) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p != 1)).alias("fn"),
    )


def with_votes(
    trees: Trees, state: DataFrame, label: str, depths: Sequence[int | None], parts: Sequence[tuple[int, int]], vector: str = "features"
) -> DataFrame:
    """(vector, label, raw) of each row, the trees' votes added to ``raw``: sums by depth limit, part and class.

    ``parts`` are ranges of these trees, some may be empty; ``depths`` ascend with None last. Without a
    column ``raw`` the sums begin at zero. So a forest too large for one fit votes block by block.
    """
    shared = state.sparkSession.sparkContext.broadcast(trees)
    width = trees.value.shape[1]
    before = F.col("raw") if "raw" in state.columns else F.array_repeat(F.lit(0.0), len(depths) * len(parts) * width)
    rows = state.select(vector_to_array(vector).alias("_x"), F.col(label).cast("int").alias(label), before.alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size = model.rows_at_a_time()
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                raw = _matrix(part, 2).reshape(part.num_rows, len(depths), len(parts), width).copy()
                for d, ends in enumerate(model.ends(_matrix(part, 0), [model.stops(x) for x in depths])):
                    for k, (low, high) in enumerate(parts):
                        raw[:, d, k] += model.value[ends[:, low:high]].sum(axis=1)
                each = len(depths) * len(parts) * width
                sums = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * each), pa.array(raw.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), sums], names=["_x", label, "raw"])

    return rows.mapInArrow(run, f"_x array<double>, `{label}` int, raw array<double>").select(array_to_vector("_x").alias(vector), label, "raw")


def vote_counts(state: DataFrame, label: str, counts: Sequence[int], depths: Sequence[int | None]) -> DataFrame:
    """As ``cut_counts``, from the sums of ``with_votes`` with a part up to each of ``counts``. A task adds its rows up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, len(depths), len(counts)), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _matrix(batch, 1).reshape(batch.num_rows, len(depths), len(counts), -1)
            y = batch.column(0).to_numpy(zero_copy_only=False)[:, None, None]
            p = np.argmax(np.cumsum(raw, axis=2), axis=3)
            total += np.stack([x.sum(axis=0) for x in (np.ones_like(p), y == p, (y == 1) & (p == 1), (y != 1) & (p == 1), (y == 1) & (p != 1))])
        at = [(n, d) for d in depths for n in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in at], pa.int32()), pa.array([d for _, d in at], pa.int32()), *[pa.array(t.ravel()) for t in total]],
            names=["trees", "depth", "n", "n_right", "tp", "fp", "fn"],
        )

    found = state.select(label, "raw").mapInArrow(run, "trees int, depth int, n bigint, n_right bigint, tp bigint, fp bigint, fn bigint")
    return found.groupBy("trees", "depth").agg(*[F.sum(c).alias(c) for c in ("n", "n_right", "tp", "fp", "fn")]).filter("n > 0")


def boosting_curve(trees: Trees, df: DataFrame, label: str, vector: str = "features") -> DataFrame:
    """(round, n, tp, fp, fn, f1) of a boosted model after each of its rounds, from one pass over the rows.

    A task adds its rows up, so what is shuffled is one row a round and task.
    """
    shared = df.sparkSession.sparkContext.broadcast(trees)
    rounds = len(trees.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size, total = model.rows_at_a_time(), np.zeros((4, rounds), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                y = part.column(1).to_numpy(zero_copy_only=False).astype(int)[:, None] == 1
                p = model.margins(_matrix(part, 0)) > 0
                total += np.stack([np.full(rounds, len(y)), (y & p).sum(axis=0), (~y & p).sum(axis=0), (y & ~p).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, rounds + 1)), *[pa.array(t) for t in total]], names=["round", "n", "tp", "fp", "fn"])

    parts = df.select(vector_to_array(vector).alias("_x"), F.col(label).cast("int")).mapInArrow(run, "round bigint, n bigint, tp bigint, fp bigint, fn bigint")
    sums = parts.groupBy("round").agg(*[F.sum(c).alias(c) for c in ("n", "tp", "fp", "fn")])
    return sums.withColumn("f1", f1("tp", "fp", "fn"))


def f1(tp: str, fp: str, fn: str):
    """F1 of class 1, 0 where it has no row and no prediction."""
    whole = 2 * F.col(tp) + F.col(fp) + F.col(fn)
    return F.when(whole > 0, 2 * F.col(tp) / whole).otherwise(0.0)


def best_round(scores: Sequence[float], patience: int) -> tuple[int, int]:
    """(best round, round at which boosting ends), both from 1.

    Boosting ends once ``patience`` rounds have gone by without a score above the best one so far, or
    with the last round; the best round is the first with the highest score up to there.
    """
    if not scores or patience < 1:
        raise ValueError("a score for each round and a patience of at least one round are needed")
    best = 0
    for k, score in enumerate(scores):
        if score > scores[best]:
            best = k
        elif k - best >= patience:
            return best + 1, k + 1
    return best + 1, len(scores)


def first_rounds(model, n: int, spark: SparkSession):
    """A boosted model's first ``n`` rounds, as a Spark model of its own: its stored trees without the later ones."""
    if not 1 <= n <= len(model.treeWeights):
        raise ValueError(f"the model has {len(model.treeWeights)} rounds, not {n}")
    source, target = scratch_path(spark, "boosted"), scratch_path(spark, "boosted-cut")
    model.write().save(source)
    about = json.loads(spark.read.text(f"{source}/metadata").first()[0])
    about["numTrees"] = n
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{target}/metadata")
    for part in ("data", "treesMetadata"):
        rows = read_table(spark, f"{source}/{part}")
        write_table(rows.filter(F.col(rows.columns[0]) < n), f"{target}/{part}")  # the tree's number comes first
    return DefaultParamsReader.loadParamsInstance(target, spark)


def staged_nodes(model, spark: SparkSession) -> DataFrame:
    return materialised(node_table(model, spark), "nodes")
