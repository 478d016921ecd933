"""Forests whose trees each see a table of their own: random cut points, or a balanced draw a tree.

Every tree is one fit of Spark's learner with a single tree; the fits run side by side, and their
nodes are put together to one ensemble.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.draws import uniform
from beatgrid.learn import nodes
from beatgrid.learn.resample import class_sizes
from beatgrid.sources.files import materialised, read_table, scratch_path, write_table

#: Random cut points of a feature and tree; Spark's learner then has no others to choose from.
CUTS = 31


@dataclass
class NodeModel:
    """An ensemble of trees as arrays; ``transform`` adds the share of votes for class 1 and the class."""

    trees: nodes.Trees
    featureImportances: np.ndarray  # same name as on Spark ML models

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.arrow_udf("double")
        def share(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            trees = shared.value
            size, whole = trees.rows_at_a_time(), [len(trees.roots)]
            for values in batches:
                x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
                parts = [raw for k in range(0, len(x), size) for _, _, raw in trees.votes(x[k : k + size], [None], whole)]
                yield pa.array(trees.score_of(np.concatenate(parts)) if parts else np.zeros(0))

        scored = df.withColumn("score", share(vector_to_array("features")))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("double"))


def _put_together(jobs: list[int], fit: Callable[[int], tuple[nodes.Trees, np.ndarray]], df: DataFrame, parallelism: int) -> NodeModel:
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        done = pool.map(inheritable_thread_target(df.sparkSession)(fit), jobs, chunksize=1)
    gains = np.sum([g for _, g in done], axis=0)
    return NodeModel(nodes.Trees.joined([t for t, _ in done]), gains / gains.sum() if gains.sum() else gains)


def random_cuts(low: np.ndarray, high: np.ndarray, tree: int, seed: int, cuts: int = CUTS) -> list[np.ndarray]:
    """Cut points of each feature for one tree, uniform between its extremes; one point for a constant feature."""
    draws = np.random.default_rng([seed, tree])
    return [np.unique(draws.uniform(a, b, cuts)) if b > a else np.array([a]) for a, b in zip(low, high)]


def binned(df: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The vectors with each value replaced by the number of cut points below it."""

    @F.arrow_udf("array<double>")
    def bins(values: pa.Array) -> pa.Array:
        x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
        out = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(float)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(cuts)), pa.array(out.ravel()))

    return df.withColumn("features", array_to_vector(bins(vector_to_array("features"))))


def extra_trees(data: DataFrame, label: str, params: Mapping, seed: int, packed: Callable[[DataFrame], DataFrame], parallelism: int = 8) -> NodeModel:
    """Extremely randomised trees: the whole sample for every tree, a random subset of features at each
    node, and cut points drawn at random for each tree and feature instead of searched for.

    Constant features are never split. Equal settings and seed give equal cut points.
    """
    rows = packed(materialised(data.select("features", label), "extra-rows"))
    x = vector_to_array("features")
    width = rows.select(F.size(x)).first()[0]
    ends = rows.select(x.alias("x")).agg(*[f(F.col("x")[j]) for j in range(width) for f in (F.min, F.max)]).first()
    low, high = np.array(ends[0::2], float), np.array(ends[1::2], float)
    settings = {k: v for k, v in params.items() if k != "numTrees"}

    def fit(tree: int) -> tuple[nodes.Trees, np.ndarray]:
        cuts = random_cuts(low, high, tree, seed)
        learner = RandomForestClassifier(
            labelCol=label, numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxBins=max(CUTS + 1, 32), seed=seed + tree, **settings
        )
        model = learner.fit(binned(rows, cuts))
        found = nodes.Trees.of(nodes.node_table(model, data.sparkSession))
        inner = np.flatnonzero(found.feature >= 0)
        # "at most k cut points below" is "not above the k-th cut point", counted from 0
        found.threshold[inner] = [cuts[f][int(t)] for f, t in zip(found.feature[inner], found.threshold[inner])]
        return found, model.featureImportances.toArray()

    return _put_together(list(range(params["numTrees"])), fit, data, parallelism)


def balanced_draws(data: DataFrame, label: str, trees: int, ident: str, seed: int) -> DataFrame:
    """Every row once for each tree whose sample it belongs to, with ``tree``, in folders by tree.

    A tree takes all rows of the smaller class and each row of the larger one with the probability
    that makes both equally large on average, by a draw from the row's id and the tree's number. One
    pass over the rows deals all samples; together they hold some ``trees`` times twice the smaller class.
    """
    sizes = class_sizes(data, label)
    small = min(sizes, key=lambda c: (sizes[c], c))
    keep = sizes[small] / max(sizes.values())
    every = F.sequence(F.lit(0), F.lit(trees - 1))
    drawn = F.filter(every, lambda t: (F.col(label) == small) | (uniform(F.col(ident), seed, t) < keep))
    dealt = data.withColumn("tree", F.explode(drawn))
    path = write_table(dealt, scratch_path(data.sparkSession, "balanced-draws"), by=("tree",))
    return read_table(data.sparkSession, path)


def balanced_forest(
    data: DataFrame, label: str, params: Mapping, ident: str, seed: int, packed: Callable[[DataFrame], DataFrame], parallelism: int = 8
) -> NodeModel:
    """A forest in which every tree is grown on a bootstrap of its own balanced draw."""
    trees = params["numTrees"]
    samples = balanced_draws(data.select("features", label, ident), label, trees, ident, seed)
    settings = {k: v for k, v in params.items() if k != "numTrees"}

    def fit(tree: int) -> tuple[nodes.Trees, np.ndarray]:
        learner = RandomForestClassifier(labelCol=label, numTrees=1, featureSubsetStrategy="sqrt", seed=seed + tree, **settings)
        model = learner.fit(packed(samples.filter(F.col("tree") == tree).select("features", label)))
        return nodes.Trees.of(nodes.node_table(model, data.sparkSession)), model.featureImportances.toArray()

    return _put_together(list(range(trees)), fit, data, parallelism)
