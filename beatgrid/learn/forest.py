"""Random forests grown by tasks, for searches over tables whose trees the driver should not hold.

Spark grows every tree of a forest on the driver. Here a task grows a tree from its rows by Spark's rules:
values in at most ``maxBins`` bins, cut as Spark cuts them from a sample of its size; Poisson weights of the
rows; features drawn for each node; the first split of highest gain; no split of a node with one class,
without gain or at the depth limit. Only the random numbers differ. A node with more than ``TASK_ROWS`` rows
is split by all tasks together from sums by bin, one job a level, so no task holds more rows than that.

The trees are written to staged files and held rows walk down them a tree at a time; the driver sees the
splits of such large nodes and one row of counts a candidate. One tree must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.learn.nodes import Trees, _matrix
from beatgrid.llm.store import random_access
from beatgrid.sources.files import discard, materialised

#: Rows, counted as often as they are drawn, that one task grows a tree or part of one from.
TASK_ROWS = 1_000_000
#: (row, tree) pairs that a task should have, and sums of votes of the held rows that walk down a tree together.
_TASK_PAIRS, _HELD_SUMS = 2_000_000, 2_000_000
#: Sums of a level that are held at a time.
_SUMS = 1 << 18

_TREE_SCHEMA = "tree int, node int, feature binary, cut binary, counts binary"


@dataclass(frozen=True)
class Growth:
    """How a forest grows; ``features`` is the number drawn for a node, ``rate`` the expected draws of a row."""

    trees: int
    depth: int
    min_rows: float
    min_gain: float
    impurity: str
    features: int
    bootstrap: bool
    rate: float
    seed: int

    @staticmethod
    def of(settings: dict, n_features: int, n_rows: int, seed: int) -> "Growth":
        """From the values of a Spark forest's parameters by name."""
        how, n = settings["featureSubsetStrategy"], n_features
        if how == "auto":
            how = "sqrt" if settings["numTrees"] > 1 else "all"
        named = {"all": n, "sqrt": np.ceil(np.sqrt(n)), "log2": max(1, np.ceil(np.log2(n))), "onethird": np.ceil(n / 3)}
        drawn = named[how] if how in named else min(int(how), n) if how.isdigit() else np.ceil(float(how) * n)
        return Growth(
            settings["numTrees"], settings["maxDepth"], max(settings["minInstancesPerNode"], settings["minWeightFractionPerNode"] * n_rows), settings["minInfoGain"],
            settings["impurity"], int(drawn), settings["bootstrap"], settings["subsamplingRate"], seed,
        )


@dataclass
class Binned:
    """The rows that forests are grown from: staged blocks of bins, and the cuts between the bins by feature."""

    blocks: DataFrame
    cuts: list[np.ndarray]
    classes: int
    n_rows: int

    @property
    def files(self) -> list[str]:
        return sorted(self.blocks.staged_files)


def cut_points(values: np.ndarray, n_rows: int, max_bins: int) -> np.ndarray:
    """Spark's cuts of one feature: halfway between all values if they are few, else near equal shares of the rows."""
    most = min(max_bins, n_rows) - 1
    distinct, n = np.unique(values, return_counts=True)
    middle = distinct[:-1] + (distinct[1:] - distinct[:-1]) / 2
    if len(middle) <= most:
        return middle
    stride, upto = len(values) / (most + 1), np.cumsum(n)
    target, out = stride, []
    for k in range(1, len(distinct)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out)


def in_bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value; a value up to the k-th cut has a bin up to k."""
    kind = np.min_scalar_type(max(map(len, cuts), default=0))
    return np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(kind)


def binned(fit: DataFrame, label: str, n_features: int, max_bins: int, seed: int, vector: str = "features") -> Binned:
    """Stage a table of vectors and labels for growth. Labels are whole numbers from 0 up."""
    y = F.col(label).cast("double")
    n, most, bad = fit.agg(F.count("*"), F.max(y), F.count_if(y.isNull() | (y < 0) | (y != F.floor(y)))).first()
    if not n:
        raise ValueError("there are no rows to grow a forest from")
    if bad:
        raise ValueError(f"{bad} rows have no whole number from 0 up as {label}")
    needed = max(max_bins**2, 10_000)  # as many as Spark looks at
    some = fit if n <= needed else fit.sample(False, needed / n, seed)
    seen = some.select(vector_to_array(vector).alias("x")).toArrow().combine_chunks()
    values = _matrix(seen.to_batches()[0], 0) if seen.num_rows else np.zeros((0, n_features))  # bounded by the sample's size
    cuts = [cut_points(values[:, j], n, max_bins) for j in range(n_features)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
                row = {"first": [first], "x": [in_bins(_matrix(batch, 0), cuts).tobytes()], "y": [y.tobytes()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("first", pa.int64()), ("x", pa.binary()), ("y", pa.binary())]))
                first += batch.num_rows

    rows = fit.select(vector_to_array(vector).alias("_x"), F.col(label).cast("int").alias("y"))
    return Binned(materialised(rows.mapInArrow(run, "first bigint, x binary, y binary"), "bins"), cuts, int(most) + 1, n)


def _rows_of(file: str, columns: Sequence[str]) -> Iterator[dict]:
    with random_access(file) as source:
        for batch in pq.ParquetFile(source).iter_batches(batch_size=16, columns=list(columns)):
            yield from batch.to_pylist()


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def drawn(first: int, n: int, tree: int, g: Growth) -> np.ndarray:
    """How often rows ``first`` to ``first + n`` are drawn for a tree."""
    if not g.bootstrap and g.rate >= 1:
        return np.ones(n, np.int32)
    salt = _mixed(np.array([g.seed * 1_000_003 + tree], np.uint64))
    z = _mixed(_mixed(np.arange(first, first + n, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ salt)
    u = (z >> np.uint64(11)).astype(np.float64) / 2.0**53
    if not g.bootstrap:
        return (u < g.rate).astype(np.int32)
    chance = np.exp(-g.rate) * np.cumprod(np.concatenate([[1.0], g.rate / np.arange(1, 40)]))
    return np.searchsorted(np.cumsum(chance), u, side="right").astype(np.int32)


def _impurity(counts: np.ndarray, total: np.ndarray, kind: str) -> np.ndarray:
    out = np.ones_like(total) if kind == "gini" else np.zeros_like(total)
    for c in range(counts.shape[-1]):
        p = counts[..., c] / total
        out -= p * p if kind == "gini" else p * (np.log(np.where(p > 0, p, 1.0)) / np.log(2))
    return out


def best_splits(sums: np.ndarray, g: Growth) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, last bin that goes left, class counts on the left) of each node from its (node, bin, class) sums of one feature."""
    left = np.cumsum(sums, axis=1)
    whole = left[:, -1]
    left = left[:, :-1]
    n = whole.sum(axis=1)[:, None]
    low = left.sum(axis=2)
    high = n - low
    sound = (low >= g.min_rows) & (high >= g.min_rows) & (low > 0) & (high > 0)
    a, b = np.where(sound, low, 1.0), np.where(sound, high, 1.0)
    gain = _impurity(whole, n[:, 0], g.impurity)[:, None] - low / n * _impurity(left, a, g.impurity) - high / n * _impurity(whole[:, None] - left, b, g.impurity)
    gain = np.where(sound & (gain >= g.min_gain), gain, -np.inf)
    at = gain.argmax(axis=1)
    every = np.arange(len(at))
    return gain[every, at], at, left[every, at]


def _features(rng: np.random.Generator, n: int, width: int, g: Growth) -> np.ndarray:
    if g.features >= width:
        return np.tile(np.arange(width), (n, 1))
    return rng.random((n, width)).argsort(axis=1)[:, : g.features]


def grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, g: Growth, classes: int, bins: int, level: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """(feature, cut, class counts) of the nodes of one tree over these rows, its root at ``level``.

    The nodes come level by level, the two below the k-th split at 2 k + 1 and 2 k + 2. Rows are kept in the order of their nodes.
    """
    width, flat, cell = x.shape[1], x.ravel(), bins * classes
    rows = np.flatnonzero(w)
    counts = np.bincount(y[rows], w[rows], classes)[None]
    sizes = np.array([len(rows)])
    out: list[tuple[np.ndarray, ...]] = []
    while len(counts):
        open_ = np.flatnonzero(counts.max(axis=1) < counts.sum(axis=1)) if level < g.depth else np.zeros(0, int)
        if len(open_) < len(counts):
            keep = np.zeros(len(counts), bool)
            keep[open_] = True
            rows, sizes = rows[np.repeat(keep, sizes)], sizes[open_]
        m = len(open_)
        gain, feature, cut, below = np.zeros(m), np.full(m, -1), np.zeros(m, int), np.zeros((m, classes))
        tried = _features(rng, m, width, g)
        ends = np.cumsum(sizes)
        step = max(1, _SUMS // cell)
        for low in range(0, m, step):
            high = min(m, low + step)
            part = rows[ends[low] - sizes[low] : ends[high - 1]]
            key, base, weight = np.repeat(np.arange(high - low) * cell, sizes[low:high]) + y[part], part * width, w[part]
            for j in range(tried.shape[1]):
                f = tried[low:high, j]
                at = flat[base + np.repeat(f, sizes[low:high])].astype(np.int64)
                found = best_splits(np.bincount(key + at * classes, weight, (high - low) * cell).reshape(high - low, bins, classes), g)
                better = np.flatnonzero(found[0] > gain[low:high])
                gain[low + better], feature[low + better], cut[low + better], below[low + better] = found[0][better], f[better], found[1][better], found[2][better]
        split = gain > 0
        node_feature, node_cut = np.full(len(counts), -1), np.zeros(len(counts), int)
        node_feature[open_[split]], node_cut[open_[split]] = feature[split], cut[split]
        out.append((node_feature, node_cut, counts))
        whole, below = counts[open_[split]], below[split]
        counts, level = np.stack([below, whole - below], axis=1).reshape(-1, classes), level + 1
        rows, sizes = rows[np.repeat(split, sizes)], sizes[split]
        if not len(rows):
            continue
        left = flat[rows * width + np.repeat(feature[split], sizes)] <= np.repeat(cut[split], sizes)
        first = np.cumsum(sizes) - sizes
        n_left = np.add.reduceat(left, first, dtype=np.int64)
        place = np.cumsum(left)
        place -= np.repeat(place[first] - left[first], sizes)  # rows of the node that went left so far
        start = np.repeat(first, sizes)
        target = np.where(left, start + place - 1, np.repeat(n_left, sizes) + np.arange(len(rows)) - place)
        sorted_rows = np.empty_like(rows)
        sorted_rows[target] = rows
        rows, sizes = sorted_rows, np.stack([n_left, sizes - n_left], axis=1).ravel()
    return tuple(np.concatenate(part) for part in zip(*out))


@dataclass
class Top:
    """The upper part of a tree, whose nodes all tasks split together; children are positions, ``left`` and the one after it."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    counts: list[list[float]]
    level: list[int]
    #: Nodes that tasks grow on by themselves.
    open_: list[int]

    def walk(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left = (np.array(a) for a in (self.feature, self.cut, self.left))
        at = np.zeros(len(x), int)
        going = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, int)
        while len(going):
            node = at[going]
            at[going] = left[node] + (x[going, feature[node]] > cut[node])
            going = going[feature[at[going]] >= 0]
        return at

    def with_parts(self, parts: dict[int, tuple[np.ndarray, ...]], classes: int) -> tuple[np.ndarray, ...]:
        """(feature, cut, class counts) of the whole tree, in the order of ``grown``."""
        feature, cut, left = [np.array(self.feature)], [np.array(self.cut)], [np.array(self.left)]
        counts, base = [np.array(self.counts, float).reshape(-1, classes)], len(self.feature)
        for node, (f, c, n) in sorted(parts.items()):
            below = np.where(f >= 0, 2 * np.cumsum(f >= 0) - 1 + base, -1)
            feature[0][node], cut[0][node], left[0][node], counts[0][node] = f[0], c[0], below[0], n[0]
            feature, cut, left, counts, base = [*feature, f], [*cut, c], [*left, below], [*counts, n], base + len(f)
        feature, cut, left, counts = map(np.concatenate, (feature, cut, left, counts))
        order, level = [], np.zeros(1, int)
        while len(level):
            order.append(level)
            under = left[level[feature[level] >= 0]]
            level = np.stack([under, under + 1], axis=1).ravel()
        order = np.concatenate(order)
        return feature[order], cut[order], counts[order]


def _blocks(files: Sequence[str], width: int, kind: np.dtype) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for file in files:
        for r in _rows_of(file, ("first", "x", "y")):
            yield r["first"], np.frombuffer(r["x"], kind).reshape(-1, width), np.frombuffer(r["y"], np.int32)


def _kind(cuts: Sequence[np.ndarray]) -> tuple[np.dtype, int]:
    most = max(map(len, cuts), default=0)
    return np.min_scalar_type(most), most + 1


def _tops(spark: SparkSession, rows: Binned, g: Growth) -> dict[int, Top]:
    """The upper part of each tree, down to nodes that a task can grow from; just its root if that is one."""
    tops = {t: Top([-1], [0], [-1], [[0.0] * rows.classes], [0], [0]) for t in range(g.trees)}
    if rows.n_rows <= TASK_ROWS:
        return tops
    files, cuts, classes, width = rows.files, rows.cuts, rows.classes, len(rows.cuts)
    kind, bins = _kind(cuts)
    large = {t: [0] for t in tops}
    for t in tops.values():
        t.open_ = []
    while large:

        def summed(batches: Iterator[pa.RecordBatch], large=large) -> Iterator[pa.RecordBatch]:
            sums = {t: np.zeros((len(nodes), width, bins, classes)) for t, nodes in large.items()}
            for batch in batches:
                for first, x, y in _blocks([files[i] for i in batch.column(0).to_pylist()], width, kind):
                    for t, nodes in large.items():
                        w = drawn(first, len(x), t, g)
                        at = tops[t].walk(x)
                        for k, node in enumerate(nodes):
                            own = np.flatnonzero((at == node) & (w > 0))
                            for j in range(width):
                                sums[t][k, j] += np.bincount(x[own, j].astype(np.int64) * classes + y[own], w[own], bins * classes).reshape(bins, classes)
            for t, nodes in large.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()), pa.array([s.tobytes() for s in sums[t]], pa.binary())], names=["tree", "node", "sums"]
                )

        def chosen(key: tuple, parts: pa.Table) -> pa.Table:
            tree, node = (k.as_py() for k in key)
            sums = np.zeros(width * bins * classes)
            for part in parts.column("sums"):
                sums += np.frombuffer(part.as_py())
            sums = sums.reshape(width, bins, classes)
            best = (0.0, -1, 0, np.zeros(classes))
            for f in _features(np.random.default_rng([g.seed, tree, node, 1]), 1, width, g)[0]:
                gain, at, left = (v[0] for v in best_splits(sums[f : f + 1], g))
                best = (gain, f, at, left) if gain > best[0] else best
            return pa.table({"tree": [tree], "node": [node], "feature": [int(best[1])], "cut": [int(best[2])], "whole": [sums[0].sum(axis=0).tolist()], "below": [best[3].tolist()]})

        found = spark.range(0, len(files), 1, len(files)).mapInArrow(summed, "tree int, node int, sums binary").groupBy("tree", "node")
        found = found.applyInArrow(chosen, "tree long, node long, feature long, cut long, whole array<double>, below array<double>").collect()  # a row a large node
        large = {}
        for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
            t, node = tops[r["tree"]], r["node"]
            t.counts[node] = r["whole"]
            if r["feature"] < 0:
                continue
            t.feature[node], t.cut[node], t.left[node] = r["feature"], r["cut"], len(t.feature)
            for counts in (r["below"], [a - b for a, b in zip(r["whole"], r["below"])]):
                new, level = len(t.feature), t.level[node] + 1
                t.feature.append(-1), t.cut.append(0), t.left.append(-1), t.counts.append(counts), t.level.append(level)
                if max(counts) == sum(counts) or level >= g.depth:
                    continue
                if sum(counts) > TASK_ROWS:
                    large.setdefault(r["tree"], []).append(new)
                else:
                    t.open_.append(new)
    return tops


def _work(tops: dict[int, Top]) -> list[tuple[int, list[int]]]:
    """(tree, nodes to grow on) of each piece of work, of at most ``TASK_ROWS`` rows; every tree has one at least."""
    out = []
    for tree, top in tops.items():
        out.append((tree, []))
        n = 0.0
        for node in top.open_:
            n += sum(top.counts[node])
            if n > TASK_ROWS and out[-1][1]:
                out.append((tree, []))
                n = sum(top.counts[node])
            out[-1][1].append(node)
    return out


def _packed(tree: int, node: int, parts: Sequence[np.ndarray]) -> pa.RecordBatch:
    """A tree or part of one as a row of ``_TREE_SCHEMA``."""
    kinds = (np.int16, np.int16, np.int32)
    values = [pa.array([tree], pa.int32()), pa.array([node], pa.int32()), *[pa.array([np.ascontiguousarray(a.astype(k)).tobytes()], pa.binary()) for a, k in zip(parts, kinds)]]
    return pa.RecordBatch.from_arrays(values, names=["tree", "node", "feature", "cut", "counts"])


def _unpacked(row: dict, classes: int) -> tuple[np.ndarray, ...]:
    feature, cut = (np.frombuffer(row[c], np.int16).astype(np.int64) for c in ("feature", "cut"))
    return feature, cut, np.frombuffer(row["counts"], np.int32).reshape(-1, classes).astype(np.float64)


def grow(spark: SparkSession, rows: Binned, g: Growth) -> DataFrame:
    """The trees of a forest, one staged row each."""
    tops = _tops(spark, rows, g)
    work = _work(tops)
    files, cuts, classes, width = rows.files, rows.cuts, rows.classes, len(rows.cuts)
    kind, bins = _kind(cuts)
    split = any(t.feature[0] >= 0 or not t.open_ for t in tops.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for i in (i for batch in batches for i in batch.column(0).to_pylist()):
            tree, nodes = work[i]
            if not split:  # all rows are kept for the next tree
                whole = whole or [(first, x, y) for first, x, y in _blocks(files, width, kind)]
            kept = []
            for first, x, y in whole or (_blocks(files, width, kind) if nodes else ()):
                w = drawn(first, len(x), tree, g)
                at = tops[tree].walk(x) if split else np.zeros(len(x), int)
                own = np.flatnonzero((w > 0) & np.isin(at, nodes))
                kept.append((x[own], y[own], w[own], at[own]))
            x, y, w, at = map(np.concatenate, zip(*kept)) if kept else (np.zeros((0, width), kind), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, int))
            for node in nodes:
                own = at == node
                level, rng = tops[tree].level[node], np.random.default_rng([g.seed, tree, node])
                yield _packed(tree, node, grown(x[own], y[own], w[own], g, classes, bins, level, rng))
            if not nodes:
                yield _packed(tree, -1, [np.zeros(0)] * 3)

    def joined(key: tuple, parts: pa.Table) -> pa.Table:
        (tree,) = (k.as_py() for k in key)
        given = {r["node"]: _unpacked(r, classes) for r in parts.to_pylist() if r["node"] >= 0}
        return pa.Table.from_batches([_packed(tree, 0, tops[tree].with_parts(given, classes))])

    pairs = sum(min(rows.n_rows, TASK_ROWS) for _ in work)
    tasks = min(len(work), max(spark.sparkContext.defaultParallelism, pairs // _TASK_PAIRS))
    made = spark.range(0, len(work), 1, tasks).mapInArrow(run, _TREE_SCHEMA)
    if not split:
        return materialised(made, "trees")
    parts = materialised(made, "parts")
    trees = materialised(parts.groupBy("tree").applyInArrow(joined, _TREE_SCHEMA), "trees")
    discard(parts)
    return trees


def tree_of(feature: np.ndarray, cut: np.ndarray, counts: np.ndarray) -> Trees:
    """One tree over bins; ``threshold`` is the last bin that goes left."""
    inner = feature >= 0
    left = np.where(inner, 2 * np.cumsum(inner) - 1, -1)
    depth, level, k = np.zeros(len(feature), np.int32), np.zeros(1, int), 0
    while len(level):
        depth[level] = k
        under = left[level[inner[level]]]
        level, k = np.concatenate([under, under + 1]), k + 1
    total = counts.sum(axis=1, keepdims=True)
    value = np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)
    return Trees(feature, cut, left, np.where(inner, left + 1, -1), counts.argmax(axis=1), value, np.zeros(1, int), np.ones(1), depth, False)


def votes(trees: DataFrame, held: DataFrame, label: str, rows: Binned, counts: Sequence[int], depths: Sequence[int], vector: str = "features") -> DataFrame:
    """(label, raw) of each row as ``nodes.with_votes`` gives them, with a part up to each of ``counts`` (ascending, as ``depths``)."""
    files, cuts, classes = sorted(trees.staged_files), rows.cuts, rows.classes

    each = len(depths) * len(counts) * classes
    most = max(1, _HELD_SUMS // each)

    def voted(x: np.ndarray, y: pa.Array) -> pa.RecordBatch:
        raw = np.zeros((len(x), len(depths), len(counts), classes))
        for file in files:
            for r in _rows_of(file, ("tree", "feature", "cut", "counts")):
                tree, part = tree_of(*_unpacked(r, classes)), int(np.searchsorted(counts, r["tree"], side="right"))
                if part < len(counts):
                    for d, ends in enumerate(tree.ends(x, [tree.stops(limit) for limit in depths])):
                        raw[:, d, part] += tree.value[ends[:, 0]]
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * each), pa.array(raw.ravel()))
        return pa.RecordBatch.from_arrays([y, sums], names=[label, "raw"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, pa.Array]] = []
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                if kept and sum(len(x) for x, _ in kept) + part.num_rows > most:
                    yield voted(np.concatenate([x for x, _ in kept]), pa.concat_arrays([y for _, y in kept]))
                    kept = []
                kept.append((in_bins(_matrix(part, 0), cuts), part.column(1)))
        if kept:
            yield voted(np.concatenate([x for x, _ in kept]), pa.concat_arrays([y for _, y in kept]))

    given = held.select(vector_to_array(vector).alias("_x"), F.col(label).cast("int").alias(label))
    return given.mapInArrow(run, f"`{label}` int, raw array<double>")
