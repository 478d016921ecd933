"""Nearest neighbours by inner product as a block matrix join.

Queries are taken in groups of a bounded number of rows, one pass over all vectors each. A task
multiplies tiles of int8 codes of the query group and of its vectors; what the codes leave over
bounds the error of every product. Pairs that the bound cannot rule out are recomputed from the
original vectors in double precision, and the best of each query are kept in a heap as wide as the
answer. The tasks' heaps are merged per query. The answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query components that one pass broadcasts (doubles), and the sides of a tile.
PASS_VALUES, TILE_QUERIES, TILE_VECTORS = 4_000_000, 1024, 2048
#: Pairs that are recomputed at a time.
PAIRS = 200_000

HITS = "array<struct<below double, vec_id bigint>>"


class Coded:
    """Vectors of one dimension with their int8 codes and what the codes leave over."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.scale = np.abs(vectors).max(axis=1) / 127
        codes = np.rint(vectors / self.scale[:, None])
        # products of codes are sums of integers: exact in single precision below 2^24
        self.codes = codes.astype(np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64)
        near = codes * self.scale[:, None]
        self.near = np.linalg.norm(near, axis=1)
        self.rest = np.linalg.norm(vectors - near, axis=1)

    def part(self, a: int, b: int) -> "Coded":
        out = object.__new__(Coded)
        for name in ("ids", "vectors", "scale", "codes", "near", "rest"):
            setattr(out, name, getattr(self, name)[a:b])
        return out


def bounds(queries: Coded, vectors: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of a tile."""
    about = (queries.codes @ vectors.codes.T).astype(np.float64) * queries.scale[:, None] * vectors.scale
    error = queries.near[:, None] * vectors.rest + queries.rest[:, None] * (vectors.near + vectors.rest)
    error += 1e-12 * (queries.near[:, None] * vectors.near)  # rounding in double precision
    return about - error, about + error


class Heaps:
    """The k best (score, id) of each query, best first; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, first: int, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        rows = np.unique(query)
        every_query = np.concatenate([np.repeat(rows, self.k), query])
        every_score = np.concatenate([self.score[first + rows].ravel(), score])
        every_id = np.concatenate([self.ids[first + rows].ravel(), ids])
        order = np.lexsort((every_id, -every_score, every_query))
        every_query = every_query[order]
        rank = np.arange(len(order)) - np.searchsorted(every_query, every_query)
        order, every_query, rank = order[rank < self.k], every_query[rank < self.k], rank[rank < self.k]
        self.score[first + every_query, rank] = every_score[order]
        self.ids[first + every_query, rank] = every_id[order]


def search_tile(queries: Coded, first: int, vectors: Coded, heaps: Heaps) -> None:
    low, high = bounds(queries, vectors)
    own = queries.ids[:, None] == vectors.ids
    low[own], high[own] = -np.inf, -np.inf
    least = heaps.score[first : first + len(queries.ids), -1]
    if low.shape[1] > heaps.k:
        least = np.maximum(least, np.partition(low, -heaps.k, axis=1)[:, -heaps.k])
    q, v = np.nonzero((high >= least[:, None]) & (high > -np.inf))
    for a in range(0, len(q), PAIRS):
        qs, vs = q[a : a + PAIRS], v[a : a + PAIRS]
        exact = np.einsum("ij,ij->i", queries.vectors[qs], vectors.vectors[vs])
        heaps.add(first, qs, exact, vectors.ids[vs])


def usable(ident: str, vector: str) -> Column:
    """Vectors that take part: with an id, not null or empty, all components finite, not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(ident).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def _matrix(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a batch, for each dimension that occurs."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(lists.value_lengths())
    first = np.cumsum(sizes) - sizes
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield ids[rows], flat[first[rows][:, None] + np.arange(d)]


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    ident: str = "vec_id",
    vector: str = "embedding",
    pass_values: int = PASS_VALUES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` largest inner products.

    Candidates are all vectors of the query's dimension but rows with the query's own id; with
    fewer than ``k`` of them, all are returned. Ties go to the smaller id; a repeated id counts
    once per row, and as a query once (with its smallest vector). Vectors that are null, empty, zero, without an id or with a
    component that is null or not finite take no part. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(ident).cast("bigint").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    ).filter(usable("id", "v"))
    found = None
    for group in _groups(rows.filter("q").groupBy("id").agg(F.min("v").alias("v")), pass_values):
        one = _pass(spark, rows.select("id", "v"), group, k)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    def best(df: DataFrame, *by: str) -> DataFrame:
        every = F.array_sort(F.flatten(F.collect_list("hits")))
        return df.groupBy(*by).agg(F.slice(every, 1, k).alias("hits"))

    merged = best(best(found, "query_id", "part"), "query_id")  # up to 64 heaps, then one of each group
    return merged.select("query_id", F.posexplode("hits").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.below")).alias("score")
    )


def _groups(queries: DataFrame, pass_values: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Query rows of a bounded number of components, as (ids, vectors) for each dimension."""
    held: dict[int, list] = {}
    size = 0

    def made() -> list:
        return [(np.array([i for i, _ in x], np.int64), np.array([v for _, v in x], np.float64)) for x in held.values()]

    for row in queries.toLocalIterator():
        held.setdefault(len(row.v), []).append((row.id, row.v))
        size += len(row.v)
        if size >= pass_values:
            yield made()
            held, size = {}, 0
    if held:
        yield made()


def _pass(spark, rows: DataFrame, group: list, k: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {v.shape[1]: (Coded(i, v), Heaps(len(i), k)) for i, v in shared.value}
        for batch in batches:
            for ids, values in _matrix(batch, 1):
                if values.shape[1] not in sides:
                    continue
                queries, heaps = sides[values.shape[1]]
                for b in range(0, len(ids), TILE_VECTORS):
                    tile = Coded(ids[b : b + TILE_VECTORS], values[b : b + TILE_VECTORS])
                    for a in range(0, len(queries.ids), TILE_QUERIES):
                        search_tile(queries.part(a, a + TILE_QUERIES), a, tile, heaps)
        for queries, heaps in sides.values():
            have = heaps.score > -np.inf
            counts = have.sum(axis=1)
            hits = pa.StructArray.from_arrays([pa.array(-heaps.score[have]), pa.array(heaps.ids[have])], ["below", "vec_id"])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.ids), pa.ListArray.from_arrays(pa.array(offsets), hits)], ["query_id", "hits"]
            )

    found = rows.mapInArrow(run, f"query_id bigint, hits {HITS}")
    return found.filter(F.size("hits") > 0).withColumn("part", F.expr("cast(spark_partition_id() div 64 as int)"))
