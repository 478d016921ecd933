"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in pieces of about this many bytes, which bounds the numpy temporaries.
PIECE_BYTES = 2_000_000
#: Rows of a staged table that are worth a task of their own.
TASK_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str, beside: tuple[str, ...] = ()) -> dict:
    """What a worker keeps from task to task for one operator. Python workers outlive a query, so the
    caches of all other operators, but those named in ``beside``, are given up."""
    for name in list(_CACHES):
        if name != owner and name not in beside:
            _CACHES.pop(name).clear()
            pa.default_memory_pool().release_unused()
    return _CACHES.setdefault(owner, {})


def pieces(batch: pa.RecordBatch, text: int = 1, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (column ``text``) hold about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def by_piece(
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], text: int = 1
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: ``make()`` runs once a task and gives what handles a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = make()
        for batch in batches:
            for piece in pieces(batch, text):
                yield handle(piece)

    return run


def texts_of(batch: pa.RecordBatch, column: int = 1) -> list[str]:
    """The texts as Python strings, null as empty."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "").to_pylist()


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows at most, in tasks of at least TASK_ROWS; never in more tasks than before."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def join_unique(
    left: DataFrame, right: DataFrame, on: str, count: str, how: str = "left", total: int | None = None, hot: int = 1024
) -> DataFrame:
    """Join to a table with one row per key and the key's number of left rows in ``count``.

    A key with more than a ``hot``-th of all those rows (``total``, summed if not given) is joined by
    broadcast: there are fewer than ``hot`` such keys at any size. The other keys are shuffled and
    none of them is large. ``right`` is read more than once, so it should be staged. Null keys match
    nothing.
    """
    if total is None:
        total = right.agg(F.sum(count)).first()[0] or 0
    heavy = right.filter(F.col(count) > F.lit(total // hot)).limit(hot)
    light = right.filter(F.col(count) <= F.lit(total // hot))
    marked = left.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), on, "left")
    first = marked.filter("_hot").drop("_hot")
    rest = marked.filter(F.col("_hot").isNull()).select(left.columns).join(light, on, how)
    return first.unionByName(rest)
