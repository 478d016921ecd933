"""Packing documents into sequences by vector best-fit.

A piece of a document needs tokens, one document slot and attention cost (its length squared).
What a piece needs follows from its length, so the plan is made on counted lengths, of which there
are no more than ``max_tokens``, and covers the whole corpus: longest pieces first, each into the
open sequence that the score selects among those where every residual capacity suffices. Sequences
of equal content are one class with a count, so the plan's size doesn't depend on the number of
rows. Pieces are then numbered within their length, spread over buckets, and look their place up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces as text_pieces
from beatgrid.llm.tokens import coder, vocabulary
from beatgrid.sources.files import materialised

#: Texts are encoded in pieces of about this many bytes, which bounds what a worker holds beside its tables.
PIECE_BYTES = 500_000
#: Rows that one numbering bucket is meant to hold.
BUCKET_ROWS = 1_000_000


@dataclass
class Capacity:
    """What a sequence holds, and how its residual capacities are weighed."""

    tokens: int = 2048
    docs: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    score: str = "norm"

    def whole(self) -> np.ndarray:
        return np.array([self.tokens, self.docs, self.cost], np.int64)


@dataclass
class _Classes:
    """Open sequences by content: residual capacities, number of sequences, runs (length, copies)."""

    left: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), np.int64))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    runs: list[tuple] = field(default_factory=list)

    def add(self, left: np.ndarray, count: int, runs: tuple) -> None:
        self.left = np.vstack([self.left, left])
        self.count = np.append(self.count, count)
        self.runs.append(runs)

    def put(self, k: int, need: np.ndarray, length: int, bins: int, copies: int) -> None:
        """Give ``copies`` pieces to ``bins`` sequences of class ``k``; the others stay as they are."""
        left, runs = self.left[k] - copies * need, self.runs[k] + ((length, copies),)
        if bins == self.count[k]:
            self.left[k], self.runs[k] = left, runs
        else:
            self.count[k] -= bins
            self.add(left, bins, runs)


def _best(classes: _Classes, need: np.ndarray, capacity: Capacity) -> int:
    """The class that the score selects, or -1 when the piece fits in no open sequence."""
    fits = np.flatnonzero((classes.left >= need).all(axis=1))
    if not len(fits):
        return -1
    whole, weights = capacity.whole().astype(float), np.array(capacity.weights)
    left = classes.left[fits] / whole
    if capacity.score == "norm":  # least weighted norm of what would be left
        value = (weights * (left - need / whole) ** 2).sum(axis=1)
    elif capacity.score == "dot":  # least weighted product of the need with the free space
        value = (weights * (need / whole) * left).sum(axis=1)
    else:
        raise ValueError(f"unknown score: {capacity.score}")
    return int(fits[np.argmin(value)])


def plan(lengths: dict[int, int], capacity: Capacity) -> np.ndarray:
    """Rows (length, first rank, ranks, first sequence, copies, offset), ordered by length and rank.

    A piece of rank r in its length, with i = r - first rank, goes to sequence
    first + i // copies, at offset + (i % copies) * length.
    """
    classes, whole = _Classes(), capacity.whole()
    for length in sorted(lengths, reverse=True):
        need, todo = np.array([length, 1, length * length], np.int64), int(lengths[length])
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of an empty sequence")
        while todo:
            k = _best(classes, need, capacity)
            if k < 0:
                copies = int((whole // need).min())
                bins = max(1, todo // copies)
                copies = min(copies, todo)
                classes.add(whole - copies * need, bins, ((length, copies),))
                todo -= bins * copies
                continue
            copies = min(int((classes.left[k] // need).min()), todo)
            bins = min(int(classes.count[k]), todo // copies)
            classes.put(k, need, length, bins, copies)
            todo -= bins * copies
    rows, rank, sequence = [], dict.fromkeys(lengths, 0), 0
    for count, runs in zip(classes.count.tolist(), classes.runs):
        offset = 0
        for length, copies in runs:
            rows.append((length, rank[length], count * copies, sequence, copies, offset))
            rank[length] += count * copies
            offset += copies * length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def cut(
    docs: DataFrame,
    tokenizer: str | None = None,
    ident: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    max_tokens: int = 2048,
    keep_ids: bool = False,
) -> DataFrame:
    """(ident, piece, start, length, ids_crc32[, ids]): each document's ids with the end id, cut only
    where they exceed ``max_tokens``. Null texts are empty: one piece that holds the end id."""
    path = tokenizer or vocabulary()
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = coder(path)
        for batch in batches:
            for part in text_pieces(batch, limit=PIECE_BYTES):
                ids, counts = codes.encode(part.column(1))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                n = -(-counts // max_tokens)
                row = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * max_tokens
                length = np.minimum(max_tokens, counts[row] - start)
                first = (np.cumsum(counts) - counts)[row] + start
                spans = list(zip(first.tolist(), (first + length).tolist()))
                columns = [
                    part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32), pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in spans], pa.int64()),
                ]
                names = ["ident", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"ident {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("ident", ident)


def pack(pieces: DataFrame, order: list[str], capacity: Capacity | None = None, length: str = "length") -> DataFrame:
    """``pieces`` (staged; read twice) with sequence_id and offset.

    ``order`` numbers pieces of one length; rows equal in it are interchangeable. Every row is
    placed; within a sequence the pieces lie one after the other from 0. An empty table stays so.
    """
    capacity = capacity or Capacity()
    counted = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most max_tokens rows
    rows = plan(counted, capacity)
    buckets = max(64, -(-sum(counted.values()) // BUCKET_ROWS))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy(length, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_bucket")
    sizes = sizes.withColumn("_first", F.sum("_n").over(before) - F.col("_n")).drop("_n")
    inside = Window.partitionBy(length, "_bucket").orderBy(*order)
    ranked = (
        spread.withColumn("_row", F.row_number().over(inside))
        .join(sizes, [length, "_bucket"])
        .withColumn("_rank", F.col("_first") + F.col("_row") - 1)
        .drop("_first", "_row", "_bucket")
    )
    plan_rows = pieces.sparkSession.sparkContext.broadcast(rows)
    ranked = ranked.select(*pieces.columns, "_rank")
    at, width = len(pieces.columns), pieces.columns.index(length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan_rows.value
        key = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            size = batch.column(width).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            found = table[np.searchsorted(key, size << 44 | rank, side="right") - 1]
            i = rank - found[:, 1]
            names = batch.schema.names[:at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(found[:, 3] + i // found[:, 4], pa.int64()), pa.array(found[:, 5] + i % found[:, 4] * size, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: Capacity | None = None, ident: str = "doc_id", **options) -> DataFrame:
    """Cut, then pack: one row a piece."""
    capacity = capacity or Capacity()
    pieces = materialised(cut(docs, ident=ident, max_tokens=capacity.tokens, **options), "pieces")
    return pack(pieces, [ident, "piece", "ids_crc32"], capacity)
