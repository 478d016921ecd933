"""Token counts by a two-tier lookup on the map side.

A first pass gives each partition a bounded summary of its frequent pieces of text; the summaries
are merged, so no piece is ever shuffled by key. The frequent pieces are encoded once and broadcast
as a compact hash table of lengths (at most ``table_size`` entries of about 12 bytes). The second
pass adds up lengths: first tier the broadcast table, second tier the worker's cache, and the
tokenizer library for what neither holds. The counts are right whatever the summaries hold.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces, texts_of, worker_cache
from beatgrid.llm.tokens import HashTable, PieceCoder, coder, per_text, pieces_of, vocabulary
from beatgrid.llm.words import hashes

#: Longer pieces, and pieces met less often within 2 MB of text, are not worth a place in the table.
LONGEST, OFTEN = 32, 3

Counts = dict[bytes, int]


def _pruned(counts: Counts, keep: int) -> Counts:
    """A mergeable summary of ``keep`` entries: subtract the largest count that is left out."""
    if len(counts) <= keep:
        return counts
    floor = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -keep - 1)[-keep - 1])
    return {k: v - floor for k, v in counts.items() if v > floor}


def _plus(counts: Counts, packed: bytes, keep: int) -> Counts:
    for k, v in pickle.loads(zlib.decompress(packed)):
        counts[k] = counts.get(k, 0) + v
    return _pruned(counts, keep)


def _packed(counts: Counts) -> bytes:
    return zlib.compress(pickle.dumps(sorted(counts.items())), 1)


def frequent_pieces(texts: DataFrame, text: str, size: int) -> list[bytes]:
    """At most ``size`` pieces, the frequent ones of all texts among them."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counts = {}
        for batch in batches:
            for piece in pieces(batch, 0):
                words = pieces_of(piece.column(0))
                _, at, n = np.unique(hashes(words), return_index=True, return_counts=True)
                keep = (n >= OFTEN) & (words.end[at] - words.start[at] <= LONGEST)
                for i, k in zip(at[keep].tolist(), n[keep].tolist()):
                    word = words.text(i)
                    counts[word] = counts.get(word, 0) + k
                if len(counts) > 4 * size:
                    counts = _pruned(counts, 2 * size)
        yield pa.RecordBatch.from_pydict({"summary": pa.array([_packed(_pruned(counts, size))], pa.binary())})

    def merged(key: tuple, group: pa.Table) -> pa.Table:
        counts: Counts = {}
        for x in group.column("summary"):
            counts = _plus(counts, x.as_py(), size)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "summary": pa.array([_packed(counts)], pa.binary())})

    found = texts.select(text).mapInArrow(summary, "summary binary").withColumn("part", F.spark_partition_id())
    for _ in range(2):  # a group holds 64 summaries
        found = found.withColumn("part", F.expr("cast(part div 64 as int)"))
        found = found.groupBy("part").applyInArrow(merged, "part int, summary binary")
    total: Counts = {}
    for row in found.select("summary").toLocalIterator():
        total = _plus(total, bytes(row.summary), size)
    return sorted(total)


def count_tokens(
    docs: DataFrame,
    tokenizer: str | None = None,
    ident: str = "doc_id",
    text: str = "text",
    limit: int = 2048,
    table_size: int = 65_536,
) -> DataFrame:
    """(ident, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are kept; other
    columns are not read, whatever their names. An empty table gives an empty table. Texts of any
    length are counted whole. For a ``.model`` file white space matters, so whole texts are encoded
    by sentencepiece and there is no table.
    """
    path = tokenizer or vocabulary()
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    if path.endswith(".model"):
        count = _whole_texts(path)
    else:
        common = pieces_of(pa.array([x.decode() for x in frequent_pieces(rows, "text", table_size)], pa.large_string()))
        keys = hashes(common) | np.uint64(1)
        lengths = PieceCoder(path).lengths(common, keys).astype(np.uint16)
        count = _two_tiers(path, docs.sparkSession.sparkContext.broadcast((keys.tobytes(), lengths.tobytes())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = count()
        for batch in batches:
            for piece in pieces(batch):
                n_bytes = pc.fill_null(pc.binary_length(piece.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), n_bytes, pa.array(handle(piece.column(1)), pa.int64())], ["ident", "n_bytes", "n_tokens"]
                )

    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(run, f"ident {kind}, n_bytes bigint, n_tokens bigint").select(
        F.col("ident").alias(ident), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _two_tiers(path, shared):
    """The lookup of a task; the hash table stays with the worker."""
    name = uuid.uuid4().hex

    def make():
        tables = worker_cache("token counts", ("tokens",))
        if name not in tables:
            tables.clear()
            keys, lengths = (np.frombuffer(x, kind) for x, kind in zip(shared.value, (np.uint64, np.uint16)))
            table = HashTable(max(1, len(keys)))
            keys, at = np.unique(keys, return_index=True)
            table.add(keys)
            tables[name] = table, lengths[at].astype(np.int64)
        table, known = tables[name]
        second = coder(path)

        def handle(texts: pa.Array) -> np.ndarray:
            words = pieces_of(texts)
            keys = hashes(words) | np.uint64(1)
            place = table.find(keys)
            found = np.zeros(len(keys), np.int64)
            found[place >= 0] = known[place[place >= 0]]
            miss = np.flatnonzero(place < 0)
            found[miss] = second.lengths(words.only(miss), keys[miss])
            return per_text(found, words)

        return handle

    return make


def _whole_texts(path):
    def make():
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)

        def handle(texts: pa.Array) -> np.ndarray:
            batch = pa.RecordBatch.from_arrays([texts], ["text"])
            return np.array([len(x) for x in library.encode(texts_of(batch, 0), num_threads=1)], np.int64)

        return handle

    return make
