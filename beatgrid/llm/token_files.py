"""Token ids of whole documents as binary shard files in Simple-8b blocks.

A shard file holds the ids of consecutive documents, in ascending order of their id:

* magic, block size (8 + 8 bytes)
* the blocks' words, little-endian
* footer: word offset of each block, then id, null flag and number of ids of each document
* trailer: number of blocks, of documents and of ids, place of the footer, magic (5 x 8 bytes)

Documents are range-partitioned by id in Spark; a partition writes one shard after the other and
never holds more than a shard's footer and a few blocks. The manifest, one row a file, is a table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces
from beatgrid.llm.simple8b import decode_block, encode_block
from beatgrid.llm.store import random_access, written
from beatgrid.llm.tokens import coder, vocabulary
from beatgrid.sources.files import materialised, scratch_path

MAGIC = b"S8BTOK01"
BLOCK = 4096
#: Blocks that a reader decodes at a time.
READ_BLOCKS = 256

MANIFEST = "path string, part int, shard int, n_docs bigint, n_ids bigint, n_bytes bigint"


class ShardWriter:
    """Ids in, blocks out; the tables follow at the end."""

    def __init__(self, out, block: int = BLOCK):
        self.out, self.block = out, block
        self.out.write(MAGIC + np.array([block], "<u8").tobytes())
        self.offsets: list[int] = []
        self.words = 0
        self.left = np.zeros(0, np.uint32)
        self.n_ids = 0
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _write(self, block: np.ndarray) -> None:
        words = encode_block(block)
        self.offsets.append(self.words)
        self.words += len(words)
        self.out.write(words.astype("<u8").tobytes())

    def add(self, ident: np.ndarray, null: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((ident, null, counts))
        self.n_ids += len(ids)
        ids = np.concatenate([self.left, ids])
        whole = len(ids) - len(ids) % self.block
        for i in range(0, whole, self.block):
            self._write(ids[i : i + self.block])
        self.left = ids[whole:]

    def close(self) -> tuple[int, int, int]:
        """Number of documents, ids and bytes."""
        if len(self.left):
            self._write(self.left)
        ident, null, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*self.docs) if self.docs else ((), (), ())))
        body = 16 + 8 * self.words
        footer = np.array(self.offsets, "<u8").tobytes() + ident.astype("<i8").tobytes() + null.astype("u1").tobytes() + counts.astype("<i8").tobytes()
        self.out.write(footer + np.array([len(self.offsets), len(ident), self.n_ids, body], "<u8").tobytes() + MAGIC)
        return len(ident), self.n_ids, body + len(footer) + 40


class ShardReader:
    def __init__(self, source):
        self.source = source
        end = source.size()
        tail = source.read_at(40, end - 40)
        if tail[32:] != MAGIC:
            raise ValueError("not a shard of token ids")
        n_blocks, n_docs, self.n_ids, body = (int(x) for x in np.frombuffer(tail[:32], "<u8"))
        footer = source.read_at(end - 40 - body, body)
        self.offsets = np.append(np.frombuffer(footer, "<u8", n_blocks), (body - 16) // 8).astype(np.int64)
        at = 8 * n_blocks
        self.ident = np.frombuffer(footer, "<i8", n_docs, at)
        self.null = np.frombuffer(footer, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(footer, "<i8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.block = int(np.frombuffer(source.read_at(16, 0)[8:], "<u8")[0])

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from place ``first`` to before ``last``, by the blocks that hold them."""
        a, b = first // self.block, -(-last // self.block)
        if last <= first:
            return np.zeros(0, np.uint32)
        raw = self.source.read_at(int(8 * (self.offsets[b] - self.offsets[a])), int(16 + 8 * self.offsets[a]))
        words, base = np.frombuffer(raw, "<u8").astype(np.uint64), self.offsets[a]
        out = [
            decode_block(words[self.offsets[k] - base : self.offsets[k + 1] - base], min(self.block, self.n_ids - k * self.block))
            for k in range(a, b)
        ]
        return np.concatenate(out)[first - a * self.block : last - a * self.block].astype(np.uint32)

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each document in turn, reading some blocks ahead."""
        ends = np.cumsum(self.counts)
        low, held = 0, np.zeros(0, np.uint32)
        for row, (n, end) in enumerate(zip(self.counts.tolist(), ends.tolist())):
            if end > low + len(held):
                keep = held[end - n - low :]
                low = end - n
                upto = min(self.n_ids, max(end, low + len(keep) + READ_BLOCKS * self.block))
                held = np.concatenate([keep, self.ids(low + len(keep), upto)])
            yield row, held[end - n - low : end - low]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    ident: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_ids: int = 32_000_000,
) -> DataFrame:
    """Encode and write all documents; returns the manifest, staged, in order of (part, shard).

    The id column is an integer. Null texts are empty and so hold the end id alone. Null ids come
    first; rows with one id are ordered by a hash of their text, equal rows stand together. An
    empty table writes no file. A text of any length lies in one shard.
    """
    path = tokenizer or vocabulary()
    rows = docs.select(F.col(ident).cast("bigint").alias("ident"), F.col(text).cast("string").alias("text"))
    keys = [F.asc_nulls_first("ident"), F.xxhash64("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, codes = TaskContext.get().partitionId(), 0, coder(path)
        waiting = (piece for batch in batches for piece in pieces(batch))
        piece = next(waiting, None)
        while piece is not None:
            uri = f"{folder}/part-{part:06d}-{shard:06d}.s8b"
            with written(uri) as out:
                writer = ShardWriter(out)
                while piece is not None and writer.n_ids < shard_ids:
                    ids, counts = codes.encode(piece.column(1))
                    ends = np.cumsum(counts)
                    ids = np.insert(ids, ends, end_id)
                    null = piece.column(0).is_null().to_numpy(zero_copy_only=False)
                    writer.add(piece.column(0).fill_null(0).to_numpy(zero_copy_only=False), null, counts + 1, ids)
                    piece = next(waiting, None)
                n_docs, n_ids, n_bytes = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [uri], "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids], "n_bytes": [n_bytes]}
            )
            shard += 1

    written_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, MANIFEST)
    return materialised(written_rows, "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(ident, start, n_tokens, ids_crc32) of each document, decoded from the files of a manifest."""
    order = Window.orderBy("part", "shard")  # one row a file
    files = manifest.withColumn("first", F.sum("n_ids").over(order) - F.col("n_ids")).select("path", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with random_access(uri) as source:
                    shard = ShardReader(source)
                    crc = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in shard.documents()), np.int64, len(shard.ident))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "ident": pa.array(shard.ident, pa.int64(), mask=shard.null),
                            "start": first + np.cumsum(shard.counts) - shard.counts,
                            "n_tokens": shard.counts,
                            "ids_crc32": crc,
                        }
                    )

    n = max(1, min(manifest.count(), 4096))
    return files.repartition(n).mapInArrow(run, "ident bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, folder: str | None = None, ident: str = "doc_id", **options) -> DataFrame:
    """Write all documents and read the files back: one row a document."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, ident=ident, **options)).withColumnRenamed("ident", ident)
