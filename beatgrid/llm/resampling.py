"""Importance resampling towards a target: hashed n-gram features, log-ratio weights and a Gumbel draw.

Words come from the UTF-8 bytes by one ``bytes.translate`` (A-Z lower-cased, separators blank) and
``bytes.split``; an n-gram's bucket is a crc32 that continues the one of its first words. Tasks add
their features up in counters of at most ``buckets`` entries, which Spark sums; these counts alone
(``buckets`` rows for each corpus) reach the driver and, as the buckets' gains, the tasks of the second
pass, which weigh every document. Scores are whole numbers within a few hundred thousand, so the
limit of the draw and the ranks come from counts by score.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces
from beatgrid.sources.files import materialised

#: Word bytes after folding; every other byte is a separator.
_WORD = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_FOLD = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
TABLE = bytes(b if b in _WORD else 0x20 for b in _FOLD)

#: Bytes of a text that are split at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Features:
    """Runs of ``least`` to ``most`` consecutive words, hashed to ``buckets``."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000


@dataclass(frozen=True)
class Draw:
    """``share`` of 100 documents with at least ``min_words`` words are drawn; the noise hangs on ``seed:id``."""

    share: int = 10
    min_words: int = 20
    seed: int = 2024


def words(raw: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, as lists for stretches of about ``block`` bytes."""
    at = 0
    while at < len(raw):
        end = min(at + block, len(raw))
        part = raw[at:end].translate(TABLE)
        while end < len(raw) and not part.endswith(b" "):
            # the stretch ends inside a word or just after one: go on to the next separator
            more = raw[end : end + block].translate(TABLE)
            blank = more.find(b" ") + 1 or len(more)
            part, end = part + more[:blank], end + blank
        at = end
        yield part.split()


def features(raw: bytes, how: Features, block: int = BLOCK) -> tuple[Counter, int]:
    """(occurrences by bucket, number of words) of one text."""
    found: Counter = Counter()
    n = 0
    if how.least == how.most == 1:
        for part in words(raw, block):
            n += len(part)
            for word, times in Counter(part).items():
                found[crc32(word) % how.buckets] += times
        return found, n
    seeds: list[int] = []  # crc32 of the runs that end at the last word, shortest first
    for part in words(raw, block):
        n += len(part)
        runs: Counter = Counter()
        for word in part:
            tail = b" " + word
            seeds = [crc32(word), *[crc32(tail, s) for s in seeds[: how.most - 1]]]
            runs.update(seeds[how.least - 1 :])
        for code, times in runs.items():
            found[code % how.buckets] += times
    return found, n


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for value in batch.column(column).cast(pa.large_binary()):
        yield value.as_py() or b""


def bucket_counts(docs: DataFrame, how: Features | None = None, text: str = "text") -> dict[int, int]:
    """Occurrences by bucket over all texts; at most ``how.buckets`` entries at any size."""
    how = how or Features()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for raw in _texts(batch, 0):
                total.update(features(raw, how)[0])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(total), pa.int32()), "n": pa.array(list(total.values()), pa.int64())})

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint")
    return dict(map(tuple, parts.groupBy("bucket").agg(F.sum("n")).collect()))


def gains(source: dict[int, int], target: dict[int, int], how: Features | None = None) -> list[int]:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    b = (how or Features()).buckets
    s, t = float(sum(source.values()) + b), float(sum(target.values()) + b)
    return [math.floor(1000 * math.log((target.get(k, 0) + 1) * s / ((source.get(k, 0) + 1) * t))) for k in range(b)]


def noise(ident, seed: int) -> int:
    """Gumbel noise of a document, in thousandths; a null id is the empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame, table: list[int], how: Features | None = None, seed: int = Draw.seed, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(ident, n_features, n_words, weight, score) of every document from the buckets' gains."""
    how = how or Features()
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part in pieces(batch):
                out: dict[str, list[int]] = {"n_features": [], "n_words": [], "weight": [], "score": []}
                for key, raw in zip(part.column(0).to_pylist(), _texts(part, 1)):
                    found, n = features(raw, how)
                    count = found.total()
                    weight = sum(gain[b] * k for b, k in found.items()) // count if count else 0
                    for name, value in zip(out, (count, n, weight, weight + noise(key, seed))):
                        out[name].append(value)
                columns = [part.column(0), *[pa.array(v, pa.int64()) for v in out.values()]]
                yield pa.RecordBatch.from_arrays(columns, ["ident", *out])

    return rows.mapInArrow(run, f"ident {kind}, n_features bigint, n_words bigint, weight bigint, score bigint").withColumnRenamed("ident", ident)


def ranked(scored: DataFrame, wanted: Column, share: int, ident: str) -> DataFrame:
    """``scored`` (staged; read three times) with ``rank``: 1, 2, 3 for the ``share`` of 100 rows with
    ``wanted`` that have the highest scores, ties to the smaller ident (null last), else null.

    Counts by score give every score's first rank and the last score that is drawn. Only rows from
    that score up are dealt out, by score; the noise in it spreads documents of any one weight over
    thousands of scores, so none of these groups holds more than a few ten thousandths of all.
    """
    counts = scored.filter(wanted).groupBy("score").agg(F.count("*").alias("_n"))
    total = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = materialised(counts.withColumn("_to", F.sum("_n").over(total)), "score-counts")
    drawn = (counts.agg(F.max("_to")).first()[0] or 0) * share // 100
    # all scores whose first row is still drawn
    counts = counts.filter(F.col("_to") - F.col("_n") < drawn).select("score", (F.col("_to") - F.col("_n")).alias("_before"))
    least = counts.agg(F.min("score")).first()[0]
    inside = Window.partitionBy("score").orderBy(F.col(ident).asc_nulls_last(), "n_features")
    high = wanted & (F.col("score") >= F.lit(least)) if least is not None else F.lit(False)
    top = scored.filter(high).withColumn("_row", F.row_number().over(inside)).join(F.broadcast(counts), "score")
    rank = F.col("_before") + F.col("_row")
    top = top.withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.filter(~F.coalesce(high, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return top.select(rest.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, how: Features | None = None, draw: Draw | None = None, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's (ident, n_features, weight, score, rank); rank is null for those not drawn.

    Null texts have no features: weight 0, never drawn. Repeated rows count and are ranked one by one;
    equal scores are ordered by id, a null id last. With no target texts all gains come from the source
    alone. An empty table of documents gives an empty result. Other columns are not read.
    """
    how, draw = how or Features(), draw or Draw()
    table = gains(bucket_counts(docs, how, text), bucket_counts(target, how, text), how)
    scored = materialised(weigh(docs, table, how, draw.seed, ident, text), "weights")
    out = ranked(scored, F.col("n_words") >= draw.min_words, draw.share, ident)
    return out.select(ident, "n_features", "weight", "score", "rank")
