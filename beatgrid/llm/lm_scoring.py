"""Scoring whole texts with a gated recurrent language model.

1. All training texts are counted: words per task, then a sum by word. The counts, one row a
   distinct word, stay a distributed table.
2. The ``top`` most frequent words (a bounded table) are broadcast. The first ``head`` of them are
   words of the recurrent model, the others form bands whose words share a unit each; all words
   beyond are one more band. Within a band a word's share is its share of the band's counts.
3. The model is trained on all training documents. In each of ROUNDS rounds, which share out the
   documents, every task runs truncated backpropagation from the same weights over its texts; the
   tasks' weights are averaged by their tokens and are the next round's.
4. One pass over all texts scores what the broadcast table knows, and lists the other words of each
   row; these are joined to the counts and summed per row.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm import gru
from beatgrid.llm.common import pieces, worker_cache
from beatgrid.llm.tokens import HashTable
from beatgrid.llm.words import SPACED, Words, hashes, split
from beatgrid.sources.files import discard, materialised

#: The token that ends a text.
END = np.uint64(0x656E64656E64656F)
#: Smoothing of every count.
SMOOTH = 0.1
#: Tokens that a task counts before it passes partial counts on.
FLUSH = 4_000_000
#: Tokens that are scored side by side.
SIDE = 2_500_000
#: Rounds of training, the step size of the first and its change from round to round.
ROUNDS, RATE, DECAY = 3, 0.01, 0.4
#: Training tokens for each task, tokens that a task learns from at a time, and weights averaged at a time.
TASK_TOKENS, LEARN, FAN = 6_000_000, 1_000_000, 32


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word and of the end of each text, first token of each text and their number)."""
    words: Words = split(texts, SPACED)
    first = words.first + np.arange(len(words.first))
    h = np.full(first[-1], END)
    inside = np.ones(len(h), bool)
    inside[first[1:] - 1] = False
    h[inside] = hashes(words) | np.uint64(1)
    return h, first


def held_out(ident: str) -> Column:
    """Documents that nothing is learned from; a null id counts as one."""
    return F.coalesce(F.crc32(F.col(ident).cast("string")) % 10 == 0, F.lit(True))


def count_words(texts: DataFrame) -> DataFrame:
    """(h, c): the count of each token over the one column of ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        for batch in batches:
            for piece in pieces(batch, 0):
                h, _ = tokens(piece.column(0))
                waiting.append(h)
                n += len(h)
                if n >= FLUSH:
                    yield counted()
                    waiting, n = [], 0
        if waiting:
            yield counted()

    return texts.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, top: int) -> list[tuple[int, int]]:
    """At most ``top`` words with a count that no word left out reaches, most frequent first.

    The least count is found from counts in bins of 0.1 per cent, of which there are some ten
    thousand at any size.
    """
    bin_of = F.floor(F.log2("c") * 1000)
    bins = sorted(counts.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True)
    least, held = None, 0
    for b, n in bins:
        if held + n > top:
            break
        least, held = b, held + n
    if least is None:
        return []
    rows = counts.filter(bin_of >= least).collect()
    return sorted(((r.h, r.c) for r in rows), key=lambda x: (-x[1], x[0]))


@dataclass
class Vocabulary:
    """The broadcast table: words by rank, their counts, and the units of the recurrent model."""

    h: np.ndarray
    c: np.ndarray
    unit: np.ndarray  # unit of each rank; words beyond the table have the last unit
    share: np.ndarray  # log10 share of a word in its band, 0 for head words
    head_counts: np.ndarray
    tail_counts: np.ndarray  # of the bands, the last one for words beyond the table

    def __post_init__(self):
        self.cls, self.word = gru.units(len(self.head_counts), len(self.tail_counts))

    def table(self) -> HashTable:
        keys = self.h.view(np.uint64)
        out = HashTable(max(1, len(keys)))
        out.add(keys)
        return out


def vocabulary(words: list[tuple[int, int]], total: int, head: int, bands: int) -> Vocabulary:
    h = np.array([x for x, _ in words], np.int64)
    c = np.array([x for _, x in words], np.float64)
    n = min(head, len(h))
    unit, share, tails = np.arange(len(h)), np.zeros(len(h)), []
    rest = c[n:]
    if len(rest):  # bands of about equal mass
        band = np.minimum((np.cumsum(rest) - rest) / rest.sum() * bands, bands - 1).astype(int)
        _, band = np.unique(band, return_inverse=True)
        mass = np.bincount(band, rest)
        unit[n:] = n + band
        share[n:] = np.log10(rest / mass[band])
        tails = mass.tolist()
    return Vocabulary(h, c, unit, share, c[:n], np.array([*tails, max(0.0, total - c.sum())]))


def unit_ids(v: Vocabulary, table: HashTable, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank or -1, unit) of each token."""
    rank = table.find(h)
    last = len(v.head_counts) + len(v.tail_counts) - 1
    return rank, np.where(rank >= 0, v.unit[rank] if len(v.unit) else last, last)


LEARNED = "at int, tokens bigint, weights binary"


def trained(texts: DataFrame, v: Vocabulary, total: int) -> gru.Weights:
    """The recurrent model, learned from all texts (column t); column round, from 0, has the round in
    which a text takes its turn. There is one task for each TASK_TOKENS of the ``total`` tokens, so that
    a task's steps are about as many at every size."""
    context = texts.sparkSession.sparkContext
    words, tasks = context.broadcast(v), max(1, -(-total // TASK_TOKENS))
    weights = gru.initial(v.head_counts, v.tail_counts)
    for turn in range(ROUNDS):
        run = _learner(words, context.broadcast(weights), RATE * DECAY**turn)
        found = texts.filter(F.col("round") == turn).select("t").coalesce(tasks)
        found = materialised(found.mapInArrow(run, LEARNED), "weights")
        weights = _averaged(found) or weights
        discard(found)
    return weights


def _learner(words, weights, rate: float):
    """One row of a task: its number, the tokens it learned from and the weights it came to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language model")  # other operators' caches go
        vocab = words.value
        table, trainer = vocab.table(), gru.Trainer(weights.value, vocab.cls, vocab.word, rate)
        unit, counts, held = [], [], 0

        def learn() -> None:
            trainer.learn(np.concatenate(unit), np.concatenate([[0], np.cumsum(np.concatenate(counts))]))

        for batch in batches:
            for piece in pieces(batch, 0):
                h, first = tokens(piece.column(0))
                unit.append(unit_ids(vocab, table, h)[1])
                counts.append(np.diff(first))
                held += len(h)
                if held >= LEARN:
                    learn()
                    unit, counts, held = [], [], 0
        if held:
            learn()
        if trainer.units:
            at = TaskContext.get().partitionId()
            values = [pa.array([at], pa.int32()), pa.array([trainer.units]), pa.array([pickle.dumps(trainer.w)], pa.binary())]
            yield pa.RecordBatch.from_arrays(values, ["at", "tokens", "weights"])

    return run


def _averaged(found: DataFrame) -> gru.Weights | None:
    """The mean of all weights by tokens, FAN at a time."""

    def merged(key: tuple, group: pa.Table) -> pa.Table:
        n = group.column("tokens").to_numpy()
        parts = [pickle.loads(x.as_py()) for x in group.column("weights")]
        one = pickle.dumps(gru.mean(parts, (n / n.sum()).tolist()))
        return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "tokens": pa.array([n.sum()]), "weights": pa.array([one], pa.binary())})

    left = (found.agg(F.max("at")).first()[0] or 0) + 1
    while left > 1:
        found = found.groupBy(F.floor(F.col("at") / FAN).cast("int").alias("group")).applyInArrow(merged, LEARNED)
        left = -(-left // FAN)
    row = found.first()
    return None if row is None else pickle.loads(bytes(row.weights))


SCORED = "_row bigint, ident {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, n_rare bigint, h bigint, n bigint"


def _pass(rows: DataFrame, kind: str, shared, name: str) -> DataFrame:
    """One row for each text, and one for each distinct word of it that the table doesn't hold (with
    h and n; the other columns null)."""

    def block(rows_in: list[pa.RecordBatch], toks: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        table, vocab, weights = worker_cache("language model")[name]
        h = np.concatenate([x for x, _ in toks])
        counts = np.concatenate([np.diff(f) for _, f in toks])
        first = np.concatenate([[0], np.cumsum(counts)])
        rank, unit = unit_ids(vocab, table, h)
        natural = gru.score(weights, unit, first, vocab.cls, vocab.word)
        text = np.repeat(np.arange(len(counts)), counts)
        known = rank >= 0
        by = lambda x: np.bincount(text[known], x[rank[known]], len(counts)) if len(vocab.h) else np.zeros(len(counts))
        n_known = np.bincount(text[known], minlength=len(counts))
        base = by(np.log10(vocab.c + SMOOTH))
        score = natural / np.log(10) + by(vocab.share)
        row = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in rows_in])
        whole = pa.Table.from_batches(rows_in)
        n = len(counts)
        empty = pa.nulls(n, pa.int64())
        yield from pa.Table.from_arrays(
            [
                pa.array(row), whole.column(1), whole.column(2), pa.array(counts, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(score),
                pa.array(counts - n_known, pa.int64()), empty, empty,
            ],
            names=NAMES,
        ).combine_chunks().to_batches()
        order = np.flatnonzero(~known)
        order = order[np.lexsort((h[order], text[order]))]
        if len(order):
            new = np.ones(len(order), bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(order)))
            none = lambda t: pa.nulls(len(at), t)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row[text[order[at]]]), none(whole.column(1).type), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()),
                    none(pa.int64()), pa.array(h[order[at]].view(np.int64)), pa.array(n, pa.int64()),
                ],
                NAMES,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = worker_cache("language model")
        if name not in tables:
            tables.clear()
            vocab, weights = shared.value
            tables[name] = vocab.table(), vocab, weights
        rows_in, toks, held = [], [], 0
        for batch in batches:
            for piece in pieces(batch, 3):
                rows_in.append(piece.select([0, 1, 2]))
                toks.append(tokens(piece.column(3)))
                held += len(toks[-1][0])
                if held >= SIDE:
                    yield from block(rows_in, toks)
                    rows_in, toks, held = [], [], 0
        if rows_in:
            yield from block(rows_in, toks)

    return rows.mapInArrow(run, SCORED.format(kind=kind))


NAMES = ["_row", "ident", "held_out", "n_tokens", "n_known", "base", "score", "n_rare", "h", "n"]


def score_documents(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    top: int = 262_144,
    head: int = 2048,
    bands: int = 6,
    train_docs: int | None = None,
) -> DataFrame:
    """(ident, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Tokens are words between white space, A-Z lower-cased, and one end; a null or empty text is
    its end alone. base_score is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))) with
    the counts of all training documents, score the model's log10 probability of the text. Nothing
    is learned from documents whose crc32 of the id is divisible by ten, or whose id is null. Counts
    and recurrent weights are learned from all other documents, whole texts, and the weights depend on
    how Spark cuts the input into tasks; a caller may bound them to the ``train_docs`` documents of
    lowest hash. Without any, both scores follow from the smoothing alone. Repeated rows are scored
    each; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("t")).withColumn("held_out", held_out("ident"))
    kind = rows.schema["ident"].dataType.simpleString()
    learned = rows.filter(~F.col("held_out"))
    counts = materialised(count_words(learned.select("t")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    vocab = vocabulary(frequent(counts, top), total, head, bands)
    place = F.xxhash64(F.col("ident").cast("string"), "t")
    chosen = learned
    if train_docs is not None:
        # the ids first, so that no task gathers texts of more documents than these
        last = learned.select(place.alias("p")).orderBy("p").limit(train_docs).agg(F.max("p")).first()[0]
        chosen = learned.filter(place <= F.lit(last).cast("bigint")).limit(train_docs)
    weights = trained(chosen.select("t", F.pmod(place, F.lit(ROUNDS)).alias("round")), vocab, total)
    shared = spark.sparkContext.broadcast((vocab, weights))
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), "ident", "held_out", "t")
    passed = materialised(_pass(numbered, kind, shared, uuid.uuid4().hex), "scored")

    rare_rows, rare_mass = distinct - len(vocab.h), total - float(vocab.c.sum())
    rare = passed.filter("h is not null").select("_row", "h", "n")
    beyond = rare.join(counts, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    beyond = beyond.groupBy("_row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + SMOOTH)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known")
    )
    base_norm = float(np.log10(total + SMOOTH * (distinct + 1)))
    rare_norm = float(np.log10(rare_mass + SMOOTH * (rare_rows + 1)))
    more = F.coalesce("more", F.lit(0.0))
    return (
        passed.filter("h is null")
        .drop("h", "n")
        .join(beyond, "_row", "left")
        .select(
            F.col("ident").alias(ident),
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("bigint").alias("n_known"),
            F.lit(int(total)).cast("bigint").alias("train_tokens"),
            (F.col("base") + more - F.col("n_tokens") * F.lit(base_norm)).alias("base_score"),
            (F.col("score") + more - F.col("n_rare") * F.lit(rare_norm)).alias("score"),
        )
    )
