"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts the signs (bytes) of a word and its end from up to four signs before, so it
knows spelling, case and punctuation in any language. With ``whole``, as in the queries, the signs
before run across word borders from the start of the text, so that repetition and the order of words
show; otherwise every word stands alone. N-gram counts of the trusted documents are
sharded by n-gram; continuation counts, context totals, back-off weights and interpolated
probabilities follow from joins of these counts, order by order. All trusted documents are counted. A
table of probabilities of bounded size is read from the shared folder and held by every task, to look the
n-grams of its documents up, and never passes through the driver; with a larger one they are joined. Per language, the threshold is the perplexity that tells trusted documents from labelled
bad ones best; without ``whole``, or where a language has too few bad ones, it follows from a quantile
of the trusted documents' perplexities.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces, worker_cache
from beatgrid.llm.store import random_access
from beatgrid.llm.tokens import HashTable
from beatgrid.llm.words import Words, hashes, mixed, rule, split
from beatgrid.sources.files import materialised

ORDER = 5
#: Symbols that the lowest order spreads its remainder over: 255 bytes and the end of a word.
SYMBOLS = 256
END = 0x20
#: Words, or n-grams of whole texts, whose score a worker keeps.
CACHE_WORDS = 1_000_000
#: A model with more n-grams and contexts is not held by the tasks; n-grams of documents are joined with it.
MODEL_ROWS = 3_000_000
#: Rows of a model in one of its files, about.
FILE_ROWS = 250_000
#: Texts are cut into n-grams in pieces of about this many bytes, which bounds what a worker holds for them,
#: and so many n-grams of pieces are counted together.
PIECE_BYTES, HELD = 250_000, 500_000
#: Perplexities are told apart to one part in so many when a threshold is checked on bad rows.
BINS = 1000

_SPACED = rule(bytes([0x20, *range(0x09, 0x0E)]), fold=False)


def mask(order: int) -> int:
    return (1 << 8 * order) - 1


def ngrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(key, first): the n-gram of highest order that ends at each sign of each word and at its end;
    word i has those from ``first[i]`` to ``first[i + 1]``. Before a word stand zero signs."""
    size = words.end - words.start
    lead = ORDER - 1
    begin = np.cumsum(size + lead + 1) - (size + lead + 1)
    signs = np.zeros(int((size + lead + 1).sum()), np.uint64)
    inside = np.repeat(begin + lead, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(words.start, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    signs[inside] = np.maximum(words.data[source], 1)  # a zero byte counts as the byte 1
    signs[begin + lead + size] = END
    key = signs.copy()
    for k in range(1, ORDER):
        key[k:] |= signs[:-k] << np.uint64(8 * k)
    keep = np.ones(len(signs), bool)
    keep[(begin[:, None] + np.arange(lead)).ravel()] = False
    return key[keep], np.concatenate([[0], np.cumsum(size + 1)])


def text_ngrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(key, first): as ``ngrams``, but over each text as a whole, its words parted by one end each;
    text i has those from ``first[i]`` to ``first[i + 1]``. Before a text stand zero signs."""
    size = words.end - words.start
    begin = np.cumsum(size + 1) - (size + 1)
    signs = np.full(int((size + 1).sum()), END, np.uint64)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    signs[np.repeat(begin, size) + step] = np.maximum(words.data[np.repeat(words.start, size) + step], 1)
    first = np.append(begin, len(signs))[words.first]
    key = signs.copy()
    for k in range(1, ORDER):
        key[k:] |= signs[:-k] << np.uint64(8 * k)
    for k in range(ORDER - 1):
        at = (first[:-1] + k)[first[:-1] + k < first[1:]]
        key[at] &= np.uint64(mask(k + 1))
    return key, first


def count_ngrams(texts: DataFrame, whole: bool = False) -> DataFrame:
    """(half, gram, c): counts of the highest order over the texts (t, half) of each half."""
    grams = text_ngrams if whole else ngrams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("counts")  # all operators' caches go, a former model too
        held, n = defaultdict(list), 0

        def counted() -> Iterator[pa.RecordBatch]:
            for h, parts in held.items():
                gram, at = np.unique(np.concatenate([gram for gram, _ in parts]), return_inverse=True)
                c = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), h, np.int32)), pa.array(gram.astype(np.int64)), pa.array(c)], ["half", "gram", "c"])

        for batch in batches:
            for piece in pieces(batch, 0, PIECE_BYTES):
                of = piece.column(1).to_numpy(zero_copy_only=False)
                for h in np.unique(of):
                    gram, c = np.unique(grams(split(piece.column(0).filter(pa.array(of == h)), _SPACED))[0], return_counts=True)
                    if len(gram):
                        held[h].append((gram, c))
                        n += len(gram)
                if n >= HELD:
                    yield from counted()
                    held.clear()
                    n = 0
        yield from counted()

    return texts.mapInArrow(run, "half int, gram bigint, c bigint").groupBy("half", "gram").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three modified Kneser-Ney discounts of one order. Where the counts of counts don't give
    values between 0 and the count, as in an order with few n-grams, 0.5, 1 and 1.5 are taken."""
    n1, n2, n3, n4 = counts.agg(*[F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)]).first()
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d < i for d, i in zip(found, (1, 2, 3))):
            return found
    return 0.5, 1.0, 1.5


def probabilities(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((order, gram, p), (order, context, gamma)), staged: interpolated probabilities of all n-grams
    that were seen, and back-off weights of all contexts."""
    by_order = {ORDER: materialised(counts, f"grams{ORDER}")}
    for k in range(ORDER - 1, 0, -1):  # how many different signs stand before
        shorter = F.col("gram").bitwiseAND(F.lit(mask(k)).cast("bigint"))
        lower = by_order[k + 1].groupBy(shorter.alias("gram")).agg(F.count("*").alias("c"))
        by_order[k] = materialised(lower, f"grams{k}")
    every_p, every_gamma, below = None, None, None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts(by_order[k])
        c = F.col("c")
        off = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        rows = by_order[k].withColumn("context", F.shiftright("gram", 8)).withColumn("off", off)
        gamma = rows.groupBy("context").agg((F.sum("off") / F.sum("c")).alias("gamma"), F.sum("c").alias("total"))
        gamma = materialised(gamma, f"contexts{k}")
        rows = rows.join(gamma, "context").withColumn("alpha", (c - F.col("off")) / F.col("total"))
        if below is None:
            rows = rows.withColumn("p", F.col("alpha") + F.col("gamma") / SYMBOLS)
        else:
            shorter = F.col("gram").bitwiseAND(F.lit(mask(k - 1)).cast("bigint"))
            rows = rows.withColumn("shorter", shorter).join(below.toDF("shorter", "lower"), "shorter")
            rows = rows.withColumn("p", F.col("alpha") + F.col("gamma") * F.col("lower"))
        below = materialised(rows.select("gram", "p"), f"probabilities{k}")
        p = below.select(F.lit(k).alias("order"), "gram", "p")
        g = gamma.select(F.lit(k).alias("order"), "context", "gamma")
        every_p = p if every_p is None else every_p.unionByName(p)
        every_gamma = g if every_gamma is None else every_gamma.unionByName(g)
    return every_p, every_gamma


@dataclass
class Model:
    """Probabilities and back-off weights in hash tables, by order and n-gram."""

    grams: HashTable
    p: np.ndarray
    contexts: HashTable
    gamma: np.ndarray

    @staticmethod
    def key(order: int, gram: np.ndarray) -> np.ndarray:
        return mixed(gram + np.uint64(order << 56))

    def sign_scores(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of the last sign of each n-gram of highest order."""
        out, weight = np.full(len(key), 1.0 / SYMBOLS), np.ones(len(key))
        todo = np.arange(len(key))
        for k in range(ORDER, 0, -1):
            at = self.grams.find(self.key(k, key[todo] & np.uint64(mask(k))))
            out[todo[at >= 0]] = self.p[at[at >= 0]]
            todo = todo[at < 0]
            context = (key[todo] >> np.uint64(8)) & np.uint64(mask(k - 1))
            at = self.contexts.find(self.key(k, context))
            weight[todo[at >= 0]] *= self.gamma[at[at >= 0]]
        return np.log(out * weight)


def packed(p: DataFrame, gamma: DataFrame) -> tuple[list[str], list[str]]:
    """The files of the two staged tables, of ``MODEL_ROWS`` rows at most together. The tasks read them,
    so the driver holds none of the rows."""
    parts = -(-MODEL_ROWS // FILE_ROWS)
    return tuple(materialised(side.coalesce(parts), "model").inputFiles() for side in (p, gamma))


def unpacked(files: tuple[list[str], list[str]]) -> Model:
    def table(names: list[str], key: str, value: str) -> tuple[HashTable, np.ndarray]:
        parts = []
        for name in names:
            with random_access(name) as file:
                parts.append(pq.read_table(file, columns=["order", key, value]))
        order, x, y = (pa.concat_tables(parts).column(c).to_numpy() for c in ("order", key, value))
        keys = mixed(x.astype(np.uint64) + (order.astype(np.uint64) << np.uint64(56)))
        out = HashTable(max(1, len(keys)))
        out.add(keys)
        return out, y

    return Model(*table(files[0], "gram", "p"), *table(files[1], "context", "gamma"))


class Scorer:
    """Log probability of texts, with the scores of words met before."""

    def __init__(self, model: Model, keep: int = CACHE_WORDS, whole: bool = False):
        self.model, self.keep, self.whole = model, keep, whole
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(1)  # grows with what is kept
        self.score = np.zeros(1 << 12)

    def words(self, words: Words, keys: np.ndarray) -> np.ndarray:
        at = self.table.find(keys)
        if (at < 0).any():
            new, first = np.unique(keys[at < 0], return_index=True)
            if self.table.used + len(new) > self.keep:
                self._clear()
                new, first = np.unique(keys, return_index=True)
            else:
                first = np.flatnonzero(at < 0)[first]
            grams, begin = ngrams(words.only(first))
            total = np.add.reduceat(self.model.sign_scores(grams), begin[:-1])
            n = self.table.used
            while n + len(new) > len(self.score):
                self.score = np.concatenate([self.score, np.zeros_like(self.score)])
            self.score[n : n + len(new)] = total
            self.table.add(new)
            at = self.table.find(keys)
        return self.score[at]

    def grams(self, grams: np.ndarray) -> np.ndarray:
        """Score of each n-gram of highest order."""
        keys = mixed(grams)  # a bijection, and no n-gram is zero
        at = self.table.find(keys)
        if (at < 0).any():
            new = np.unique(grams[at < 0])
            if self.table.used + len(new) > self.keep:
                self._clear()
                new = np.unique(grams)
            if len(new) > self.keep:
                return self.model.sign_scores(grams)
            n = self.table.used
            while n + len(new) > len(self.score):
                self.score = np.concatenate([self.score, np.zeros_like(self.score)])
            self.score[n : n + len(new)] = self.model.sign_scores(new)
            self.table.add(mixed(new))
            at = self.table.find(keys)
        return self.score[at]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probability, number of signs and word ends) of each text."""
        words = split(texts, _SPACED)
        if self.whole:
            grams, first = text_ngrams(words)
            score = np.concatenate([[0.0], np.cumsum(self.grams(grams))])
            return score[first[1:]] - score[first[:-1]], np.diff(first)
        score = np.concatenate([[0.0], np.cumsum(self.words(words, hashes(words) | np.uint64(1)))])
        signs = np.concatenate([[0], np.cumsum(words.end - words.start + 1)])
        first, last = words.first[:-1], words.first[1:]
        return score[last] - score[first], signs[last] - signs[first]


def _scorer(name: str, files: tuple[list[str], list[str]], whole: bool) -> Scorer:
    scorers = worker_cache("quality")
    if name not in scorers:
        scorers.clear()
        scorers[name] = Scorer(unpacked(files), whole=whole)
    return scorers[name]


def half(ident: str) -> Column:
    """0 or 1 by the id: which of two models scores a document. That model is trained on the other half."""
    return F.pmod(F.xxhash64(F.lit(1), F.col(ident)), F.lit(2)).cast("int")


def document_ngrams(docs: DataFrame, keep: list[str], whole: bool) -> DataFrame:
    """(keep..., _half, _n, _grams, _counts, _row) of each row (keep..., _text, _half), staged: its different
    n-grams of highest order, how often each occurs, and the number of all."""
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("counts")  # as in ``count_ngrams``
        for batch in batches:
            for piece in pieces(batch, at, PIECE_BYTES):
                words = split(piece.column(at), _SPACED)
                key, first = (text_ngrams if whole else ngrams)(words)
                first = first if whole else first[words.first]
                n = np.diff(first)
                text = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((key, text))
                key, text = key[order], text[order]
                new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[: len(key)])
                count = np.diff(np.append(new, len(key)))
                ends = pa.array(np.searchsorted(text[new], np.arange(len(n) + 1)).astype(np.int32))
                grams = pa.ListArray.from_arrays(ends, pa.array(key[new].astype(np.int64)))
                counts = pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*piece.columns[:at], piece.column(at + 1), pa.array(n, pa.int64()), grams, counts], [*keep, "_half", "_n", "_grams", "_counts"])

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:at])
    found = docs.mapInArrow(run, f"{given}, _half int, _n bigint, _grams array<bigint>, _counts array<bigint>")
    return materialised(found.withColumn("_row", F.monotonically_increasing_id()), "document-grams")


def joined_scores(grams: DataFrame, p: DataFrame, gamma: DataFrame) -> DataFrame:
    """(half, gram, score) of different n-grams of highest order (half, gram): what ``Model.sign_scores`` gives, by joins."""
    rows = grams.withColumns({"p": F.lit(None).cast("double"), "weight": F.lit(1.0)})
    for k in range(ORDER, 0, -1):
        seen = p.filter(F.col("order") == k).select("half", F.col("gram").alias("shorter"), F.col("p").alias("found"))
        back = gamma.filter(F.col("order") == k).select("half", "context", "gamma")
        rows = rows.withColumn("shorter", F.col("gram").bitwiseAND(F.lit(mask(k)).cast("bigint")))
        rows = rows.withColumn("context", F.shiftright("shorter", 8)).join(seen, ["half", "shorter"], "left").join(back, ["half", "context"], "left")
        weight = F.when(F.col("p").isNull() & F.col("found").isNull(), F.col("weight") * F.coalesce("gamma", F.lit(1.0))).otherwise(F.col("weight"))
        rows = rows.select("half", "gram", F.coalesce("p", "found").alias("p"), weight.alias("weight"))
    return rows.select("half", "gram", F.log(F.coalesce("p", F.lit(1.0 / SYMBOLS)) * F.col("weight")).alias("score"))


@dataclass
class Classifier:
    """Trained models, as files that the tasks read or as ``tables`` to join with, and the thresholds by language. With two models a
    document is scored by the one that was not trained on its half of the ids."""

    shared: list
    name: str
    ident: str = "doc_id"
    text: str = "text"
    lang: str = "lang"
    whole: bool = False
    thresholds: DataFrame | None = None
    pooled: float | None = None
    #: ((half, order, gram, p), (half, order, context, gamma)) of models too large to be read by a task
    tables: tuple[DataFrame, DataFrame] | None = None

    def joined_perplexities(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """As ``perplexities``; nothing is held whole, the n-grams of the documents are shuffled."""
        of = half(self.ident) if self.whole else F.lit(0)
        rows = document_ngrams(docs.select(*[f"`{c}`" for c in keep], F.col(self.text).cast("string").alias("_text"), of.alias("_half")), keep, self.whole)
        each = rows.select("_row", F.col("_half").alias("half"), F.explode(F.arrays_zip("_grams", "_counts")).alias("x"))
        each = each.select("_row", "half", F.col("x._grams").alias("gram"), F.col("x._counts").alias("c"))
        score = materialised(joined_scores(each.select("half", "gram").distinct(), *self.tables), "gram-scores")
        sums = each.join(score, ["half", "gram"]).groupBy("_row").agg(F.sum(F.col("c") * F.col("score")).alias("_sum"))
        return rows.join(sums, "_row", "left").select(*[f"`{c}`" for c in keep], "_n", F.exp(-F.col("_sum") / F.col("_n")).alias("_perplexity"))

    def perplexities(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` and _n (signs) and _perplexity (null without words) of each row."""
        if self.tables is not None:
            return self.joined_perplexities(docs, keep)
        whole, at = self.whole, len(keep)
        rows = docs.select(*[f"`{c}`" for c in keep], F.col(self.text).cast("string").alias("_text"))
        out = rows.select(*[f"`{c}`" for c in keep], F.lit(0).cast("bigint").alias("_n"), F.lit(None).cast("double").alias("_perplexity"))

        def by(name: str, files: tuple[list[str], list[str]]) -> Callable:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                scorer = _scorer(name, files, whole)
                for batch in batches:
                    for piece in pieces(batch, at, PIECE_BYTES):
                        score, n = scorer.texts(piece.column(at))
                        ppl = np.exp(-score / np.maximum(n, 1))
                        columns = [*piece.columns[:at], pa.array(n, pa.int64()), pa.array(ppl, pa.float64(), mask=n == 0)]
                        yield pa.RecordBatch.from_arrays(columns, [*keep, "_n", "_perplexity"])

            return run

        if len(self.shared) == 1:
            return rows.mapInArrow(by(self.name, self.shared[0]), out.schema)
        parts = docs.select(*[f"`{c}`" for c in keep], F.col(self.text).cast("string").alias("_text"), half(self.ident).alias("_half"))
        scored = [parts.filter(F.col("_half") == h).drop("_half").mapInArrow(by(f"{self.name}-{h}", s), out.schema) for h, s in enumerate(self.shared)]
        return scored[0].unionByName(scored[1])

    def judged(self, scored: DataFrame) -> DataFrame:
        """Rows of ``perplexities`` with _threshold and _keep."""
        if self.thresholds is None:
            joined = scored.withColumn("_threshold", F.lit(self.pooled).cast("double"))
        else:
            limits = F.broadcast(self.thresholds.select(F.col("_lang").alias("_limit_lang"), "_threshold"))
            joined = scored.join(limits, F.col(self.lang).eqNullSafe(F.col("_limit_lang")), "left").drop("_limit_lang")
            joined = joined.withColumn("_threshold", F.coalesce("_threshold", F.lit(self.pooled).cast("double")))
        fine = F.col("_threshold").isNull() | (F.col("_perplexity") <= F.col("_threshold"))
        return joined.withColumn("_keep", F.col("_perplexity").isNotNull() & fine)


def trusted_ids(labels: DataFrame, ident: str) -> Column | DataFrame:
    """Ids all of whose labels say good and not toxic."""
    return (
        labels.filter(F.col(ident).isNotNull())
        .groupBy(F.col(ident).alias("_id"))
        .agg(F.min(F.coalesce("quality", F.lit(0))).alias("_q"), F.max(F.coalesce("toxic", F.lit(1))).alias("_t"))
        .filter("_q = 1 and _t = 0")
        .select("_id")
    )


def bad_ids(labels: DataFrame, ident: str) -> DataFrame:
    """Ids that a label gives a quality of 0."""
    return labels.filter(F.col(ident).isNotNull() & (F.col("quality") == 0)).select(F.col(ident).alias("_id")).distinct()


def checked_limits(scored: DataFrame, min_rows: int) -> DataFrame:
    """(_lang, _threshold) of the languages that have ``min_rows`` trusted (_good) and as many bad
    rows: the limit at which the share of trusted rows lost and of bad rows kept is least together. It
    lies half-way, in logarithms, to the next perplexity above."""
    binned = scored.groupBy("_lang", F.floor(F.log("_perplexity") * BINS).alias("bin"))
    binned = binned.agg(F.count(F.when(F.col("_good"), 1)).alias("good"), F.count(F.when(~F.col("_good"), 1)).alias("bad"))
    every, up = Window.partitionBy("_lang"), Window.partitionBy("_lang").orderBy("bin")  # some thousand bins a language
    upto = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_good, n_bad = F.sum("good").over(every), F.sum("bad").over(every)
    wrong = F.try_divide(F.sum("bad").over(upto), n_bad) - F.try_divide(F.sum("good").over(upto), n_good)
    end = F.col("bin") + 1
    limit = F.exp((end + F.coalesce(F.lead("bin").over(up), end)) / (2 * BINS))
    found = binned.select("_lang", "bin", wrong.alias("wrong"), limit.alias("_threshold"), n_good.alias("n_good"), n_bad.alias("n_bad"))
    found = found.filter((F.col("n_good") >= min_rows) & (F.col("n_bad") >= min_rows))
    return found.groupBy("_lang").agg(F.min_by("_threshold", F.struct("wrong", "bin")).alias("_threshold"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_docs: int | None = None,
    quantile: float = 0.995,
    slack: float = 1.5,
    languages: int = 1024,
    min_trusted: int = 30,
    whole: bool = False,
) -> Classifier:
    """Train on all trusted documents (whole texts) and set the thresholds from the perplexities of all of
    them. With ``train_docs`` only that many are trained on, those of lowest id hash.

    The threshold of a language is ``slack`` times the ``quantile`` of its trusted documents. It is
    made for the ``languages`` with most trusted documents that have ``min_trusted`` of them; any
    other language, null included, has the threshold of all trusted documents together. Without a
    trusted document there is no threshold and every document with a word is kept.

    With ``whole`` n-grams run across word borders, and a language with ``min_trusted`` trusted and as
    many bad documents (a label of quality 0) takes the limit that tells these apart best instead, as do
    all other languages together if the labels have so many. No bad document is trained on; toxic ones
    of quality 1 have no part in the limit. Two models are trained, each on the chosen documents of one
    half of the ids, and every document, chosen or not, is scored by the model of the other half: limits
    and verdicts rest on texts that their model has not seen, however many are trusted.
    """
    import uuid

    trusted = materialised(trusted_ids(labels, ident), "trusted")
    chosen = trusted if train_docs is None else trusted.orderBy(F.xxhash64("_id"), "_id").limit(train_docs)
    # one plan at every size: with few ids Spark would broadcast them, and its figures would not carry on
    texts = docs.select(ident, text).join(chosen.hint("merge"), F.col(ident) == F.col("_id"), "left_semi").select(F.col(text).cast("string").alias("t"), (half(ident) if whole else F.lit(1)).alias("half"))
    counts = materialised(count_ngrams(texts, whole), "counted-grams")  # the documents are read once for both models
    found = [probabilities(counts.filter(F.col("half") != h).select("gram", "c")) for h in ((0, 1) if whole else (0,))]
    model = Classifier([], uuid.uuid4().hex, ident, text, lang, whole)
    if max(p.count() + gamma.count() for p, gamma in found) > MODEL_ROWS:
        sides = [[side.withColumn("half", F.lit(h)) for h, side in enumerate(both)] for both in zip(*found)]
        model.tables = tuple(reduce(DataFrame.unionByName, both) for both in sides)
    else:
        model.shared = [packed(*both) for both in found]
    scored = model.perplexities(docs.select(ident, text, lang), [ident, lang]).filter("_perplexity is not null")
    scored = scored.withColumnRenamed(lang, "_lang")
    told = trusted.withColumn("_good", F.lit(True))
    if whole:
        told = told.unionByName(bad_ids(labels, ident).withColumn("_good", F.lit(False)))
    of_told = scored.join(told, scored[ident] == told["_id"]).select("_lang", "_perplexity", "_good")
    of_told = materialised(of_told, "trusted-perplexity")
    of_trusted = of_told.filter("_good")
    at = F.percentile_approx("_perplexity", quantile, 100_000) * slack
    model.pooled = of_trusted.agg(at).first()[0]
    limits = of_trusted.filter("_lang is not null").groupBy("_lang").agg(F.count("*").alias("_rows"), at.alias("_threshold"))
    limits = limits.filter(F.col("_rows") >= min_trusted).orderBy(F.desc("_rows"), "_lang").limit(languages)
    limits = limits.select("_lang", "_threshold")
    if whole:
        pooled = checked_limits(of_told.withColumn("_lang", F.lit("")), min_trusted).first()
        if pooled:  # a language with too few bad rows takes the limit of all together
            model.pooled = pooled["_threshold"]
            limits = limits.withColumn("_threshold", F.lit(model.pooled).cast("double"))
        checked = checked_limits(of_told.filter("_lang is not null"), min_trusted).withColumnRenamed("_threshold", "_checked")
        limits = limits.join(checked, "_lang", "left").select("_lang", F.coalesce("_checked", "_threshold").alias("_threshold"))
    model.thresholds = materialised(limits, "thresholds")
    return model


def classify(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", lang: str = "lang", **options) -> DataFrame:
    """(ident, lang, n_signs, perplexity, threshold, keep), one row per row of ``docs``.

    A document without words (null, empty or white space) has a null perplexity and isn't kept.
    Repeated rows are judged each; a label without id is ignored, null labels count as bad.
    """
    model = fit(docs, labels, ident=ident, lang=lang, **options)
    judged = model.judged(model.perplexities(docs, [ident, lang]))
    return judged.select(
        ident, lang, F.col("_n").alias("n_signs"), F.col("_perplexity").alias("perplexity"),
        F.col("_threshold").alias("threshold"), F.col("_keep").alias("keep"),
    )
