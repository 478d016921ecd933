"""Lines that many documents share, dropped from all but one of them; DataFrame functions only.

A line's key is the line without blanks at its ends and with A-Z lower-cased; keys travel as two 64-bit
hashes. Lines are dealt out by ranges of the first hash and sorted by hash, document (largest first)
and position, so one pass over each range sees a key's keeper first, then the rows to drop. What comes
back is a bitmap a document, not text: 64-bit words of kept lines, words in which all lines stay left
out. Keys that hold more than a 1024th of the lines, fewer than 1024 at any size, would fill ranges
of their own; their leading documents are found by a limit in front of the exchange and their rows are
marked where they are read. A sketch names them, and naming one or not does not change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.sources.files import materialised

#: Signs stripped from both ends of a line, and the letters that are lower-cased.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys with more than this share of all lines are handled apart; the sketch tracks ``TRACKED`` of them.
HOT = 1024
TRACKED = 10_000


def _all() -> Column:
    """A word whose lines all stay."""
    return F.lit(-1).cast("bigint")


def _texts(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(doc, copy, text): rows that agree in id and text agree in everything this module derives."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(ident).alias("doc"), F.xxhash64(whole).alias("copy"), whole.alias("text"))


def line_keys(docs: DataFrame, ident: str = "doc_id", text: str = "text", min_chars: int = 20) -> DataFrame:
    """(doc, copy, pos, h1, h2) of every line whose key has ``min_chars`` code points or more."""
    lines = _texts(docs, ident, text).select("doc", "copy", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    bare = F.btrim("line", F.lit(BLANKS))
    key = F.translate(bare, UPPER, LOWER)
    return lines.filter(F.length(bare) >= min_chars).select("doc", "copy", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def hot_hashes(lines: DataFrame) -> list[int]:
    """First hashes of keys with more than a ``HOT``-th of all lines, as far as the sketch knows them."""
    found = lines.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h1, {HOT}, {TRACKED})").alias("top"))
    rows = found.select("n", F.explode("top").alias("t")).filter(F.col("t.count") > F.col("n") / HOT)
    return [r[0] for r in rows.select("t.item").collect()]


def _streamed(lines: DataFrame, min_docs: int) -> DataFrame:
    """Rows to drop, from ranges of hashes sorted by hash, document and position."""
    order = [F.col("doc").desc_nulls_last()]
    ranges = lines.repartitionByRange("h1").sortWithinPartitions("h1", "h2", *order, "pos")
    key = Window.partitionBy("h1", "h2")
    seen = ranges.withColumn("nth", F.dense_rank().over(key.orderBy(*order)))
    docs = F.max("nth").over(key.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return seen.withColumn("docs", docs).filter((F.col("nth") > 1) & (F.col("docs") >= min_docs)).select("doc", "copy", "pos")


def _marked(lines: DataFrame, min_docs: int) -> DataFrame:
    """Rows to drop of few but frequent keys: their first documents are cut down before the exchange."""
    key = Window.partitionBy("h1", "h2").orderBy(F.col("doc").desc_nulls_last())
    first = lines.select("h1", "h2", "doc").withColumn("nth", F.dense_rank().over(key)).filter(F.col("nth") <= min_docs)
    keeper = first.groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.max("nth").alias("docs")).filter(F.col("docs") >= min_docs)
    rows = lines.join(F.broadcast(keeper.drop("docs")), ["h1", "h2"])  # fewer than HOT keys
    return rows.filter(~F.col("doc").eqNullSafe(F.col("keeper"))).select("doc", "copy", "pos")


def keep_bitmaps(docs: DataFrame, ident: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, copy, n_dropped, keep) of the documents that lose lines, where ``copy`` is the hash of the text.

    ``keep`` is an array of (word, bits) by word: bit i of word w tells whether line 64 w + i stays;
    lines of words that are not listed stay. A key held by ``min_docs`` documents or more stays in the
    one with the largest id only, there with all its lines. Rows with one id are one document; a null id
    counts as an id below all others.
    """
    # read for the sketch, for the bounds of the ranges and to be dealt out: texts are cut once
    lines = materialised(line_keys(docs, ident, text, min_chars), "line-keys")
    hot = hot_hashes(lines)
    is_hot = F.col("h1").isin(hot)
    gone = _streamed(lines.filter(~is_hot) if hot else lines, min_docs)
    if hot:
        gone = gone.unionByName(_marked(lines.filter(is_hot), min_docs))
    word, bit = F.shiftright("pos", 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos").bitwiseAND(63))
    words = gone.groupBy("doc", "copy", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    entry = F.struct("word", F.bitwise_not("bits").alias("bits"))
    return words.groupBy("doc", "copy").agg(
        F.sum(F.bit_count("bits")).cast("bigint").alias("n_dropped"), F.array_sort(F.collect_list(entry)).alias("keep")
    )


def _dense(keep: Column) -> Column:
    """All words up to the last one listed, as an array."""

    def upto(entry: Column, i: Column) -> Column:
        last = F.coalesce(F.get(keep, i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(_all(), entry["word"] - last - 1), F.array(entry["bits"]))

    return F.flatten(F.transform(keep, upto))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that ``keep`` leaves, joined again."""

    def rebuilt(both: Column) -> Column:
        def stays(_: Column, i: Column) -> Column:
            bits = F.coalesce(F.get(both["words"], F.shiftright(i, 6)), _all())
            return F.getbit(bits, i.bitwiseAND(63)) == 1

        return F.array_join(F.filter(both["lines"], stays), "\n")

    # a one-element array binds the lines and words once for all their elements
    parts = F.struct(F.split(text, "\n").alias("lines"), _dense(keep).alias("words"))
    return F.when(keep.isNull(), text).otherwise(F.get(F.transform(F.array(parts), rebuilt), F.lit(0)))


def deduplicate(docs: DataFrame, ident: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document: (ident, n_lines, n_dropped, keep, kept): the text without the lines it loses.

    A null or empty text is one empty line. Repeated rows stay, each treated alike; an empty table gives
    an empty result; other columns are not read. A text meets its bitmap by id and hash, by broadcast
    only where the planner finds the bitmaps small.
    """
    maps = materialised(keep_bitmaps(docs, ident, text, min_chars, min_docs), "keep-bitmaps")
    rows, maps = _texts(docs, ident, text), maps.withColumnsRenamed({"doc": "of", "copy": "of_copy"})
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("of_copy"))
    return rows.join(maps, same, "left").select(
        F.col("doc").alias(ident),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        "keep",
        kept_text(F.col("text"), F.col("keep")).alias("kept"),
    )
