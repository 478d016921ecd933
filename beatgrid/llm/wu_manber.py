"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of ``size`` consecutive item words (a shorter item is one shorter
window). For windows of one length, a table gives each block of two words the distance by which a
position that ends in this block can be moved on without missing a window; blocks that end a window
have distance 0 and lead to the bucket of the windows with that suffix, which are compared word by
word. All texts of a piece are searched side by side: each has a cursor, and one array operation
moves all cursors on. Items are searched in sets of a bounded number of words, one pass each.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces
from beatgrid.llm.words import ALNUM, Words, hashes, mixed, split
from beatgrid.sources.files import materialised

#: Words of items that one pass searches for; bounds what is broadcast to about 100 bytes a word.
PASS_WORDS = 400_000
#: Texts are searched in stretches of this many words (plus a window), so that no cursor runs long.
STRETCH = 512


@dataclass
class Windows:
    """Distinct windows of one length and their tables."""

    words: np.ndarray  # (windows, length) word hashes, ordered by the key of the last block
    key: np.ndarray  # that key
    item_first: np.ndarray  # items of window i: item[item_first[i]:item_first[i + 1]]
    item: np.ndarray
    block: np.ndarray  # ordered keys of all blocks in windows
    shift: np.ndarray  # how far a position that ends in such a block can move on
    farthest: int  # the distance for any other block


def block_keys(words: np.ndarray, width: int) -> np.ndarray:
    """Key of the block of ``width`` words (1 or 2) that ends at each place of the last axis."""
    if width == 1:
        return words
    return mixed(words[..., :-1] * np.uint64(0x9FB21C651E98DF25) + words[..., 1:])


def build(windows: list[tuple[tuple[int, ...], int]], length: int) -> Windows:
    """Tables for (word hashes, item) pairs of one length."""
    of: dict[tuple[int, ...], set[int]] = {}
    for w, item in windows:
        of.setdefault(w, set()).add(item)
    words = np.array(list(of), np.uint64).reshape(-1, length)
    items = [sorted(x) for x in of.values()]
    width = min(2, length)
    keys = block_keys(words, width)
    order = np.argsort(keys[:, -1], kind="stable")
    words, keys, items = words[order], keys[order], [items[i] for i in order]
    shift = np.broadcast_to(np.arange(keys.shape[1])[::-1], keys.shape)
    flat, place = keys.ravel(), np.lexsort((shift.ravel(), keys.ravel()))
    block, first = np.unique(flat[place], return_index=True)
    return Windows(
        words, keys[:, -1], np.cumsum([0, *map(len, items)]), np.array([i for x in items for i in x], np.int64),
        block, shift.ravel()[place][first].astype(np.int64), length - width + 1,
    )


def occurrences(h: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(end word, window) of every occurrence; ``first`` has each text's first word and, last, their number."""
    length = windows.words.shape[1]
    width = min(2, length)
    # cursors: stretches of long texts overlap by a window less one word
    counts = np.diff(first)
    n = np.where(counts >= length, -(-(counts - length + 1) // STRETCH), 0)
    row = np.repeat(np.arange(len(counts)), n)
    low = first[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * STRETCH
    stop = np.minimum(low + STRETCH + length - 1, first[1:][row])
    at = low + length - 1
    keys = block_keys(h, width)
    found_end, found_window = [], []
    while len(at):
        key = keys[at - width + 1]
        place = np.minimum(np.searchsorted(windows.block, key), len(windows.block) - 1)
        known = windows.block[place] == key
        shift = np.where(known, windows.shift[place], windows.farthest)
        zero = np.flatnonzero(shift == 0)
        if len(zero):
            end = at[zero]
            left = np.searchsorted(windows.key, key[zero], side="left")
            size = np.searchsorted(windows.key, key[zero], side="right") - left
            which = np.repeat(left, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            end = np.repeat(end, size)
            same = (h[end[:, None] + np.arange(1 - length, 1)] == windows.words[which]).all(axis=1)
            found_end.append(end[same])
            found_window.append(which[same])
            shift[zero] = 1
        at = at + shift
        going = at < stop
        if not going.all():
            at, stop = at[going], stop[going]
    if not found_end:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_end), np.concatenate(found_window)


def _item_sets(items: DataFrame, ident: str, text: str, size: int, limit: int) -> Iterator[tuple[list, list[Windows]]]:
    """Item ids and window tables, for sets of items of about ``limit`` words."""

    def made(ids: list, windows: dict) -> tuple[list, list[Windows]]:
        return ids, [build(x, length) for length, x in sorted(windows.items())]

    ids: list = []
    places: dict = {}
    windows: dict[int, list] = {}
    held = 0
    rows = items.select(F.col(ident).cast("string").alias("i"), F.col(text).cast("string").alias("t"))
    for row in rows.filter("i is not null and t is not null").toLocalIterator():
        h = hashes(split(pa.array([row.t]), ALNUM)).tolist()
        if not h:
            continue
        place = places.setdefault(row.i, len(ids))
        if place == len(ids):
            ids.append(row.i)
        length = min(size, len(h))
        windows.setdefault(length, []).extend((tuple(h[k : k + length]), place) for k in range(len(h) - length + 1))
        held += len(h)
        if held >= limit:
            yield made(ids, windows)
            ids, places, windows, held = [], {}, {}, 0
    yield made(ids, windows)


def hits(words: Words, h: np.ndarray, tables: list[Windows]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word is hit, text, item): the last two are distinct pairs."""
    hit = np.zeros(len(h) + 1, np.int64)
    pairs = []
    row = words.row()
    for windows in tables:
        end, which = occurrences(h, words.first, windows)
        np.add.at(hit, end - windows.words.shape[1] + 1, 1)
        np.add.at(hit, end + 1, -1)
        size = windows.item_first[which + 1] - windows.item_first[which]
        at = np.repeat(windows.item_first[which], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        pairs.append(np.stack([np.repeat(row[end], size), windows.item[at]], axis=1))
    both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    return np.cumsum(hit)[:-1] > 0, both[:, 0], both[:, 1]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    item_ident: str = "item_id",
    item_text: str = "text",
    size: int = 10,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """(ident, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``.

    Null and empty texts have no words and no hits. Items that are null, empty or without an id
    are no patterns; items of one id count once, equal windows of several items count for each.
    Other columns are not read. With more than ``pass_words`` item words the documents are read
    once for each set of items, and the passes are merged per document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    sets = _item_sets(items, item_ident, item_text, size, pass_words)
    first = next(sets)
    second = next(sets, None)
    if second is None:
        out = _search(spark, rows, kind, first, final=True)
    else:
        out = _merged(spark, rows, kind, [first, second], sets)
    return out.withColumn("contaminated", F.col("n_hit") > 0).withColumnRenamed("ident", ident)


def _digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def _search(spark, rows: DataFrame, kind: str, made: tuple[list, list[Windows]], final: bool) -> DataFrame:
    """One pass: the final columns, or those that several passes can be merged from."""
    shared = spark.sparkContext.broadcast(zlib.compress(pickle.dumps(made), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tables = pickle.loads(zlib.decompress(shared.value))
        none = _digest([])
        for batch in batches:
            for piece in pieces(batch):
                words = split(piece.column(1), ALNUM)
                hit, row, item = hits(words, hashes(words), tables)
                n = piece.num_rows
                names: list[list[str]] = [[] for _ in range(n)]
                for r, i in zip(row.tolist(), item.tolist()):
                    names[r].append(ids[i])
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[words.first[1:]] - total[words.first[:-1]]
                columns = [piece.column(0), pa.array(words.counts(), pa.int64()), pa.array(n_hit, pa.int64())]
                if final:
                    columns += [pa.array([len(x) for x in names], pa.int64()), pa.array([_digest(x) if x else none for x in names])]
                else:
                    marks = [np.flatnonzero(hit[a:b]).tolist() for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
                    columns += [pa.array(names, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["ident", "n_words", "n_hit", "n_items", "items_sha256"] if final else ["ident", "n_words", "n_hit", "names", "marks"])

    shape = "n_items bigint, items_sha256 string" if final else "names array<string>, marks array<int>"
    return rows.mapInArrow(run, f"ident {kind}, n_words bigint, n_hit bigint, {shape}")


def _merged(spark, rows: DataFrame, kind: str, made: list, more: Iterator) -> DataFrame:
    """Several passes over staged, numbered documents; only documents with hits are merged."""
    numbered = materialised(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    again = numbered.select("_row", "text")
    passes = None
    for one in [*made, *more]:
        found = _search(spark, again.toDF("ident", "text"), "bigint", one, final=False).filter("n_hit > 0")
        found = found.select(F.col("ident").alias("_row"), "names", "marks")
        passes = found if passes is None else passes.unionByName(found)
    merged = passes.groupBy("_row").agg(
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"),
        F.array_distinct(F.flatten(F.collect_list("marks"))).alias("marks"),
    )
    sizes = _search(spark, again.toDF("ident", "text"), "bigint", ([], []), final=True)
    sizes = sizes.select(F.col("ident").alias("_row"), "n_words")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return (
        numbered.select("_row", "ident")
        .join(sizes, "_row")
        .join(merged, "_row", "left")
        .select(
            "ident",
            "n_words",
            F.coalesce(F.size("marks"), F.lit(0)).cast("bigint").alias("n_hit"),
            F.size(names).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(names), ","), 256).alias("items_sha256"),
        )
    )
