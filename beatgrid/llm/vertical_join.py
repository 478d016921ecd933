"""Jaccard self-join over word shingles by vertical partitioning.

Shingles (64-bit hashes) have one global order. First come those that no other document has: a pass
over all texts leaves a table of bits in which every shingle of two documents is marked (and a few
others by chance). The marked ones follow, cut into four fragments by their leading bits; within the
first fragment the ones that many documents share come last, otherwise hashes ascend. Two documents
can only reach the threshold if they share a shingle in their prefixes, so a document whose prefix is
all its own has no link. The overlap of a candidate pair is counted fragment by fragment, each count
on its own, and summed per pair. The first fragment, about a quarter of each set, is kept from the
first pass; its count rules most pairs out, and only the texts of the others are read again.

Documents of equal sets are one class. Groups of near copies are linked by stars first: in each
prefix list the classes of other components are compared with one member of the list's largest
component, so no list is expanded into all its pairs. The first star's centre is the member with the
fewest shingles of its own, which is nearest to all others; the next ones have other centres, as
long as stars go on to find links. Afterwards every remaining candidate pair across two components
is compared, which makes the components exact whatever the stars found.

The tables of bits and the list of shingles that many documents share are staged, and read by the
tasks; the driver holds none of them. Staged tables are removed as soon as what replaces them is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import few_tasks, join_unique, pieces, worker_cache
from beatgrid.llm.graph import components
from beatgrid.llm.store import random_access
from beatgrid.llm.words import SPACED, shingles, split
from beatgrid.sources.files import discard, materialised

#: A shingle in more prefixes than this goes to the end of the order; of so many prefix entries at
#: least one may, which bounds the list of such shingles to a million.
OFTEN, MOST_SHARED = 8, 1 << 20
FRAGMENT_BITS = 2
#: Bits of the table of shared shingles (16 MB), its files, and shingles that a task sorts at a time.
SHARED_BITS, BIT_FILES, FLUSH = 27, 8, 1_000_000
#: Hashes below this are in the first fragment (as signed numbers, those from 0 to here).
FIRST = 1 << (64 - FRAGMENT_BITS)
#: Stretches of the order, by leading bits, whose shared shingles are counted for each set.
STRETCH_BITS = 5
#: Words of the bit table that marks documents with candidates (64 bits each).
MARK_WORDS = 1 << 18
#: Stars at most, and how many in turn may link less than a quarter of the pairs they compare.
STARS, POOR_STARS = 6, 2
#: A class in more than this share of the pairs is spread over so many tasks.
HOT_SHARE, SALTS = 128, 64


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first shingles of a set two sets at the threshold cannot both miss."""
    return n - (percent * n + 99) // 100 + 1


class Sets:
    """The sets of some texts, one after the other, each ordered by hash."""

    def __init__(self, texts: pa.Array, size: int):
        s, row = shingles(split(texts, SPACED), size)
        edges = np.searchsorted(row, np.arange(len(texts) + 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            s[a:b].sort()
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
        self.s, self.row = s[new], row[new]
        self.first = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.n = np.diff(self.first)

    def classes(self) -> np.ndarray:
        """A 64-bit digest of each set."""
        raw, edges = self.s.tobytes(), (8 * self.first).tolist()
        parts = (hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(edges[:-1], edges[1:]))
        return np.frombuffer(b"".join(parts), "<i8")

    def lists(self, keep: np.ndarray, values: np.ndarray | None = None) -> pa.ListArray:
        """Some entries of each set as a list column."""
        offsets = np.concatenate([[0], np.cumsum(np.bincount(self.row[keep], minlength=len(self.n)))]).astype(np.int32)
        values = self.s[keep] if values is None else values
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _held(table: DataFrame, read: Callable[[pa.Table], np.ndarray]) -> Callable[[], np.ndarray]:
    """What ``read`` makes of a staged table of bounded size: each worker reads its files once."""
    files = table.inputFiles()
    name, columns = files[0], table.columns

    def held() -> np.ndarray:
        tables = worker_cache("join")
        if name not in tables:
            tables.clear()
            parts = []
            for file in files:
                with random_access(file) as opened:
                    parts.append(pq.read_table(opened, columns=columns))
            tables[name] = read(pa.concat_tables(parts))
        return tables[name]

    return held


def _staged_bits(rows: DataFrame, size: int) -> DataFrame:
    """(place, marks), staged: a bit for each value of the leading SHARED_BITS bits of a hash, set if two
    rows have a shingle with these. Each task deals its shingles out by their leading bits, 32 bits each
    and packed; what is dealt to one place is sorted, and repeated values set bits."""
    parts = rows.rdd.getNumPartitions()
    bits = min(SHARED_BITS - 6, max(6, (2 * parts - 1).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("join")  # other operators' caches go
        held, n = [], 0

        def dealt() -> pa.RecordBatch:
            s, counts = np.unique(np.concatenate(held), return_counts=True)
            s = np.repeat(s, np.minimum(counts, 2))  # twice is all that matters
            edges = np.searchsorted(s, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            low = ((s >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
            values = [low[a:b].tobytes() for a, b in zip(edges, [*edges[1:], len(low)])]
            return pa.RecordBatch.from_arrays([pa.array(np.arange(1 << bits, dtype=np.int32)), pa.array(values, pa.binary())], ["place", "packed"])

        for batch in batches:
            for piece in pieces(batch, 0):
                held.append(Sets(piece.column(0), size).s)
                n += len(held[-1])
                if n >= FLUSH:
                    yield dealt()
                    held, n = [], 0
        if n:
            yield dealt()

    def repeated(key: tuple, group: pa.Table) -> pa.Table:
        values = np.sort(np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in group.column("packed")]))
        twice = np.unique(values[1:][values[1:] == values[:-1]] >> np.uint32(32 - (SHARED_BITS - bits)))
        marks = np.zeros(1 << (SHARED_BITS - bits), bool)
        marks[twice] = True
        packed = np.packbits(marks, bitorder="little").tobytes()
        return pa.table({"place": pa.array([key[0].as_py()], pa.int32()), "marks": pa.array([packed], pa.binary())})

    found = rows.select("t").mapInArrow(deal, "place int, packed binary").groupBy("place").applyInArrow(repeated, "place int, marks binary")
    dealt_out = materialised(found, "bits")
    shared = materialised(dealt_out.coalesce(BIT_FILES), "shared-bits")  # 16 MB at any size
    discard(dealt_out)
    return shared


def _bit_table(found: pa.Table) -> np.ndarray:
    """The bits of ``_staged_bits``, packed."""
    out = np.zeros(1 << (SHARED_BITS - 3), np.uint8)
    for place, marks in zip(found.column("place").to_pylist(), found.column("marks")):
        values = np.frombuffer(marks.as_buffer(), np.uint8)
        out[place * len(values) : (place + 1) * len(values)] = values
    return out


def _shared_bits(rows: DataFrame, size: int) -> np.ndarray:
    """The table that the tasks read; the join doesn't read it on the driver."""
    return _held(_staged_bits(rows, size), _bit_table)()


def _is_shared(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    at = (s >> np.uint64(64 - SHARED_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _sets(rows: DataFrame, size: int, percent: int, shared: DataFrame) -> DataFrame:
    """(ident, n, cls, m, parts, low): of each row, with the number m of shared shingles in its set, and
    in each stretch of the order. low holds those in the first fragment and, where these are fewer,
    what else the prefix needs; it is empty if the prefix has no shared shingle."""

    table = _held(shared, _bit_table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table()
        for batch in batches:
            for piece in pieces(batch):
                sets = Sets(piece.column(1), size)
                some = _is_shared(bits, sets.s)
                total = np.concatenate([[0], np.cumsum(some)])
                m = total[sets.first[1:]] - total[sets.first[:-1]]
                reach = m - (sets.n - prefix_length(sets.n, percent))  # shared shingles in the prefix
                rank = total[:-1] - total[sets.first[:-1]][sets.row]
                keep = some & (reach[sets.row] > 0) & ((sets.s < np.uint64(FIRST)) | (rank < reach[sets.row]))
                cell = (sets.row[some] << STRETCH_BITS) + (sets.s[some] >> np.uint64(64 - STRETCH_BITS)).astype(np.int64)
                parts = np.bincount(cell, minlength=piece.num_rows << STRETCH_BITS).astype(np.int32)
                edges = (np.arange(piece.num_rows + 1) << STRETCH_BITS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), pa.array(sets.n, pa.int64()), pa.array(sets.classes()), pa.array(m, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(parts)), sets.lists(keep),
                    ],
                    ["ident", "n", "cls", "m", "parts", "low"],
                )

    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(run, f"ident {kind}, n bigint, cls bigint, m bigint, parts array<int>, low array<bigint>")


def _prefixes(sets: DataFrame, percent: int, often: DataFrame) -> DataFrame:
    """(cls, n, m, parts, prefix): the shared shingles of each prefix, in the global order."""

    table = _held(often, lambda found: np.sort(found.column("s").to_numpy().view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = table()
        for batch in batches:
            n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            low = batch.column(4)
            s = low.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.asarray(low.value_lengths()).astype(np.int64)
            first, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
            place = np.where(s < np.uint64(FIRST), 0, 2)
            if len(late) and len(s):
                hot = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                place = np.where(hot & (place == 0), 1, place)
            order = np.argsort(3 * row + place, kind="stable")  # hashes ascend already
            keep = np.arange(len(s)) - first[row] < (m - n + prefix_length(n, percent))[row]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(n)))]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(s[order[keep]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], prefix], ["cls", "n", "m", "parts", "prefix"])

    rows = sets.select("cls", "n", "m", "parts", "low")
    return rows.mapInArrow(run, "cls bigint, n bigint, m bigint, parts array<int>, prefix array<bigint>")


def _segments(rows: DataFrame, size: int, words: DataFrame) -> DataFrame:
    """(cls, fragment, part) beyond the first fragment, of the rows that the bit table marks (and a few
    others by chance)."""

    table = _held(words, _mark_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = table()
        for batch in batches:
            for piece in pieces(batch):
                some = piece.filter(pa.array(_marked(marks, piece.column(2).to_numpy(zero_copy_only=False))))
                if not some.num_rows:
                    continue
                sets = Sets(some.column(1), size)
                beyond = sets.s >= np.uint64(FIRST)
                s, row = sets.s[beyond], sets.row[beyond]
                part = (s >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)
                key = (row << FRAGMENT_BITS) + part
                at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
                offsets = np.append(at, len(key)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.classes()[row[at]]), pa.array(part[at].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(s.view(np.int64))),
                    ],
                    ["cls", "fragment", "part"],
                )

    return rows.mapInArrow(run, "cls bigint, fragment int, part array<bigint>")


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for k in range(3):
        bit = (keys.view(np.uint64) >> np.uint64(20 * k)) % np.uint64(64 * len(marks))
        out &= (marks[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out


def _staged_marks(keys: DataFrame, rows: int) -> DataFrame:
    """(word, bits), staged: bits of the long column ``key``, three each, of ``rows`` keys at most; of bounded
    size whatever the number of keys."""
    bits = F.explode(F.array(*[F.pmod(F.shiftrightunsigned("key", 20 * k), F.lit(64 * MARK_WORDS)) for k in range(3)]))
    words = keys.select(bits.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    return materialised(few_tasks(words, min(3 * rows, MARK_WORDS)), "marks")


def _mark_bits(words: pa.Table) -> np.ndarray:
    """The bits of ``_staged_marks``."""
    out = np.zeros(MARK_WORDS, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def _mark_table(keys: DataFrame) -> np.ndarray:
    """The table that the tasks read; the join doesn't read it on the driver."""
    return _held(_staged_marks(keys, MARK_WORDS), _mark_bits)()


def _met(pairs: DataFrame, parts: DataFrame, hot: DataFrame) -> DataFrame:
    """Pairs with the parts of both sides, fragment by fragment: columns px and py. The classes in
    ``hot`` are spread over several tasks."""
    salted = pairs.join(F.broadcast(hot), "y", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("x"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    )
    left = salted.drop("hot").join(parts.select(F.col("cls").alias("x"), "fragment", F.col("part").alias("px")), "x")
    right = parts.select(F.col("cls").alias("y"), "fragment", F.col("part").alias("py")).join(F.broadcast(hot), "y", "left")
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("salt", F.explode(salts)).drop("hot")
    return left.join(right, ["y", "fragment", "salt"]).drop("salt")


def _linked(pairs: DataFrame, rows: DataFrame, sets: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y, nx, ny, mx, my) that reach the threshold, as edges (a, b)."""
    total = pairs.count()
    pairs = few_tasks(pairs, total)
    hot = pairs.groupBy("y").count().filter(F.col("count") > max(1000, total // HOT_SHARE)).select("y", F.lit(True).alias("hot"))
    hot = materialised(hot.limit(HOT_SHARE), "hot")

    def named(df: DataFrame) -> DataFrame:
        ids = df.select(F.explode(F.array("x", "y")).alias("cls")).distinct()
        return ids.join(classes.select("cls", "least"), "cls")

    near = named(pairs).select(F.col("cls").alias("_cls"), "least")
    first = sets.join(near, (F.col("cls") == F.col("_cls")) & F.col("ident").eqNullSafe(F.col("least")))
    inside = F.filter("low", lambda s: (s >= 0) & (s < FIRST))
    first = first.select("cls", F.lit(0).alias("fragment"), inside.alias("part")).dropDuplicates(["cls"])
    first = materialised(few_tasks(first, 2 * total), "first-fragment")
    both = _met(pairs, first, hot)
    both = both.withColumn("common", F.size(F.array_intersect("px", "py")))
    most = F.col("common") + F.least(F.col("mx") - F.size("px"), F.col("my") - F.size("py"))
    both = both.filter(most * 100 >= (F.col("nx") + F.col("ny") - most) * percent)
    left = materialised(few_tasks(both.select("x", "y", "nx", "ny", "common"), total), "left")
    discard(first)

    marks = _staged_marks(named(left).select(F.xxhash64("least").alias("key")), 2 * total)
    more = materialised(_segments(rows.withColumn("key", F.xxhash64("ident")), size, marks), "fragments")
    discard(marks)
    both = _met(left.select("x", "y"), more, hot)
    partial = both.select("x", "y", "fragment", F.size(F.array_intersect("px", "py")).alias("part"))
    # a fragment may be there twice (repeated rows), so one count for each
    partial = partial.groupBy("x", "y", "fragment").agg(F.max("part").alias("part"))
    partial = partial.groupBy("x", "y").agg(F.sum("part").alias("more"))
    summed = left.join(partial, ["x", "y"], "left").withColumn("common", F.col("common") + F.coalesce("more", F.lit(0)))
    reached = F.col("common") * 100 >= (F.col("nx") + F.col("ny") - F.col("common")) * percent
    links = materialised(few_tasks(summed.filter(reached).select(F.col("x").alias("a"), F.col("y").alias("b")), total), "links")
    discard(hot, left, more)
    return links


def _with_components(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Prefix entries with the component of their class."""
    return entries.join(found, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


def _largest(entries: DataFrame, turn: int, rows: int) -> DataFrame:
    """(s, best, member, size), of ``rows`` entries: of each list with several components, the largest and a member of it,
    and the list's length. The member is the one with the fewest shingles of its own in the first
    turn, and drawn by its hash in the others, alike in all lists."""
    rank = F.col("m") - F.col("n") if turn == 0 else F.xxhash64("cls", F.lit(turn))
    member = F.struct(rank.alias("rank"), "m", "cls", "n", "pos", "parts")
    by = entries.groupBy("s", "comp").agg(F.count("*").alias("k"), F.max(member).alias("member"))
    best = by.groupBy("s").agg(
        F.max(F.struct("k", "member", "comp")).alias("top"), F.sum("k").alias("size"), F.count("*").alias("comps")
    )
    best = few_tasks(best.filter("comps > 1"), rows).select("s", F.col("top.comp").alias("best"), F.col("top.member").alias("member"), "size")
    return materialised(best, "largest")


def _possible(x: dict[str, Column], y: dict[str, Column], percent: int) -> Column:
    """Sizes that the threshold allows, enough shared shingles from a first common one on, and enough
    that can be common in all stretches together."""
    nx, ny = x["n"], y["n"]
    asked = F.ceil((nx + ny) * percent / (100 + percent) - 1e-9)
    left = F.least(x["m"] - x["pos"], y["m"] - y["pos"])
    most = F.aggregate(F.zip_with(x["parts"], y["parts"], lambda a, b: F.least(a, b)), F.lit(0), lambda a, b: a + b)
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (left >= asked) & (most >= asked)


def _columns(form: str) -> dict[str, Column]:
    return {c: F.col(form.format(c)) for c in ("n", "m", "pos", "parts")}


def _star_pairs(entries: DataFrame, percent: int, turn: int, rows: int) -> DataFrame:
    """Each class outside its lists' largest components with the member that most of its lists name."""
    lists = _largest(entries, turn, rows)
    named = join_unique(entries, lists, "s", "size", "inner").filter("comp <> best")
    named = named.filter(_possible(_columns("{}"), _columns("member.{}"), percent))
    keys = [F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("m").alias("mx")]
    keys += [F.col("member.cls").alias("y"), F.col("member.n").alias("ny"), F.col("member.m").alias("my")]
    votes = named.groupBy(*keys).agg(F.count("*").alias("votes"))
    first = votes.groupBy("x", "nx", "mx").agg(F.max(F.struct("votes", "y", "ny", "my")).alias("top"))
    first = first.select("x", F.col("top.y").alias("y"), "nx", F.col("top.ny").alias("ny"), "mx", F.col("top.my").alias("my"))
    pairs = materialised(few_tasks(first, rows), "pairs")
    discard(lists)
    return pairs


def _cross_pairs(entries: DataFrame, percent: int, rows: int) -> DataFrame:
    """All candidate pairs of two components."""
    lists = _largest(entries, 0, rows)
    inside = materialised(few_tasks(join_unique(entries, lists.drop("member"), "s", "size", "inner"), rows), "lists")
    outer = inside.filter("comp <> best").select("s", *[F.col(c).alias(f"{c}_x") for c in ("cls", "n", "m", "pos", "parts", "comp")])
    pairs = outer.join(inside.withColumn("outer", F.col("comp") != F.col("best")), "s").filter(
        "comp <> comp_x and (not outer or cls > cls_x)"
    )
    pairs = pairs.filter(_possible(_columns("{}_x"), _columns("{}"), percent))
    one, two = (F.struct(*[F.col(c.format(k)).alias(k) for k in ("cls", "n", "m")]) for c in ("{}_x", "{}"))
    pairs = pairs.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    pairs = pairs.select(
        F.col("a.cls").alias("x"), F.col("b.cls").alias("y"), F.col("a.n").alias("nx"), F.col("b.n").alias("ny"),
        F.col("a.m").alias("mx"), F.col("b.m").alias("my"),
    )
    pairs = materialised(pairs, "pairs")
    discard(lists, inside)
    return pairs


def join_documents(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    size: int = 3,
    percent: int = 90,
    stars: int = STARS,
) -> DataFrame:
    """(ident, n_shingles, component_id), one row per row of ``docs``.

    A row's set are the distinct ``size``-word shingles of its text (A-Z lower-cased, words between
    white space), or its whole word sequence if that is shorter. Rows link when 100 times the
    intersection is at least ``percent`` times the union; component_id is the least id reachable.
    Null and empty texts have an empty set and link with nothing, not even each other. Repeated rows
    link by their equal sets; null ids are never a least id unless a component has no other. Other
    columns are not read. Sets and shingles are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("t"))
    shared = _staged_bits(rows, size)
    sets = materialised(_sets(rows, size, percent, shared), "sets")
    discard(shared)
    classes = materialised(sets.filter("n > 0").groupBy("cls").agg(F.min("ident").alias("least"), F.first("n").alias("n"), F.count("*").alias("rows")), "classes")

    entries = sets.select(F.explode("low").alias("s")).filter((F.col("s") >= 0) & (F.col("s") < FIRST // 2))
    total = sets.agg(F.coalesce(F.sum(F.size("low")), F.lit(0))).first()[0]
    bound = max(OFTEN, total // MOST_SHARED)
    often = entries.groupBy("s").count().filter(F.col("count") > bound).select("s")
    often = materialised(few_tasks(often, total // (bound + 1)), "often")  # MOST_SHARED rows at most

    prefixes = _prefixes(sets.filter(F.size("low") > 0), percent, often).groupBy("cls")
    prefixes = materialised(prefixes.agg(*[F.first(c).alias(c) for c in ("n", "m", "parts", "prefix")]), "prefixes")
    entries = prefixes.select("cls", "n", "m", "parts", F.posexplode("prefix").alias("pos", "s"))
    lists = materialised(entries.groupBy("s").agg(F.count("*").alias("size")).filter("size > 1"), "lists")
    entries = materialised(join_unique(entries, lists, "s", "size", "inner").drop("size"), "entries")
    discard(often, prefixes, lists)

    n = entries.count()
    links, found = None, spark.createDataFrame([], "cls bigint, comp bigint")
    turn, poor = 0, 0
    while True:
        last = turn == stars or poor == POOR_STARS
        placed = materialised(few_tasks(_with_components(entries, found), n), "placed")
        pairs = _cross_pairs(placed, percent, n) if last else _star_pairs(placed, percent, turn, n)
        discard(placed)
        asked = pairs.count()
        more = _linked(pairs, rows, sets, classes, size, percent) if asked else None
        discard(pairs)
        linked = more.count() if asked else 0
        if linked:
            links = more if links is None else links.unionByName(more)
            before, found = found, materialised(components(links).toDF("cls", "comp"), "components")
            discard(before)
        if last:
            break
        # a list whose chosen member is out of the question may still hold other links
        turn, poor = turn + 1, poor + 1 if 4 * linked < asked or not asked else 0
    discard(entries)
    return _result(sets, classes, found).withColumnRenamed("ident", ident)


def _result(sets: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The least id of each row's component."""
    of_class = classes.join(found, "cls", "left").select("cls", "least", "rows", F.coalesce("comp", "cls").alias("comp"))
    of_class = materialised(of_class, "classes")
    roots = materialised(of_class.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("k")), "roots")
    rooted = join_unique(of_class.select("cls", "rows", "comp"), roots, "comp", "k", "inner").select("cls", "rows", "component_id")
    rows = sets.select("ident", F.col("n").alias("n_shingles"), "cls")
    some = join_unique(rows.filter("n_shingles > 0"), materialised(rooted, "rooted"), "cls", "rows", "inner")
    none = rows.filter("n_shingles = 0").withColumn("component_id", F.col("ident"))
    return some.select("ident", "n_shingles", "component_id").unionByName(none.select("ident", "n_shingles", "component_id"))
