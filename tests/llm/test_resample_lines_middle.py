"""Importance resampling, line dedup and fill-in-the-middle against plain versions on small tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.llm import boundaries, fill_middle, line_dedup, resampling
from tests.llm import plain

#: Extra columns whose names the operators use inside.
CLASH = "ident long, doc string, copy string, pos string, word string, h1 string, nth string, score string, rank string, keep string, of string"


def frame(spark, docs, parts=3):
    return spark.createDataFrame([(i, t, *[None] * 11) for i, t in docs], f"doc_id long, text string, {CLASH}").repartition(parts)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def by_text(values):
    return sorted(values, key=str)


@pytest.fixture(scope="module")
def docs():
    """Words of several scripts, nulls, repeated rows and ids, one very long text."""
    rng = random.Random(5)
    some = ["alpha", "Beta", "gämma", "δ", "x1", "7", "the", "AND", "…", "\x00b", "日本"]

    def text(n):
        return "".join(rng.choice(some) + rng.choice([" ", "-", "\n", ", ", "\t", "  "]) for _ in range(n))

    out = [(i, text(rng.randint(1, 70))) for i in range(80)]
    out += [(80, ""), (81, None), (82, " ,;\n"), (83, "word"), (84, text(60_000)), (85, "a" * 200_000), (86, "mid <S> mark"), (None, text(40)), (None, None)]
    return [*out, out[3], out[84], (7, text(30)), out[87]]


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ------------------------------------------------------------------ resampling


@pytest.mark.parametrize(("least", "most", "buckets", "share"), [(1, 1, 10_000, 10), (1, 3, 97, 50), (2, 2, 10, 100), (3, 4, 50, 0)])
def test_resampling_like_the_plain_version(spark, docs, least, most, buckets, share):
    target = [t for _, t in docs[:9]] + [None, "", "Alpha beta alpha"]
    how, draw = resampling.Features(least, most, buckets), resampling.Draw(share, 12, 7)
    items = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = resampling.resample(frame(spark, docs), items, how, draw)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain.resampled(docs, target, least, most, buckets, share, 12, 7)
    assert rows(got, *got.columns) == by_text(want)


def test_words_are_the_same_in_blocks_of_any_size(docs):
    for _, text in docs:
        raw = (text or "").encode()
        for block in (1, 7, 1 << 20) if len(raw) < 3000 else (4096, 1 << 20):
            assert [w for part in resampling.words(raw, block) for w in part] == [w.encode() for w in plain.alnum(text)]
            assert resampling.features(raw, resampling.Features(1, 3, 101), block) == resampling.features(raw, resampling.Features(1, 3, 101))


def test_equal_scores_are_ordered_by_id(spark):
    scored = spark.createDataFrame([(i, 5, 30, 0, -(i // 40)) for i in range(400)] + [(None, 5, 30, 0, 0), (999, 5, 3, 0, 7)], "doc_id long, n_features long, n_words long, weight long, score long")
    got = resampling.ranked(scored, F.col("n_words") >= 20, 13, "doc_id").collect()
    assert len(got) == 402
    # 52 of 401: the 41 of score 0 with the null id last, then 11 of score -1
    want = {**{i: i + 1 for i in range(40)}, None: 41, **{i: i + 2 for i in range(40, 51)}}
    assert {r.doc_id: r["rank"] for r in got if r["rank"]} == want


def test_resampling_prefers_the_target_and_takes_empty_tables(spark, nothing):
    rng = random.Random(2)
    kind = ["red green blue".split(), "one two three".split()]
    data = [(i, " ".join(rng.choices(kind[i % 2], k=30))) for i in range(2000)]
    items = spark.createDataFrame([(" ".join(kind[1] * 50),)], "text string")
    got = resampling.resample(frame(spark, data), items).filter("rank is not null").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 201))
    assert sum(r.doc_id % 2 for r in got) > 170
    alone = resampling.resample(frame(spark, data[:50]), nothing).collect()
    assert len(alone) == 50 and sum(r["rank"] is not None for r in alone) == 5
    assert resampling.resample(nothing, items).count() == 0 == resampling.resample(nothing, nothing).count()


# ------------------------------------------------------------------ lines


def line_docs():
    rng = random.Random(8)
    shared = [f"Shared line number {k} for many" for k in range(12)]
    out = []
    for i in range(150):
        lines = [f"own line {i} {k} of this document" for k in range(rng.randint(0, 4))]
        lines += [rng.choice([" ", "\t", "", "\r"]) + rng.choice([s, s.upper(), s.lower()]) + " " for s in rng.sample(shared, rng.randint(0, 5))]
        lines += ["short"] * rng.randint(0, 2) + [""] * rng.randint(0, 2)
        if i % 3 == 0:
            lines += ["A line that a third of all documents hold"] * rng.randint(1, 2)
        if i in (4, 90):
            lines.append("this one stands in two documents")
        if i in (4, 60, 90):
            lines.append("İstanbul ÄÖ: only A-Z are folded")
        rng.shuffle(lines)
        out.append((i, "\n".join(lines)))
    long = [f"line {k} of a very long document" for k in range(3000)] + [shared[k % 12] for k in range(5000)]
    out += [(200, "\n".join(long)), (201, "\n" * 200), (202, None), (203, ""), (204, shared[1]), (205, "\n".join([*long[:400], "tail"])), (206, "\n".join(long[300:700]))]
    out += [(None, f"{shared[0]}\n{shared[1]}\nend"), (None, shared[2]), out[5], out[5], out[156], (9, f"{shared[3]}\nanother text of id nine, not short")]
    return out


@pytest.mark.parametrize(("hot", "min_docs"), [(1024, 3), (4, 3), (200, 2), (4, 1)])
def test_line_dedup_like_the_plain_version(spark, monkeypatch, hot, min_docs):
    """With few, some and most shared lines handled as frequent ones."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    data = line_docs()
    got = line_dedup.deduplicate(frame(spark, data, 5), min_docs=min_docs)
    assert rows(got, "doc_id", "n_lines", "n_dropped", "kept") == by_text(plain.without_shared_lines(data, 20, min_docs))


def test_bitmaps_hold_only_words_with_dropped_lines(spark):
    data = [(i, "\n".join([f"own line {i} {k} of this document" for k in range(200)] + ["This line is in all of them"])) for i in range(3)]
    got = line_dedup.keep_bitmaps(frame(spark, data)).collect()
    assert {(r.doc, r.n_dropped, tuple(map(tuple, r.keep))) for r in got} == {(i, 1, ((3, ~(1 << 8)),)) for i in range(2)}


def test_line_dedup_stays_in_the_jvm_and_reuses_the_ranges(spark, nothing):
    lines = line_dedup.line_keys(frame(spark, line_docs()))
    plan = line_dedup._streamed(lines, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan and "Python" not in plan
    assert line_dedup.deduplicate(nothing).count() == 0


# ------------------------------------------------------------------ fill in the middle


def test_containers_and_select():
    rng = np.random.default_rng(0)
    for low, kind in (
        (np.sort(rng.choice(1 << 16, 900, replace=False)), boundaries.ArrayContainer),
        (np.sort(rng.choice(1 << 16, 30_000, replace=False)), boundaries.BitmapContainer),
        (np.arange(1 << 16), boundaries.RunContainer),
        (np.concatenate([np.arange(5, 900), np.arange(3000, 65_000)]), boundaries.RunContainer),
        (np.array([65_535]), boundaries.ArrayContainer),
    ):
        made = boundaries.container(low)
        assert isinstance(made, kind) and len(made) == len(low)
        assert made.nbytes() <= min(2 * len(low), 8192) or kind is boundaries.RunContainer
        assert made.select(np.arange(len(low))).tolist() == low.tolist()


def test_boundary_set_of_several_containers():
    rng = np.random.default_rng(1)
    values = np.unique(np.concatenate([rng.integers(0, 70_000, 20_000), np.arange(200_000, 330_000), rng.integers(1 << 20, 1 << 22, 3000)]))
    made = boundaries.BoundarySet()
    for part in np.split(values, np.sort(rng.choice(len(values), 40))):
        made.add(part)
    made.sealed()
    assert len(made) == len(values) and {type(c).__name__ for c in made.containers} == {"ArrayContainer", "RunContainer", "BitmapContainer"}
    assert (made.select(np.arange(len(values))) == values).all() and made.nbytes() < 2 * len(values)
    with pytest.raises(IndexError):
        made.select([len(values)])


def test_fill_in_the_middle_like_the_plain_version(spark, docs):
    cases = [*docs, *[(1000 + i, f"{'é' * i}<a{'b' * i}S>< P>\n{i}") for i in range(60)]]
    for how in (fill_middle.Form(), fill_middle.Form(seed=9, rate=100, spm=50)):
        got = fill_middle.transform(frame(spark, cases), how)
        want = []
        for i, t in cases:
            n, form, p, m, output = plain.filled(i, t, how.seed, how.rate, how.spm)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, t or "")]
            want.append((i, n, form, p, m, *sha, output))
        assert rows(got, *got.columns) == by_text(want)
        assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_borders_are_the_same_in_blocks_of_any_size(docs):
    import re

    for _, text in docs:
        text = text or ""
        want = [m.start() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)] + [len(text)]
        for block in (1, 5, 1 << 20) if len(text) < 3000 else (1 << 12, 1 << 20):
            made = fill_middle.borders(text.encode(), block)
            assert made.select(np.arange(len(made))).tolist() == want


def test_fill_in_the_middle_of_an_empty_table(nothing):
    assert fill_middle.transform(nothing).count() == 0
