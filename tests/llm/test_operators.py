"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beatgrid.llm import (
    block_search,
    common,
    graph,
    kneser_ney,
    lm_scoring,
    packing,
    pii,
    token_counts,
    token_files,
    vertical_join,
    warc,
    wu_manber,
)
from beatgrid.llm.common import join_unique
from beatgrid.llm.graph import components
from beatgrid.llm.tokens import HashTable, PieceCoder, vocabulary
from tests.llm import plain

#: Extra columns whose names operators use inside.
CLASH = "ident long, n_tokens string, start string, _row long, h string, t string, cls string, hot string, comp string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(0)
    base = [words(rng, rng.randint(1, 60)) for _ in range(25)]
    near = []
    for k in range(5):  # groups of near copies
        w = words(rng, 80).split(" ")
        for _ in range(6):
            v = list(w)
            v[rng.randrange(len(v))] = "zz"
            near.append(" ".join(v))
        near.append(" ".join(w))
    out = [*base, *near, base[3], base[3], base[4].upper(), "", "", None, "one", "One", "two words", " \n\t ", words(rng, 9000)]
    out += ["Café, ÀÉ İ <|endoftext|> x.y", "x" * 30_000, "a\xa0b c", "mail a.b@c.de, +1 (486) 555-3535 or 10.0.0.1; 4111 1111 1111 1111"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    extra = [None] * 9
    return spark.createDataFrame([(i, t, *extra) for i, t in texts], f"doc_id long, text string, {CLASH}").repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, quality int, toxic int, item_id long")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_join_unique_with_hot_and_null_keys(spark):
    left = spark.createDataFrame([(1 if i % 3 else (None if i % 2 else i), i) for i in range(3000)], "k long, v long")
    right = left.filter("k % 2 = 1").groupBy("k").agg(F.count("*").alias("n"))
    got = rows(join_unique(left, right, "k", "n"), "k", "v", "n")
    assert got == rows(left.join(right, "k", "left"), "k", "v", "n")
    assert rows(join_unique(left, right, "k", "n", "inner"), "k", "v") == rows(left.join(right, "k"), "k", "v")


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)] + [(7, 3), (3, 7), (5, 5)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(10, 41), 10), **dict.fromkeys(range(100, 130), 100), 3: 3, 7: 3}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_token_files(docs, texts, nothing):
    repeated = docs.unionByName(docs.filter("doc_id = 2")).unionByName(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    got = token_files.token_files(repeated, shard_ids=3000).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    order = [(None, texts[5][1]), *[x for x in texts for _ in range(2 if x[0] == 2 else 1)]]
    start, want = 0, []
    for (key, _), ids in zip(order, plain.ids([t for _, t in order])):
        want.append((key, start, len(ids) + 1, plain.crc([*ids, 2])))
        start += len(ids) + 1
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_files.token_files(nothing).count() == 0


def test_token_files_hold_every_id(spark, docs, texts, tmp_path):
    from beatgrid.llm.store import random_access

    manifest = token_files.write_token_files(docs, str(tmp_path / "ids"), shard_ids=2000)
    got = {}
    for row in manifest.collect():
        with random_access(row.path) as source:
            shard = token_files.ShardReader(source)
            assert shard.ids(1, 3).tolist() == shard.ids(0, 5).tolist()[1:3]
            got |= {int(shard.ident[k]): ids.tolist() for k, ids in shard.documents()}
    assert got == {i: [*ids, 2] for (i, _), ids in zip(texts, plain.ids([t for _, t in texts]))}


def test_packing(docs, texts, nothing):
    got = packing.pack_documents(docs.unionByName(docs.filter("doc_id < 3"))).collect()
    want = []
    for (key, _), ids in zip(texts, plain.ids([t for _, t in texts])):
        ids = [*ids, 0]
        want += [(key, k // 2048, k, len(ids[k : k + 2048]), plain.crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)] * (1 + (key < 3))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for content in by.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) == -(-sum(r.length for r in got) // 2048)
    assert packing.pack_documents(nothing).count() == 0


def test_token_counts(docs, texts, nothing):
    want = [(i, len((t or "").encode()), len(x), len(x) > 2048) for (i, t), x in zip(texts, plain.ids([t for _, t in texts]))]
    for size in (4, 65_536):
        assert rows(token_counts.count_tokens(docs, table_size=size), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=str)
    assert token_counts.count_tokens(nothing).count() == 0


def test_token_counts_of_a_sentencepiece_model(docs, texts):
    from sentencepiece import SentencePieceProcessor

    path = vocabulary("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    got = rows(token_counts.count_tokens(docs, path), "doc_id", "n_tokens")
    assert got == sorted(((i, len(library.encode(t or ""))) for i, t in texts), key=str)


def test_language_model(spark, docs, texts, nothing):
    scored = lm_scoring.score_documents(docs, top=20, head=8, bands=2, train_docs=10)
    got = {r.doc_id: r for r in scored.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts}
    tokens = {i: [*plain.spaced(t), None] for i, t in texts}
    c = Counter(w for i, x in tokens.items() if not out[i] for w in x)
    total = sum(c.values())
    for i, x in tokens.items():
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in x)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(x), sum(c[w] > 0 for w in x), total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert len(got) == len(texts) and lm_scoring.score_documents(nothing).count() == 0
    untrained = lm_scoring.score_documents(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")).collect()
    assert [(r.held_out, r.train_tokens, r.n_known, r.score) for r in untrained] == [(True, 0, 0, 0.0)] * 2


def test_language_model_learns_what_follows(spark):
    rng = random.Random(0)
    data = [(i, " ".join("abcdefgh"[(k + s) % 8] for k in range(rng.randint(30, 60)))) for i, s in enumerate(rng.choices(range(8), k=400))]
    got = lm_scoring.score_documents(spark.createDataFrame(data, "doc_id long, text string")).filter("held_out")
    mean = got.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert mean[0] > 0.5 * mean[1]  # each letter follows from the one before


def test_jaccard_join(docs, texts, nothing):
    again = docs.unionByName(docs.filter("doc_id in (3, 30)"))
    for size, percent in ((3, 80),):
        want = plain.jaccard_components(dict(texts), size, percent)
        got = vertical_join.join_documents(again, size=size, percent=percent).collect()
        assert len(got) == len(texts) + 2
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert vertical_join.join_documents(nothing).count() == 0


def test_jaccard_join_of_chains_and_common_passages(spark):
    """Links that only a chain of near copies connects, and documents that share a passage but don't link."""
    rng = random.Random(1)
    passage, data, chain = words(rng, 60), [], words(rng, 60).split(" ")
    for i in range(120):
        data.append((i, f"{words(rng, rng.randint(5, 40))} {passage} {words(rng, rng.randint(5, 40))}"))
    for i in range(12):
        chain[5 * i] = f"q{i}"
        data.append((200 + i, " ".join(chain)))
    got = vertical_join.join_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(4), percent=80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain.jaccard_components(dict(data), 3, 80)


def test_jaccard_join_of_a_large_group_of_which_few_link(spark, monkeypatch):
    rng = random.Random(7)
    base = words(rng, 150).split(" ")
    data = {}
    for i in range(1000):  # two or three changed words: most pairs share their prefixes, few link
        w = list(base)
        for at in rng.sample(range(len(w)), 2 + i % 2):
            w[at] = f"own{i}x{at}" if i % 10 else f"few{i % 70}x{at % 5}"
        data[i] = " ".join(w)
    compared = []
    linked = vertical_join._linked
    monkeypatch.setattr(vertical_join, "_linked", lambda pairs, *rest: (compared.append(pairs.count()), linked(pairs, *rest))[1])
    got = vertical_join.join_documents(spark.createDataFrame(list(data.items()), "doc_id long, text string").repartition(4))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain.jaccard_components(data, 3, 90)
    assert sum(compared) < 20 * len(data)  # of half a million


def test_jaccard_join_when_no_list_names_a_possible_partner(spark):
    for seed in (0, 1, 6, 11):
        w = words(random.Random(seed), 16).split(" ")
        data = {i: " ".join(w[: n + 2]) for i, n in enumerate((9, 10, 12, 14))}
        got = vertical_join.join_documents(spark.createDataFrame(list(data.items()), "doc_id long, text string"))
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain.jaccard_components(data, 3, 90), seed


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=4).round(1)]) for i in range(200)]
    data += [(300 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]
    data += [(400, None), (401, []), (402, [0.0] * 4), (403, [1.0, None, 1.0, 1.0]), (404, [1.0, float("nan"), 1.0, 1.0]), (405, [float("inf")] * 4), (None, [1.0] * 4), (440, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, 1) for x in data], "vec_id long, embedding array<float>, id int")
    usable = {i: np.array(v, np.float32).astype(float) for i, v in data if i is not None and i < 400 and np.abs(v).max() > 0}
    want = []
    for q in (i for i in usable if i % 20 == 0):
        s = sorted(((-float(np.dot(usable[q], v)), i) for i, v in usable.items() if i != q))[:20]
        want += [(q, r + 1, i) for r, (_, i) in enumerate((round(x, 9), i) for x, i in s)]
    for limit in (40, 4_000_000):
        got = block_search.search(df, F.col("vec_id") % 20 == 0, pass_values=limit)
        assert rows(got, "query_id", "rank", "vec_id") == sorted(want, key=str)
    assert block_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_personal_data(docs, texts, nothing):
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, t in texts:
        base = plain.personal(t)
        counts = Counter(k for k, _, _ in base)
        r = got[i]
        assert [r[f"n_{k}"] for k in plain.PATTERNS] == [counts[k] for k in plain.PATTERNS]
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) | {""}
    assert pii.find(nothing).count() == 0
    last = pii.redact(docs).filter(f"doc_id = {len(texts) - 1}").first().text
    assert last == "mail [EMAIL], [PHONE] or [IP]; [CARD]"


def test_field_adds_spans_that_no_pattern_has(spark):
    df = spark.createDataFrame([(1, "é call (555) 123-4567 now\nin 2023 about 12,500 people")], "doc_id long, text string")
    row = pii.find(df).first()
    assert (row.n_phone, row.spans) == (0, "phone:7:21")


def test_decontamination(spark, docs, texts, nothing):
    items = [(1, texts[26][1]), (1, "two words"), (2, None), (3, " .,"), (None, "one"), (4, "ONE"), (5, " ".join(texts[30][1].split(" ")[3:40])), (6, "café")]
    table = spark.createDataFrame([(*x, "c") for x in items], "item_id long, text string, doc_id string")
    want = plain.contamination(dict(texts), items, 10)
    for limit in (400_000, 15):  # in one pass, and in several
        got = wu_manber.decontaminate(docs, table, pass_words=limit).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == want
        assert all(r.contaminated == (r.n_hit > 0) for r in got)
    assert wu_manber.decontaminate(nothing, table).count() == 0
    assert wu_manber.decontaminate(docs, nothing).filter("n_hit > 0 or contaminated").count() == 0


def test_quality_like_the_plain_model(spark, texts):
    few = [(i, t, "aa" if i % 2 else "bb") for i, t in texts if t is None or len(t) < 2000]
    docs = spark.createDataFrame(few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(20, 0, 0), (21, 1, 1), (22, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")

    def discounts(n1, n2, n3, n4):
        if min(n1, n2, n3) > 0:
            y = n1 / (n1 + 2 * n2)
            found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            if all(0 < d < i for d, i in zip(found, (1, 2, 3))):
                return found
        return 0.5, 1.0, 1.5

    want = plain.kneser_ney([t for i, t, _ in few if i < 20], [t or "" for _, t, _ in few], kneser_ney.ORDER, discounts)
    result = {r.doc_id: r for r in kneser_ney.classify(docs, labels, min_trusted=8, quantile=0.5, slack=1.1).collect()}
    for (i, _, lang), p in zip(few, want):
        r = result[i]
        assert (r.perplexity is None) == (p is None) and (p is None or abs(r.perplexity - p) < 1e-9 * p)
        assert r.keep == (p is not None and p <= r.threshold)
    for lang in ("aa", "bb"):
        trusted = sorted(result[i].perplexity for i, _, x in few if i < 20 and x == lang)
        assert {r.threshold for r in result.values() if r.lang == lang} == {trusted[math.ceil(0.5 * len(trusted)) - 1] * 1.1}


def test_quality_across_words_is_scored_by_the_other_halfs_model(spark, texts):
    few = [(i, t, "aa") for i, t in texts if t is None or len(t) < 2000]
    docs = spark.createDataFrame(few, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    halves = {r.doc_id: r.h for r in docs.select("doc_id", kneser_ney.half("doc_id").alias("h")).collect()}
    got = {r.doc_id: r for r in kneser_ney.classify(docs, labels, whole=True, min_trusted=8, quantile=0.5, slack=1.1).collect()}

    def discounts(n1, n2, n3, n4):
        if min(n1, n2, n3) > 0:
            y = n1 / (n1 + 2 * n2)
            found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            if all(0 < d < i for d, i in zip(found, (1, 2, 3))):
                return found
        return 0.5, 1.0, 1.5

    assert len(got) == len(few) and set(halves.values()) == {0, 1}
    for h in (0, 1):
        mine = [(i, t or "") for i, t, _ in few if halves[i] == h]
        train = [t for i, t, _ in few if i < 30 and halves[i] != h]
        for (i, _), p in zip(mine, plain.kneser_ney(train, [t for _, t in mine], kneser_ney.ORDER, discounts, whole=True)):
            assert (got[i].perplexity is None) == (p is None) and (p is None or abs(got[i].perplexity - p) < 1e-9 * p)
    trusted = sorted(got[i].perplexity for i in range(30))
    assert {r.threshold for r in got.values()} == {trusted[14] * 1.1}


@pytest.mark.parametrize("whole", [True, False])
def test_quality_of_models_too_large_to_share(spark, texts, monkeypatch, whole):
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate([*texts[:60], None, "", "  "])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    options = dict(whole=whole, min_trusted=8, quantile=0.5, slack=1.1)
    held = {r.doc_id: r for r in kneser_ney.classify(docs, labels, **options).collect()}
    monkeypatch.setattr(kneser_ney, "MODEL_ROWS", 10, raising=False)
    monkeypatch.setattr(kneser_ney, "packed", lambda *_: pytest.fail("the model is held whole"))
    got = {r.doc_id: r for r in kneser_ney.classify(docs, labels, **options).collect()}
    assert got.keys() == held.keys()
    for i, r in got.items():
        assert (r.lang, r.n_signs, r.keep) == (held[i].lang, held[i].n_signs, held[i].keep)
        assert (r.perplexity, r.threshold) == (held[i].perplexity and pytest.approx(held[i].perplexity), pytest.approx(held[i].threshold))


@pytest.mark.parametrize("whole", [True, False])
def test_quality_model_does_not_pass_through_the_driver(spark, texts, monkeypatch, whole):
    docs = spark.createDataFrame([(i, t, "a") for i, t in texts[:60]], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    for owner, name in ((type(docs), "toPandas"), (type(docs), "toArrow"), (type(spark.sparkContext), "broadcast")):
        monkeypatch.setattr(owner, name, lambda *_: pytest.fail("the model is held by the driver"))
    kept, plain = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: kept.append(plain(df)) or kept[-1])
    assert kneser_ney.classify(docs, labels, whole=whole, min_trusted=8).count() == 60
    assert sum(map(len, kept)) < 50


def test_bit_tables_of_the_join_take_few_jobs(spark):
    """However many partitions there are; each was fetched by a job of its own."""
    rows = spark.range(200).select(F.col("id").alias("ident"), F.concat_ws(" ", F.lit("a b c"), F.col("id").cast("string")).alias("t"))
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "60"}
    before = {k: spark.conf.get(k) for k in held}
    spark.sparkContext.setJobGroup("bit tables", "")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        bits, marks = vertical_join._shared_bits(rows, 3), vertical_join._mark_table(keys)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("bit tables")) < 10
    same = np.unpackbits(bits).sum()
    assert same == 1  # only "a b c" is shared
    assert vertical_join._marked(marks, np.array([r.key for r in keys.collect()], np.int64)).all()


def test_tables_of_the_join_do_not_pass_through_the_driver(spark, monkeypatch):
    """The tasks read the bit tables and the list of frequent shingles from staged files."""
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(i, f"{text} end{i}") for i in range(12)] + [(20, "some other words"), (21, "some other words"), (22, None)], "doc_id long, text string")
    for owner, name in ((type(docs), "toPandas"), (type(docs), "toArrow"), (type(spark.sparkContext), "broadcast")):
        monkeypatch.setattr(owner, name, lambda *_: pytest.fail("a table is held by the driver"))
    got = vertical_join.join_documents(docs, stars=1).collect()
    assert {r.doc_id: r.component_id for r in got} == dict.fromkeys(range(12), 0) | {20: 20, 21: 20, 22: 22}


def test_components_of_few_edges_take_few_tasks(spark):
    edges = spark.range(600).select((2 * F.col("id") + 1).alias("a"), (2 * F.col("id")).alias("b"))
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "60"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = components(edges)
        assert found.rdd.getNumPartitions() < 20
        assert rows(found, "node", "component") == sorted(((i, i // 2 * 2) for i in range(1200)), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quality_counts_without_the_caches_of_other_operators(spark):
    """Workers outlive a stage of the pipeline; before they count they give up what packing kept."""

    class Texts:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        def groupBy(self, *_):
            return self

        agg = groupBy

    texts = kneser_ney.count_ngrams(Texts(), whole=True)
    common.worker_cache("tokens")["vocabulary"] = "pieces"
    assert list(texts.run(iter([]))) == []
    assert "tokens" not in common._CACHES


def test_quality_and_packing_hold_little_beside_their_tables(spark, monkeypatch):
    """On texts of 8 MB a worker needs few times the bytes of a small piece, and its tables begin small."""
    rng = random.Random(1)
    texts = [words(rng, 2000) for _ in range(1000)]
    made, peaks = [], {}
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, run, schema: made.append(run) or spark.createDataFrame([], schema))
    docs = spark.createDataFrame([], "doc_id long, t string, text string, half int")
    kneser_ney.count_ngrams(docs.select("t", "half"), whole=True)
    model = kneser_ney.Model(HashTable(1), np.zeros(1), HashTable(1), np.zeros(1))
    scorer = kneser_ney.Scorer(model, whole=True)
    assert scorer.table.size < 1 << 12 and PieceCoder(vocabulary()).table.size < 1 << 12
    monkeypatch.setattr(kneser_ney, "_scorer", lambda *_: scorer)
    kneser_ney.Classifier([([], [])], "few", whole=True).perplexities(docs, ["doc_id"])
    packing.cut(docs)
    ids, texts = pa.array(range(1000), pa.int64()), pa.array(texts)
    for name, run, columns in zip(("count", "score", "cut"), made, ([texts, pa.array([i % 2 for i in range(1000)], pa.int32())], [ids, texts], [ids, texts])):
        batch = pa.RecordBatch.from_arrays(columns, ["a", "b"])
        tracemalloc.start()
        try:
            assert sum(out.num_rows for out in run(iter([batch]))) > 0
            peaks[name] = tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()
    assert max(peaks.values()) < 40, peaks


def test_quality_counts_all_trusted_documents(spark, monkeypatch):
    """No sample of trusted documents: every one of 7,000 is counted."""
    docs = spark.range(7000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.lit("x").alias("lang"))
    labels = spark.range(7000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    seen, plain = [], kneser_ney.probabilities
    monkeypatch.setattr(kneser_ney, "probabilities", lambda c: seen.append(c.agg(F.max("c")).first()[0]) or plain(c))
    kneser_ney.fit(docs, labels, whole=True)
    assert len(seen) == 2 and sum(seen) == 7000


def test_quality_without_labels_or_documents(docs, nothing):
    with_lang = docs.withColumn("lang", F.lit(None).cast("string"))
    got = kneser_ney.classify(with_lang, nothing).collect()
    assert all(r.threshold is None and r.keep == (r.perplexity is not None) for r in got)
    assert kneser_ney.classify(nothing, nothing).count() == 0


def test_quality_of_repeated_and_shuffled_words(spark):
    """Labelled rows with one word over and over are told apart, and the order of words is seen."""
    rng = random.Random(4)
    good = [" ".join(rng.choice(["ab cde fa.", "bcd eff ga.", "dad gab be."]) for _ in range(30)) for _ in range(60)]
    bad = [f"{rng.choice(t.split())} " * 60 for t in good]
    turned = [" ".join(reversed(t.split())) for t in good[:3]]
    data = [(i, t, "xx" if i % 2 else "yy") for i, t in enumerate([*good, *bad, *turned])]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    result = {r.doc_id: r for r in kneser_ney.classify(docs, labels, whole=True, min_trusted=20).collect()}
    assert all(result[i].keep for i in range(60)) and not any(result[i].keep for i in range(60, 120))
    assert all(result[120 + i].perplexity > 1.5 * result[i].perplexity for i in range(3))


def test_archives(spark, nothing):
    long, short = "é" + "x" * 1500, "y" * 300
    pages = [(1, "http://a/ü b", long), (2, "http://b", long), (3, None, long), (4, "u", short), (5, "u", short), (6, "u", None), (7, "u", ""), (None, "u", long), (3, "v", long), (9, "w", "z\r\n\r\n" * 400)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, payload_digest string")
    got = warc.archive_pages(df, archive_bytes=2000)
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        revisit = html == long and i != 3
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    empty = nothing.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("lang").alias("html"))
    assert warc.archive_pages(empty).count() == 0


def test_normaliser_reads_plain_members_and_long_records(tmp_path):
    import gzip
    import json

    records = [warc.record(i, "u", bytes([i]) * (3_000_000 if i == 1 else 5), hashlib.sha1(bytes([i])).hexdigest(), "response", None) for i in range(3)]
    source, target = str(tmp_path / "a.warc.gz"), str(tmp_path / "b.warc.gz")
    with open(source, "wb") as out:
        out.write(gzip.compress(records[0] + records[1]) + gzip.compress(records[2]))
    assert warc.normalise_file(source, target)[0] == 3
    raw = open(target, "rb").read()
    entries = [json.loads(x) for x in open(target + ".idx")]
    assert [gzip.decompress(raw[e["offset"] : e["offset"] + e["length"]]) for e in entries] == records
    with open(source, "wb") as out:
        out.write(gzip.compress(records[0][:-20]))
    with pytest.raises(ValueError):
        warc.normalise_file(source, target)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 61, 250, 1000, 1 << 20])
def test_normaliser_at_every_read_boundary(tmp_path, monkeypatch, chunk):
    """Members of one, several and parts of records, empty members, padding; and every kind of cut."""
    import gzip
    import json

    monkeypatch.setattr(warc, "CHUNK", chunk)
    records = [warc.record(i, "u", bytes([i]) * n, hashlib.sha1(bytes([i])).hexdigest(), "response", None) for i, n in enumerate((5, 900, 0, 2500, 40))]
    half = len(records[3]) // 2
    members = [records[0] + records[1], b"", records[2] + records[3][:half], records[3][half:], records[4]]
    source, target = str(tmp_path / "a.warc.gz"), str(tmp_path / "b.warc.gz")
    packed = [gzip.compress(m) for m in members]
    for pad in (b"", b"\0" * 300):
        with open(source, "wb") as out:
            out.write(b"".join(m + pad for m in packed))
        assert warc.normalise_file(source, target)[0] == 5
        raw = open(target, "rb").read()
        entries = [json.loads(x) for x in open(target + ".idx")]
        assert [gzip.decompress(raw[e["offset"] : e["offset"] + e["length"]]) for e in entries] == records
    whole = b"".join(packed)
    for cut in (len(whole) - 1, len(whole) - 8, len(whole) - len(packed[-1]) - 3, len(packed[0]) - 9, 5):
        with open(source, "wb") as out:
            out.write(whole[:cut])
        with pytest.raises(ValueError):
            warc.normalise_file(source, target)


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(3)
    good = [words(rng, 80) for _ in range(30)]
    item = words(rng, 14)
    docs = [(i, t, "en") for i, t in enumerate(good)]
    docs += [(30, good[0], "en"), (31, good[1] + " zz", "en"), (32, f"{good[2][:40]} {item} {words(rng, 30)}", "en"), (33, "%%$ #@!! ^^&* ((_ " * 20, "en")]
    docs += [(34, words(rng, 50) + " a.b@c.de", "en"), (35, None, "en"), (5, good[5], "en"), (5, words(rng, 40), "en")]
    spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        columns, docs = docs.columns, spark.read.parquet(str(tmp_path / f"out{k}"))
        kept.append(sorted(r.doc_id for r in docs.collect()))
        assert k == 4 or docs.columns == columns
    every = [*range(30), 5, 5, 30, 31, 32, 34]
    assert kept[0] == sorted(every)
    assert kept[1] == sorted([*range(30), 5, 32, 34])
    assert kept[2] == sorted([*range(30), 5, 34]) == kept[3]
    assert set(kept[4]) == set(kept[3])
    texts = {r.doc_id: (r.text, r.n_chars) for r in spark.read.parquet(str(tmp_path / "out3")).collect()}
    assert texts[34][0].endswith(" [EMAIL]") and texts[34][1] == len(texts[34][0])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert rows(whole, "doc_id", "piece", "length") == rows(docs, "doc_id", "piece", "length")
