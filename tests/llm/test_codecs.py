"""Parts without Spark: words, token ids, Simple-8b, best-fit plans, the random field, the recurrent model."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beatgrid.llm import crf, gru, wu_manber
from beatgrid.llm.block_search import Coded, Heaps, search_tile
from beatgrid.llm.packing import Capacity, plan
from beatgrid.llm.pii import patterns
from beatgrid.llm.simple8b import decode_block, encode_block
from beatgrid.llm.tokens import HashTable, PieceCoder, vocabulary
from beatgrid.llm.words import ALNUM, SPACED, Words, hashes, shingles, split
from tests.llm import plain

SIGNS = list("abAZé漢09 \n\t-_.\x0b \xa0~")


@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(SIGNS), max_size=40)), max_size=5))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    for how, find in ((SPACED, plain.spaced), (ALNUM, plain.alnum)):
        words = split(pa.array(texts, pa.string()), how)
        got = [[words.text(i).decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])]
        assert got == [find(t) for t in texts]
        flat = [w for x in got for w in x]
        assert len(set(zip(hashes(words).tolist(), flat))) == len(set(flat)) == len(set(hashes(words).tolist()))


def test_long_words_hash_alike_everywhere():
    words = split(pa.array(["x" * 5_000_000 + " y", "y " + "x" * 5_000_000]), SPACED)
    h = hashes(words)
    assert h[0] == h[3] and h[1] == h[2] and h[0] != h[1]


def test_shingles_of_short_texts():
    s, row = shingles(split(pa.array(["a b c d", "a b", "", None, "A B"]), SPACED), 3)
    assert row.tolist() == [0, 0, 1, 4] and s[2] == s[3] and len(set(s.tolist())) == 3


def test_hash_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(1, 2**63, 5000, dtype=np.uint64))
    table = HashTable(len(keys))
    table.add(keys[:1000])
    table.add(keys[1000:])
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)].max() == -1


def test_hash_table_grows():
    keys = np.arange(1, 20_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    table = HashTable(1)
    for a, b in ((0, 10), (10, 511), (511, 513), (513, 9000), (9000, 20_000)):
        table.add(keys[a:b])
        assert table.size >= 2 * b  # before, a table was filled up and then sought a free place without end
        assert table.find(keys).tolist() == [*range(b), *[-1] * (20_000 - b)]


def test_hash_table_looks_up_few_keys_at_a_time():
    keys = np.arange(1, 1_000_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    table = HashTable(10)
    table.add(keys[:10])
    tracemalloc.start()
    try:
        found = table.find(keys)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[:10].tolist() == list(range(10)) and (found[10:] == -1).all()
    assert peak < 1.5 * found.nbytes


def test_words_across_hashed_regions():
    """Words that begin, end or reach beyond the bytes hashed at a time have the hashes they have alone."""
    sizes = [16_000, 384, 1, 16_383, 16_384, 16_385, 300_000, 5, 40_000]
    texts = [chr(ord("a") + i) * n for i, n in enumerate(sizes)]
    together = hashes(split(pa.array([" ".join(texts)]), SPACED))
    assert together.tolist() == [int(hashes(split(pa.array([x]), SPACED))[0]) for x in texts]


def test_bounds_of_all_softmaxes_are_found_at_once(monkeypatch):
    """One window takes two calls, for the classes and for the words of all classes, not one a class."""
    rng = np.random.default_rng(0)
    w = gru.initial(np.arange(640, 0, -1.0), np.ones(2))
    w.word_w += rng.normal(0, 0.1, w.word_w.shape).astype(np.float32)
    w.word_w[3, :, 0] = 5  # a maximum of each row is needed in this class
    bias, far = gru._below(w.word_w, w.word_b)
    assert far.tolist() == [k == 3 for k in range(10)]
    states = rng.uniform(-1, 1, (50, gru.HIDDEN)).astype(np.float32)
    for k in range(10):
        x = states.astype(np.float64) @ w.word_w[k] + w.word_b[k]
        want = x - np.logaddexp.reduce(x, axis=1)[:, None]
        assert np.allclose(gru._log_shares(states, w.word_w[k], bias[k], far[k], np.arange(50)), want[np.arange(50), np.arange(50)], atol=1e-3)
    calls, plain_below = [], gru._below
    monkeypatch.setattr(gru, "_below", lambda *a: calls.append(1) or plain_below(*a))
    cls, word = gru.units(640, 2)
    unit = rng.integers(0, 642, (4, 8))
    gru.gradients(w, np.zeros((4, gru.HIDDEN), np.float32), unit, np.ones((4, 8), bool), cls, word)
    assert len(calls) == 2


TOKEN_SIGNS = [*"aAİΣς'st  \n\t́̇é.,ßKI", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "漢", "word.", "Wo,", "​"]


@pytest.fixture(scope="module")
def coders():
    return plain.library(), PieceCoder(vocabulary()), PieceCoder(vocabulary(), 50, 200)


def test_ids_are_the_library_s(coders):
    library, whole, small = coders
    rng = random.Random(0)
    for _ in range(1500):
        texts = ["".join(rng.choice(TOKEN_SIGNS) for _ in range(rng.randint(0, 25))) for _ in range(3)]
        want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        for coder in (whole, small):
            ids, counts = coder.encode(pa.array([*texts, None]))
            assert ids.tolist() == sum(want, []) and counts.tolist() == [*map(len, want), 0]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(values):
    block = np.array(values, np.uint64)
    assert decode_block(encode_block(block), len(block)).tolist() == values


def test_simple8b_packs_small_values():
    assert len(encode_block(np.zeros(240, np.uint64))) == 2
    assert len(encode_block(np.full(60, 49_000, np.uint64))) == 20


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_plan_keeps_every_capacity(score):
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, 65, 20)}
        capacity = Capacity(64, int(rng.integers(1, 64)), 64 * 64, score=score)
        placed, sequences = {k: set() for k in lengths}, {}
        for length, rank, n, sequence, copies, offset in plan(lengths, capacity).tolist():
            for i in range(n):
                placed[length].add(rank + i)
                sequences.setdefault(sequence + i // copies, []).append((offset + i % copies * length, length))
        assert all(placed[k] == set(range(n)) for k, n in lengths.items())
        for content in sequences.values():
            ends = list(itertools.accumulate(n for _, n in sorted(content)))
            assert [o for o, _ in sorted(content)] == [0, *ends[:-1]] and ends[-1] <= 64
            assert len(content) <= capacity.docs and sum(n * n for _, n in content) <= capacity.cost


def test_plan_rejects_what_no_sequence_holds():
    with pytest.raises(ValueError):
        plan({65: 1}, Capacity(64, 10, 64 * 64))
    assert plan({}, Capacity()).shape == (0, 6)


def test_windows_are_found_like_by_comparison():
    rng = random.Random(0)
    for _ in range(60):
        letters, size = rng.choice([2, 3, 8]), rng.choice([1, 2, 3, 10])
        items = [[rng.randrange(letters) + 5 for _ in range(rng.randint(0, 14))] for _ in range(5)]
        texts = [[rng.randrange(letters) + 5 for _ in range(rng.choice([0, 3, 20, 1500]))] for _ in range(3)]
        windows: dict = {}
        for i, item in enumerate(items):
            n = min(size, len(item))
            for k in range(len(item) - n + 1 if n else 0):
                windows.setdefault(n, []).append((tuple(item[k : k + n]), i))
        first = np.cumsum([0, *map(len, texts)])
        flat = np.array(sum(texts, []), np.uint64)
        hit, row, item = wu_manber.hits(Words(None, None, None, first), flat, [wu_manber.build(x, n) for n, x in windows.items()])
        for t, text in enumerate(texts):
            want, names = [False] * len(text), set()
            for n, pairs in windows.items():
                for k in range(len(text) - n + 1):
                    found = {i for w, i in pairs if w == tuple(text[k : k + n])}
                    if found:
                        want[k : k + n] = [True] * n
                        names |= found
            assert hit[first[t] : first[t + 1]].tolist() == want and set(item[row == t].tolist()) == names


def test_patterns_are_those_of_the_expressions():
    rng = random.Random(0)
    kinds = list(plain.PATTERNS)
    for _ in range(8000):
        text = "".join(rng.choice("a.1@- +(2)b%é\n0,5") for _ in range(rng.randint(0, 40)))
        assert [(kinds[k], a, b) for k, a, b in patterns(text)] == plain.personal(text)
    assert patterns("4111 1111 1111 1111 and 4111 1111 1111 1112") == [(2, 0, 19)]
    assert patterns("9" * 6000) == [] and patterns("1.2.3." + "9" * 6000) == []


def test_field_on_lines_it_was_not_trained_on():
    model, right = crf.trained(), 0
    rows = crf.labelled_table(seed=99)
    words = split(pa.array([" ".join(w) for w, _ in rows]), crf.SPACED)
    number, names = crf.shapes(words)
    labels = crf.viterbi(model, number, names, words.first)
    for (_, want), a, b in zip(rows, words.first[:-1], words.first[1:]):
        right += labels[a:b].tolist() == want
    assert right / len(rows) > 0.95


def test_viterbi_is_the_best_of_all_labellings():
    model = crf.trained()
    words = split(pa.array(["a 12 b@c.d", "9", "", "1.2.3.4 +1 (2)"]), crf.SPACED)
    number, names = crf.shapes(words)
    got = crf.viterbi(model, number, names, words.first)
    scores, allowed = crf._scores(model.table(names), number, words.first), crf._allowed()
    for a, b in zip(words.first[:-1], words.first[1:]):
        ways = [
            p for p in itertools.product(range(len(crf.LABELS)), repeat=b - a)
            if b > a and crf._FIRST_OK[p[0]] and all(allowed[x, y] for x, y in zip(p, p[1:]))
        ]
        value = lambda p: sum(scores[a + i, y] for i, y in enumerate(p)) + sum(model.pairs[x, y] for x, y in zip(p, p[1:]))  # noqa: E731, B023
        assert not ways or tuple(got[a:b]) == max(ways, key=value)


def test_gradients_of_the_recurrent_model():
    rng = np.random.default_rng(0)
    w = gru.initial(np.array([5, 4, 3, 2, 1.0] * 20), np.array([3.0, 1.0]), hidden=3)
    w = gru.Weights(*[x.astype(np.float64) for x in w.arrays()])
    w.class_w += rng.normal(0, 0.3, w.class_w.shape)
    w.word_w += rng.normal(0, 0.3, w.word_w.shape)
    cls, word = gru.units(100, 2)
    unit, real, h = rng.integers(0, 102, (4, 6)), np.array([[1] * 6, [1] * 6, [1] * 3 + [0] * 3, [1] + [0] * 5], bool), rng.normal(0, 0.5, (4, 3))
    grads = gru.gradients(w, h, unit, real, cls, word)[0]
    for x, g in zip(w.arrays(), grads):
        for _ in range(10):
            at = tuple(rng.integers(0, s) for s in x.shape)
            if np.isfinite(x[at]):
                old, x[at] = x[at], x[at] + 1e-5
                up = gru.gradients(w, h, unit, real, cls, word)[2]
                x[at] = old - 1e-5
                down = gru.gradients(w, h, unit, real, cls, word)[2]
                x[at] = old
                assert abs((up - down) / 2e-5 / real.sum() - g[at]) < 1e-5


def test_score_does_not_depend_on_the_window_and_is_a_distribution():
    w = gru.initial(np.array([5, 4, 3, 2, 1.0] * 20), np.array([3.0, 1.0]))
    rng = np.random.default_rng(0)
    w.class_w += rng.normal(0, 0.3, w.class_w.shape).astype(np.float32)
    cls, word = gru.units(100, 2)
    unit, first = rng.integers(0, 102, 500), np.array([0, 0, 130, 140, 500])
    a, b = (gru.score(w, unit, first, cls, word, window=n) for n in (7, 1000))
    assert np.allclose(a, b, rtol=1e-5) and a[0] == 0
    state = rng.normal(0, 0.5, (1, gru.HIDDEN)).astype(np.float32)
    assert abs(np.exp(gru.log_probability(w, np.repeat(state, 102, 0), cls, word)).sum() - 1) < 1e-4


@pytest.mark.parametrize("size", [0.5, 40.0])
def test_log_probability_of_near_and_far_logits(size):
    """Logits close enough to need no maximum of each row, and such as do."""
    rng = np.random.default_rng(4)
    w = gru.initial(np.arange(100, 0, -1.0), np.array([3.0, 1.0]))
    w.class_w, w.word_w = (rng.normal(0, size, x.shape).astype(np.float32) for x in (w.class_w, w.word_w))
    cls, word = gru.units(100, 2)
    unit = rng.integers(0, 102, 5000)
    states = rng.uniform(-1, 1, (5000, gru.HIDDEN)).astype(np.float32)

    def plain(w_, b, h, target):
        x = h.astype(float) @ w_.astype(float) + b
        return x[target] - x.max() - np.log(np.exp(x - x.max()).sum())

    want = [plain(w.class_w, w.class_b, h, cls[u]) + (plain(w.word_w[cls[u]], w.word_b[cls[u]], h, word[u]) if word[u] >= 0 else 0) for h, u in zip(states, unit)]
    assert np.allclose(gru.log_probability(w, states, cls[unit], word[unit]), want, rtol=1e-4, atol=1e-4)


def test_log_probability_takes_logits_in_small_pieces():
    rng = np.random.default_rng(5)
    w = gru.initial(np.arange(2048, 0, -1.0), np.ones(6))
    cls, word = gru.units(2048, 6)
    unit = rng.integers(0, 2054, 200_000)
    states = rng.uniform(-1, 1, (len(unit), gru.HIDDEN)).astype(np.float32)
    tracemalloc.start()
    gru.log_probability(w, states, cls[unit], word[unit])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000


def test_tiles_find_the_nearest():
    rng = np.random.default_rng(0)
    for t in range(30):
        d, n = int(rng.integers(1, 20)), int(rng.integers(2, 300))
        v = np.round(rng.normal(size=(n, d)), int(rng.integers(0, 3)))
        v = v[np.abs(v).max(axis=1) > 0]
        if not len(v):
            continue
        if t % 3 == 0:
            v[len(v) // 3 :] = v[0]
        ids, k = rng.permutation(len(v)) * 2, int(rng.integers(1, 25))
        q = ids % 5 == 0
        queries, heaps = Coded(ids[q], v[q]), Heaps(int(q.sum()), k)
        for b in range(0, len(v), 50):
            for a in range(0, int(q.sum()), 7):
                search_tile(queries.part(a, a + 7), a, Coded(ids[b : b + 50], v[b : b + 50]), heaps)
        for j, i in enumerate(np.flatnonzero(q)):
            s = np.einsum("ij,ij->i", np.repeat(v[i][None], len(v), 0), v)
            want = [x for x in np.lexsort((ids, -s)) if x != i][:k]
            assert heaps.ids[j][heaps.score[j] > -np.inf].tolist() == ids[want].tolist()
