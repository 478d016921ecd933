"""Linear-chain conditional random field over word shapes, in numpy.

Labels are outside, and begin and inside of each kind of personal data. A word's score for a label
is a sum of weights of its shape and of its neighbours' shapes; a weight for each pair of labels
joins neighbours. The weights maximise the conditional likelihood of a small labelled table, by
gradients from the forward-backward recursion; the best labels follow by Viterbi, for many lines
side by side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from beatgrid.llm.words import SPACED, Words, hashes, mixed, split

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in ("B", "I")))

#: The small labelled table: lines in which {kind} stands for a value, and plain lines with numbers.
LINES = (
    "write to {email} for details", "contact: {email} or {phone}", "{email}", "my mail is {email}, thanks", "mail {email} and {email} please",
    "call {phone} before noon", "tel. {phone}", "phone {phone}, fax {phone}", "{phone}", "you can reach me at {phone} today", "it was {phone} then",
    "the host {ip} did not answer", "from {ip} to {ip}", "{ip}", "logged in from {ip}, twice", "server {ip} is down",
    "card {card} was charged", "{card}", "pay with {card} now", "number {card}, valid", "the card {card} expires soon",
    "on 2023-05-17 at 10:30 we met", "chapter 12 of 34 pages", "version 2.0.1 came out in 2021", "a total of 1,250.75 was paid", "in 1999 and 2004",
    "room 101 on floor 3", "the ratio is 3.14 to 1", "it took 45 minutes", "5 + 7 is 12", "see section 4.2.1 below", "the 21st of 12", "item 00012345 of 99",
    "won 3-1 against them", "about 1500000 people", "pages 12-18 and 40-44", "id 7f3a9c is new", "a @ sign and a # sign", "@name wrote it", "100% of it",
    "plain words only here", "nothing to see in this line", "one two three four", "Call me later", "The card was lost", "Mail it to the host", "key=42 x2 a1b2c3",
)
ROUNDS = 6  # each line is filled in so many times


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _value(kind: str, rng) -> str:
    """A made-up value of a kind, in one of its usual forms."""
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    if kind == "email":
        local = letters(rng.integers(3, 9)) + rng.choice(["", ".", "_"]) + rng.choice(["", _digits(rng, 2)])
        return f"{local}{letters(2)}@{letters(rng.integers(3, 9))}{rng.choice(['', _digits(rng, 1)])}.{rng.choice(['com', 'org', 'example.com', 'co.uk'])}"
    if kind == "ip":
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        groups = [_digits(rng, 4) for _ in range(4)]
        return rng.choice([" ", "-", ""]).join(groups)
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return rng.choice(
        [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{_digits(rng, 2)} {a} {b} {c}", f"+{_digits(rng, 2)}{a}{b}{c}", f"{a}.{b}.{c}"]
    )


def labelled_table(seed: int = 0) -> list[tuple[list[str], list[int]]]:
    """(words, labels) of each training line."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(ROUNDS):
        for line in LINES:
            words, labels = [], []
            for part in line.split(" "):
                kind = next((k for k in KINDS if "{" + k + "}" in part), None)
                if kind is None:
                    words.append(part)
                    labels.append(0)
                    continue
                value = part.replace("{" + kind + "}", _value(kind, rng)).split(" ")
                words += value
                labels += [LABELS.index(f"B-{kind}")] + [LABELS.index(f"I-{kind}")] * (len(value) - 1)
            out.append((words, labels))
    return out


# --- shapes ---------------------------------------------------------------------------------------

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("9")
#: Longer shapes are told apart by their first so many bytes only.
SHAPE_BYTES = 24


def shapes(words: Words) -> tuple[np.ndarray, list[str]]:
    """Each word's number in a list of shapes. A shape is the word with letters and digits replaced
    by one sign each and runs of a sign shortened to one, and its number of digits (20 at most)."""
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), []
    signs = _SHAPE[words.data]
    same = np.concatenate([[False], signs[1:] == signs[:-1]])
    same[words.start] = False
    inside = np.zeros(len(signs) + 1, np.int32)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    keep = (np.cumsum(inside)[:-1] > 0) & ~same
    at = np.concatenate([[0], np.cumsum(keep)])
    digit = np.concatenate([[0], np.cumsum(signs == ord("9"))])
    n_digits = np.minimum(20, digit[words.end] - digit[words.start])
    short = signs[keep]
    start, end = at[words.start], at[words.end]
    cut = Words(short, start, np.minimum(end, start + SHAPE_BYTES), words.first)
    key = hashes(cut) + mixed(n_digits.astype(np.uint64) + np.uint64(1))
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return number, [f"{cut.text(i).decode()}/{n_digits[i]}" for i in first.tolist()]


def features(shape: str) -> list[str]:
    """Features of one shape: itself, its frame without outer punctuation, its digits, its signs."""
    form, _, digits = shape.rpartition("/")
    core = form.strip(".,;:!?\"'")
    n = int(digits)
    out = [f"shape={form}", f"core={core}", f"core+digits={core}/{n}", f"digits={n if n < 9 else 9 + n // 4}", f"first={form[:1]}", f"last={form[-1:]}"]
    out += [f"has={c}" for c in "@.+-()%:/#" if c in form]
    return out + (["plain"] if core in ("a", "A", "Aa", "") else [])


@dataclass
class Model:
    """Weights of features at a word and at its neighbours, and of label pairs."""

    place: dict[str, int]
    here: np.ndarray  # (features, labels)
    before: np.ndarray
    after: np.ndarray
    pairs: np.ndarray  # (labels, labels)

    def table(self, names: list[str]) -> np.ndarray:
        """(3, shapes + 1, labels): what a shape adds to its own word, the next one and the one before;
        the last row is for a missing neighbour."""
        out = np.zeros((3, len(names) + 1, len(LABELS)))
        for i, name in enumerate(names):
            known = [self.place[f] for f in features(name) if f in self.place]
            for k, weights in enumerate((self.here, self.before, self.after)):
                out[k, i] = weights[known].sum(axis=0)
        for k, weights in enumerate((self.here, self.before, self.after)):
            out[k, -1] = weights[self.place["none"]]
        return out


def _scores(table: np.ndarray, number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(words, labels) for lines that begin at ``first`` (last: the number of words)."""
    none = table.shape[1] - 1
    left, right = np.concatenate([[none], number[:-1]]), np.concatenate([number[1:], [none]])
    begins = first[:-1][np.diff(first) > 0]
    ends = first[1:][np.diff(first) > 0] - 1
    left[begins], right[ends] = none, none
    return table[0][number] + table[1][left] + table[2][right]


def _allowed() -> np.ndarray:
    """Pairs that may follow each other: inside only after begin or inside of its kind."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for j, label in enumerate(LABELS):
        if label.startswith("I-"):
            ok[:, j] = [x != "O" and x[2:] == label[2:] for x in LABELS]
    return ok


_FIRST_OK = np.array([not x.startswith("I-") for x in LABELS])


def _padded(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places (lines, longest line), and which of them are words."""
    counts = np.diff(first)
    steps = np.arange(counts.max() if len(counts) else 0)
    real = steps < counts[:, None]
    return np.where(real, first[:-1][:, None] + steps, 0), real


def train(rows: list[tuple[list[str], list[int]]], steps: int = 150, rate: float = 0.1, penalty: float = 0.01) -> Model:
    """Maximum conditional likelihood with a quadratic penalty, by Adam on exact gradients."""
    words = split(pa.array([" ".join(w) for w, _ in rows]), SPACED)
    number, names = shapes(words)
    place: dict[str, int] = {"none": 0}
    for name in names:
        for f in features(name):
            place.setdefault(f, len(place))
    first, k = words.first, len(LABELS)
    gold = np.array([x for _, labels in rows for x in labels])
    if len(gold) != len(number):
        raise ValueError("a labelled word holds white space")
    matrix = np.zeros((len(names) + 1, len(place)))  # shape by feature
    for i, name in enumerate(names):
        matrix[i, [place[f] for f in features(name)]] = 1
    matrix[-1, 0] = 1
    none = len(names)
    begins, ends = first[:-1], first[1:] - 1
    left, right = np.concatenate([[none], number[:-1]]), np.concatenate([number[1:], [none]])
    left[begins], right[ends] = none, none
    at, real = _padded(first)
    forbidden = np.where(_allowed(), 0.0, -1e9)
    shape = (len(place), k)
    weights = [np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros((k, k))]
    moment = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    follows = np.ones(len(gold), bool)
    follows[begins] = False
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[np.flatnonzero(follows) - 1], gold[follows]), 1)
    for step in range(1, steps + 1):
        emit = (matrix @ weights[0])[number] + (matrix @ weights[1])[left] + (matrix @ weights[2])[right]
        prob, pair = _expected(emit, at, real, weights[3] + forbidden)
        prob[np.arange(len(gold)), gold] -= 1
        grads = []
        for which in (number, left, right):
            by_shape = np.zeros((none + 1, k))
            np.add.at(by_shape, which, prob)
            grads.append(matrix.T @ by_shape)
        grads.append(pair - gold_pairs)
        for w, g, m in zip(weights, grads, moment):
            g = g + penalty * w
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            w -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return Model(place, weights[0], weights[1], weights[2], weights[3])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _expected(emit: np.ndarray, at: np.ndarray, real: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word and expected label pairs, by forward-backward."""
    lines, longest = at.shape
    k = emit.shape[1]
    score = emit[at]
    score[:, 0, ~_FIRST_OK] = -1e9
    forward = np.zeros((lines, longest, k))
    backward = np.zeros((lines, longest, k))
    forward[:, 0] = score[:, 0]
    for t in range(1, longest):
        moved = _log_sum(forward[:, t - 1, :, None] + pairs, 1) + score[:, t]
        forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
    total = _log_sum(forward[:, -1], 1)
    expected = np.zeros((k, k))
    for t in range(longest - 2, -1, -1):
        ahead = score[:, t + 1] + backward[:, t + 1]
        moved = _log_sum(pairs + ahead[:, None, :], 2)
        backward[:, t] = np.where(real[:, t + 1, None], moved, 0)
        joint = np.exp(forward[:, t, :, None] + pairs + ahead[:, None, :] - total[:, None, None])
        expected += joint[real[:, t + 1]].sum(axis=0)
    prob = np.zeros_like(emit)
    prob[at[real]] = np.exp(forward + backward - total[:, None, None])[real]
    return prob, expected


@cache
def trained(seed: int = 0) -> Model:
    return train(labelled_table(seed))


def viterbi(model: Model, number: np.ndarray, names: list[str], first: np.ndarray) -> np.ndarray:
    """The best label of each word; lines begin at ``first`` (last: the number of words)."""
    emit = _scores(model.table(names), number, first)
    pairs = model.pairs + np.where(_allowed(), 0.0, -1e9)
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    labels = np.zeros(len(number), np.int64)
    if not len(order):
        return labels
    begin, counts = first[:-1][order], counts[order]
    score = emit[begin] + np.where(_FIRST_OK, 0.0, -1e9)
    back = np.zeros((len(number), len(LABELS)), np.int8)
    last = [None] * int(counts[0])
    for t in range(1, int(counts[0])):
        going = int(np.searchsorted(-counts, -t, side="left"))  # lines longer than t
        if going < len(score):
            last[t - 1] = score[going:].argmax(axis=1)
        way = score[:going, :, None] + pairs
        best = way.argmax(axis=1)
        back[begin[:going] + t] = best
        score = np.take_along_axis(way, best[:, None, :], 1)[:, 0] + emit[begin[:going] + t]
    last[-1] = score.argmax(axis=1)
    # walk back: lines join when their last word is reached
    active = np.zeros(0, np.int64)
    for t in range(int(counts[0]) - 1, -1, -1):
        if last[t] is not None:
            active = np.concatenate([active, last[t]])
        at = begin[: len(active)] + t
        labels[at] = active
        active = back[at, active].astype(np.int64)
    return labels
