"""Words of many texts at once as 64-bit hashes, with numpy over the texts' bytes.

Separators are ASCII in every word rule of this package, and no byte of a longer UTF-8 character is
ASCII, so words can be cut bytewise. A word's hash is a polynomial over a table of random 64-bit
values modulo 2^64, followed by a bijective mix; two different words share one with a probability
of about 2^-56.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
#: Bytes whose powers are kept at a time, and bytes that are hashed at a time if no word is longer; their
#: values stay in a core's cache.
_SPAN, _REGION = 1 << 18, 1 << 14


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)
    powers = np.full(_SPAN, _BASE, np.uint64)
    inverse = np.full(_SPAN, pow(_BASE, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return values, np.cumprod(powers), np.cumprod(inverse)


def rule(separators: bytes, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(byte map, word bytes): A-Z lower-cased if ``fold``, and which bytes belong to words."""
    fold_map = np.arange(256, dtype=np.uint8)
    if fold:
        fold_map[ord("A") : ord("Z") + 1] += 32
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return fold_map, inside


#: Words are `[^\x20\x09-\x0D]+`, and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased.
SPACED = rule(bytes([0x20, *range(0x09, 0x0E)]))
ALNUM = rule(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


@dataclass
class Words:
    """The words of some texts in order; ``first`` has each text's first word and, last, their number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def only(self, which: np.ndarray) -> "Words":
        """Some of the words, without their texts."""
        return Words(self.data, self.start[which], self.end[which], np.zeros(1, np.int64))

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def split(texts: pa.Array, how: tuple[np.ndarray, np.ndarray]) -> Words:
    """All words of the texts; a null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    fold, word = how
    data = fold[data]
    inside = word[data]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    values, powers, inverse = _tables()
    out = np.zeros(len(words.start), np.uint64)
    i, n = 0, len(words.start)
    while i < n:
        base = words.start[i]
        j = int(np.searchsorted(words.end, base + _REGION, side="right"))
        if j <= i:
            j = int(np.searchsorted(words.end, base + _SPAN - 1, side="right"))
        if j <= i:  # one word longer than the tables
            out[i] = _long(words.data[base : words.end[i]])
            i += 1
            continue
        region = values[words.data[base : words.end[j - 1]]]
        region *= powers[: len(region)]
        total = np.zeros(len(region) + 1, np.uint64)
        np.cumsum(region, out=total[1:])
        s, e = words.start[i:j] - base, words.end[i:j] - base
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mixed(out + (words.end - words.start).astype(np.uint64) * _ODD)


def _long(data: np.ndarray) -> np.uint64:
    values, powers, _ = _tables()
    total = 0
    for k in range(0, len(data), _SPAN):
        part = data[k : k + _SPAN]
        total += int((values[part] * powers[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, k, 1 << 64)
    return np.uint64(total & 0xFFFFFFFFFFFFFFFF)


_STEPS = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``size`` words; fewer words, but not none, are one run."""
    h, counts = hashes(words), words.counts()
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + words.first[:-1][row]
    width = np.minimum(counts, size)[row]
    total = np.zeros(len(row), np.uint64)
    for k in range(size):
        have = width > k
        total[have] += mixed(h[at[have] + k] + _STEPS[k]) * _STEPS[k]
    return mixed(total + width.astype(np.uint64)), row
