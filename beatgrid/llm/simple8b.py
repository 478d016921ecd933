"""Simple-8b: whole 64-bit words, each holding as many equal-width values as fit.

The top four bits of a word select how many values its other 60 bits hold. A value over 60 bits
is escaped: selector 0, then the value as a word of its own. Values are coded in blocks; a table of
the blocks' word offsets lets a reader start anywhere and decode a block with array operations.
"""

from __future__ import annotations

import numpy as np

#: Number of values and bits of each, by selector. Selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)

_PAD = int(COUNTS.max())


def encode_block(values: np.ndarray) -> np.ndarray:
    """The words of one block of unsigned values; what is free in the last word stays 0."""
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([values.astype(np.uint64), np.zeros(_PAD, np.uint64)])
    width = np.frexp(padded.astype(np.float64))[1]
    select = np.zeros(n, np.int64)
    for s in range(len(COUNTS) - 1, 0, -1):
        if (width[:n] <= BITS[s]).sum() < min(n, COUNTS[s]):
            break  # too few narrow values for this selector and the ones after it
        wide = np.concatenate([[0], np.cumsum(width > BITS[s])])
        select[wide[COUNTS[s] : COUNTS[s] + n] == wide[:n]] = s
    steps, at, i = COUNTS[select].tolist(), [], 0
    while i < n:
        at.append(i)
        i += steps[i]
    first = np.array(at, np.int64)
    select = select[first]
    size = 1 + (select == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(select):
        here = select == s
        if s == 0:
            words[place[here] + 1] = padded[first[here]]
            continue
        word = np.full(int(here.sum()), int(s) << 60, np.uint64)
        if BITS[s]:
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            word |= np.bitwise_or.reduce(padded[first[here][:, None] + np.arange(COUNTS[s])] << shifts, axis=1)
        words[place[here]] = word
    return words


def decode_block(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of a block."""
    select = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[select]
    escapes = []
    if (select == 0).any():
        last = -2
        for i in np.flatnonzero(select == 0).tolist():
            if i != last + 1:  # else it is the value of the escape before it
                escapes.append(i)
                last = i
        # a value after an escape may look like any selector
        literal = np.array(escapes) + 1
        counts[literal] = 0
        select[literal] = -1
    place = np.cumsum(counts) - counts
    out = np.zeros(n + _PAD, np.uint64)
    for s in np.unique(select):
        if s > 0 and BITS[s]:
            here = select == s
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            mask = np.uint64((1 << int(BITS[s])) - 1)
            out[place[here][:, None] + np.arange(COUNTS[s])] = (words[here][:, None] >> shifts) & mask
    if escapes:
        out[place[escapes]] = words[np.array(escapes) + 1]
    return out[:n]
