"""A set of positions in a text, held in containers of 65,536 positions, with select by rank.

Positions that share their high bits lie in one container, in the smallest of three forms: a sorted
array of their low 16 bits, a bitmap, or runs of consecutive positions. Cumulative cardinalities of
the containers, and of a container's runs or bitmap words, make ``select`` two binary searches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Low bits of a position, and 64-bit words of a bitmap container.
LOW = 16
WORDS = (1 << LOW) // 64


@dataclass(frozen=True)
class ArrayContainer:
    """Low bits in order."""

    values: np.ndarray

    def __len__(self) -> int:
        return len(self.values)

    def nbytes(self) -> int:
        return 2 * len(self.values)

    def select(self, rank: np.ndarray) -> np.ndarray:
        return self.values[rank].astype(np.int64)


@dataclass(frozen=True)
class RunContainer:
    """Runs of consecutive low bits: where each starts and how many values lie before it, the total last."""

    starts: np.ndarray
    before: np.ndarray

    def __len__(self) -> int:
        return int(self.before[-1])

    def nbytes(self) -> int:
        return 4 * len(self.starts)

    def select(self, rank: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, rank, side="right") - 1
        return self.starts[run].astype(np.int64) + rank - self.before[run]


@dataclass(frozen=True)
class BitmapContainer:
    """One bit a position in little-endian words, with the number of set bits before each word, the total last."""

    words: np.ndarray
    before: np.ndarray

    def __len__(self) -> int:
        return int(self.before[-1])

    def nbytes(self) -> int:
        return 8 * WORDS

    def select(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, rank, side="right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(len(word), 8), axis=1, bitorder="little")
        seen = np.cumsum(bits, axis=1)
        inside = np.argmax(seen == (rank - self.before[word] + 1)[:, None], axis=1)
        return word.astype(np.int64) * 64 + inside


Container = ArrayContainer | RunContainer | BitmapContainer


def container(low: np.ndarray) -> Container:
    """The smallest container of some low bits, which are in order and distinct."""
    first = np.flatnonzero(np.diff(low, prepend=np.int64(-2)) != 1)
    sizes = (2 * len(low), 4 * len(first), 8 * WORDS)
    if sizes[1] < min(sizes[0], sizes[2]):
        return RunContainer(low[first].astype(np.uint16), np.append(first, len(low)))
    if sizes[0] <= sizes[2]:
        return ArrayContainer(low.astype(np.uint16))
    bits = np.zeros(1 << LOW, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    return BitmapContainer(words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))


class BoundarySet:
    """Distinct positions in ascending order, added in blocks; ``select(k)`` is the k-th, from 0."""

    def __init__(self) -> None:
        self.containers: list[Container] = []
        self.high: list[int] = []
        self.before: list[int] = [0]
        self._open: list[np.ndarray] = []
        self._key = 0

    def add(self, positions: np.ndarray) -> None:
        """Positions in ascending order, all of them above those added before."""
        if not len(positions):
            return
        keys = positions >> LOW
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for part in np.split(positions, cuts):
            key = int(part[0] >> LOW)
            if key != self._key:
                self._close()
                self._key = key
            self._open.append(part & ((1 << LOW) - 1))

    def _close(self) -> None:
        if self._open:
            made = container(np.concatenate(self._open))
            self.containers.append(made)
            self.high.append(self._key)
            self.before.append(self.before[-1] + len(made))
            self._open = []

    def sealed(self) -> "BoundarySet":
        """The set once nothing more is added."""
        self._close()
        return self

    def __len__(self) -> int:
        return self.before[-1]

    def nbytes(self) -> int:
        return sum(c.nbytes() for c in self.containers)

    def select(self, ranks) -> np.ndarray:
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) and not (0 <= ranks.min() and ranks.max() < len(self)):
            raise IndexError("no position of that rank")
        which = np.searchsorted(self.before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for k in np.unique(which):
            mine = which == k
            out[mine] = (self.high[k] << LOW) + self.containers[k].select(ranks[mine] - self.before[k])
        return out
