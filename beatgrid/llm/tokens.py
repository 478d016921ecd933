"""Exact token ids and counts of whole texts, with a bounded cache in each worker.

The vocabulary ``word_bpe_49k.json`` drops white space, composes and lower-cases character by
character and never joins across a space. So the ids of a text are those of its pieces between
spaces and line ends, one after the other; other white space stays inside a piece and is the
library's business. Pieces are cut and hashed for many texts at once; the library encodes a piece
that the worker has not met before.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa

from beatgrid.llm.common import worker_cache
from beatgrid.llm.words import Words, hashes, rule, split

#: A worker's table starts anew beyond so many pieces or ids.
CACHE_PIECES, CACHE_IDS = 1_200_000, 8_000_000

#: Keys that are looked up at a time; what is held for them stays in a core's cache.
AT_ONCE = 1 << 14

_SPACES = rule(b" \n", fold=False)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes whose piece is left in its case: they begin a special token, or a mark that may compose.
_AS_IS = np.zeros(256, bool)
_AS_IS[[ord("<"), 0xCC, 0xCD]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[ord("."), ord(",")]] = True

def pieces_of(texts: pa.Array) -> Words:
    """The pieces of each text. A-Z are lower-cased, which the vocabulary would do, and a full stop
    or comma that follows a letter at the end of a piece is a piece of its own."""
    words = split(texts, _SPACES)
    data = _LOWER[words.data]
    for at in _words_with(words, _AS_IS):
        data[words.start[at] : words.end[at]] = words.data[words.start[at] : words.end[at]]
    start, end, first = words.start, words.end, words.first
    if len(start):
        last = end - 1
        cut = np.flatnonzero(_MARK[data[last]] & (end - start > 1) & _LETTER[data[np.maximum(last - 1, 0)]])
        end = end.copy()
        end[cut] -= 1
        first = first + np.searchsorted(cut, first)
        start, end = np.insert(start, cut + 1, end[cut]), np.insert(end, cut + 1, end[cut] + 1)
    return Words(data, start, end, first)


def _words_with(words: Words, which: np.ndarray) -> list[int]:
    at = np.flatnonzero(which[words.data])
    return np.unique(np.searchsorted(words.start, at, side="right") - 1).tolist() if len(at) else []


class HashTable:
    """Open addressing over arrays: distinct non-zero 64-bit keys to places 0, 1, 2, ...

    ``capacity`` is the number of keys to expect; the table grows beyond it and stays at most half full."""

    def __init__(self, capacity: int):
        self.used = 0
        self._empty(capacity)

    def _empty(self, capacity: int) -> None:
        self.size = 1 << max(10, (2 * capacity - 1).bit_length())
        self.mask = np.uint64(self.size - 1)
        self.keys = np.zeros(self.size, np.uint64)
        self.places = np.zeros(self.size, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for a in range(0, len(keys), AT_ONCE):
            self._find(keys[a : a + AT_ONCE], out[a : a + AT_ONCE])
        return out

    def _find(self, keys: np.ndarray, out: np.ndarray) -> None:
        todo, slot = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(todo):
            there = self.keys[slot]
            same = there == keys[todo]
            out[todo[same]] = self.places[slot[same]]
            going = ~same & (there != 0)
            todo, slot = todo[going], (slot[going] + 1) & (self.size - 1)

    def add(self, keys: np.ndarray) -> None:
        """Distinct keys that are not in the table get the next places in their order."""
        places = np.arange(self.used, self.used + len(keys), dtype=np.int32)
        self.used += len(keys)
        if 2 * self.used > self.size:
            there = self.keys != 0
            old = self.keys[there], self.places[there]
            self._empty(self.used)
            self._put(*old)
        self._put(keys, places)

    def _put(self, keys: np.ndarray, places: np.ndarray) -> None:
        todo, slot = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.places[slot[won]] = keys[todo[won]], places[todo[won]]
            going = np.ones(len(todo), bool)
            going[won] = False
            todo, slot = todo[going], (slot[going] + 1) & (self.size - 1)


class PieceCoder:
    """Ids of texts through a table of pieces met before."""

    def __init__(self, path: str, pieces: int = CACHE_PIECES, ids: int = CACHE_IDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: letters.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x80, 0x250)) if c.isalpha()}
        self.limits = pieces, ids
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(1)  # grows with what is kept
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def code(self, piece: str) -> list[int]:
        """Ids by the library. A word of letters below U+0250 passes its normaliser and its splitter
        unchanged but for lower case, so such a word goes to the model at once."""
        if piece.isalpha() and (piece.isascii() or (max(piece) < "ɐ" and "İ" not in piece)):
            word = piece.lower()
            if not word.isascii():
                word = "".join([self.bytes.get(c, c) for c in word])
            return [t.id for t in self.model.tokenize(word)]
        return self.library.encode(piece, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        coded = [self.code(t.decode()) for t in texts]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        n, k = self.table.used, int(lengths.sum())
        while n + len(coded) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + k > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + k] = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, k)
        self.length[n : n + len(coded)] = lengths
        self.start[n : n + len(coded)] = self.used + np.cumsum(lengths) - lengths
        self.table.add(keys)
        self.used += k

    def places(self, words: Words, keys: np.ndarray) -> np.ndarray:
        """The table's place of each piece."""
        found = self.table.find(keys)
        if (found < 0).any():
            new, at = np.unique(keys[found < 0], return_index=True)
            if self.table.used + len(new) > self.limits[0] or self.used > self.limits[1]:
                self._clear()
                new, at = np.unique(keys, return_index=True)
            else:
                at = np.flatnonzero(found < 0)[at]
            self._learn(new, [words.text(i) for i in at.tolist()])
            found = self.table.find(keys)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the number of each text's ids."""
        words = pieces_of(texts)
        at = self.places(words, hashes(words) | np.uint64(1))
        lengths = self.length[at]
        before = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(self.start[at] - before, lengths) + np.arange(int(lengths.sum()))]
        return ids, per_text(lengths, words)

    def lengths(self, words: Words, keys: np.ndarray) -> np.ndarray:
        """The number of ids of each piece."""
        at = self.places(words, keys)
        return self.length[at]


def per_text(lengths: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(lengths)])
    return total[words.first[1:]] - total[words.first[:-1]]


def coder(path: str) -> PieceCoder:
    """This worker's coder for a vocabulary file; it outlives the task."""
    coders = worker_cache("tokens", ("token counts",))
    if path not in coders:
        coders[path] = PieceCoder(path)
    return coders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
