"""Personal data in whole texts: fixed patterns, and spans that a conditional random field adds.

Every text is searched for the four patterns. Its lines that hold a digit or an @ are also labelled
word by word by the field (a span must hold one of these signs, so other lines cannot have any).
Labelled spans that hold what their kind needs and touch no pattern's span are added. The field is
trained once on the driver, from a labelled table of fixed size, and shared; texts are handled in
pieces in each task and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import pieces, texts_of
from beatgrid.llm.crf import KINDS, LABELS, Model, shapes, trained, viterbi
from beatgrid.llm.words import Words, rule, split

Span = tuple[int, int, int]  # kind, start, end in code points

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match of these two begins with a whole run of digits, so runs need no second try
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

_CARD_SIGNS, _PHONE_SIGNS = frozenset("0123456789 -"), frozenset("0123456789 -().+")

_SPACED = rule(bytes([0x20, *range(0x09, 0x0E)]), fold=False)
_OUTER = "()[]{}<>\"',;:!?."


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: for each @, the run of local signs before it and a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def patterns(text: str) -> list[Span]:
    """Spans of the four patterns, by kind and start. Matches that fail their test are dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def plausible(kind: int, text: str) -> bool:
    """What an added span must hold."""
    digits = _DIGITS.findall(text)
    if kind == 0:
        return 0 < text.find("@") < len(text) - 1
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(x.isascii() and x.isdigit() and _small(x) for x in parts)
    if kind == 2:
        return 16 <= len(digits) <= 19 and set(text) <= _CARD_SIGNS
    return 7 <= len(digits) <= 15 and set(text) <= _PHONE_SIGNS


def _lines(words: Words, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first): the words of the lines that hold a marked word, and where each line begins."""
    n = len(words.start)
    breaks = np.flatnonzero(words.data == ord("\n"))
    line_of = np.searchsorted(breaks, words.start)
    new = np.ones(n, bool)
    new[1:] = line_of[1:] != line_of[:-1]
    new[words.first[:-1][words.first[:-1] < n]] = True
    line = np.cumsum(new) - 1
    wanted = np.unique(line[marked])
    keep = np.flatnonzero(np.isin(line, wanted))
    return keep, np.concatenate([np.searchsorted(line[keep], wanted), [len(keep)]])


def labelled(model: Model, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) in bytes of each text that the field labels, before any test."""
    words = split(texts, _SPACED)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    sign = np.zeros(256, bool)
    sign[[*range(ord("0"), ord("9") + 1), ord("@")]] = True
    held = np.concatenate([[0], np.cumsum(sign[words.data])])
    marked = np.flatnonzero(held[words.end] > held[words.start])
    if not len(marked):
        return out
    keep, first = _lines(words, marked)
    number, names = shapes(Words(words.data, words.start[keep], words.end[keep], first))
    labels = viterbi(model, number, names, first)
    named = np.flatnonzero(labels)
    begins = np.array([LABELS[x].startswith("B") for x in labels[named]], bool)
    starts = named[begins]
    row = words.row()
    sizes = np.diff(np.append(np.flatnonzero(begins), len(named)))
    offset = _text_starts(texts)
    for i, size in zip(starts.tolist(), sizes.tolist()):
        a, b = keep[i], keep[i + size - 1]
        r = row[a]
        out[r].append((KINDS.index(LABELS[labels[i]][2:]), int(words.start[a] - offset[r]), int(words.end[b] - offset[r])))
    return out


def _text_starts(texts: pa.Array) -> np.ndarray:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.cumsum(sizes) - sizes


def spans_of(text: str, more: list[tuple[int, int, int]]) -> tuple[list[Span], list[Span]]:
    """(pattern spans, all spans), each by kind and start; ``more`` are labelled spans in bytes."""
    base = patterns(text)
    added: list[Span] = []
    if more:
        raw = text.encode()
        for kind, a, b in more:
            start = len(raw[:a].decode())
            found = raw[a:b].decode()
            inner = found.strip(_OUTER) if kind != 3 else found.strip(_OUTER.replace("(", "")).rstrip("(")
            start += found.find(inner) if inner else 0
            end = start + len(inner)
            if plausible(kind, inner) and not any(s < end and start < e for _, s, e in base):
                added.append((kind, start, end))
    return base, sorted(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of ``docs``.

    The counts and the digest are of the patterns' spans; ``spans`` has all, as kind:start:end in
    code points, by kind and start. A null or empty text has none: zeros, the digest of the empty
    string and an empty string. Ids may be null or repeated; other columns are not read.
    """
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = [spans_of(t, m) for t, m in zip(texts_of(piece), labelled(shared.value, piece.column(1)))]
                counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in range(len(KINDS))]
                digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([joined(x) for _, x in found], pa.string())],
                    ["ident", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    kind = rows.schema["ident"].dataType.simpleString()
    names = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(run, f"ident {kind}, {names}, base_sha256 string, spans string").withColumnRenamed("ident", ident)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all other columns stay.

    Overlapping spans of several kinds are replaced as one, by the kind that begins first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    names = docs.columns
    rows = docs.select(*[f"`{c}`" for c in names if c != text], F.col(text).cast("string").alias(text)).select(names)
    at = names.index(text)

    def clean(value: str | None, more: list) -> str | None:
        if value is None:
            return None
        out, done = [], 0
        for a, _, b, kind in sorted((a, k, b, KINDS[k]) for k, a, b in spans_of(value, more)[1]):
            if a >= done:
                out += [value[done:a], f"[{kind.upper()}]"]
            done = max(done, b)
        return "".join([*out, value[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at):
                texts = piece.column(at).to_pylist()
                cleaned = [clean(t, m) for t, m in zip(texts, labelled(shared.value, piece.column(at)))]
                columns = list(piece.columns)
                columns[at] = pa.array(cleaned, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, rows.schema)
