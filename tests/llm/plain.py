"""Plain versions of the operators, row by row, to compare with on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from beatgrid.llm.pii import luhn
from beatgrid.llm.tokens import vocabulary


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids(texts: list[str | None]) -> list[list[int]]:
    return [x.ids for x in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(values: list[int]) -> int:
    return zlib.crc32(np.array(values, "<u4").tobytes())


def sets(texts: dict, size: int) -> dict:
    out = {}
    for k, t in texts.items():
        w = spaced(t)
        out[k] = frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return out


def jaccard_components(texts: dict, size: int, percent: int) -> dict:
    """{key: (set size, least key of its component)}"""
    of = sets(texts, size)
    keys, parent = sorted(of), {k: k for k in of}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            n = len(of[a] & of[b])
            if n and 100 * n >= percent * len(of[a] | of[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(of[k]), root(k)) for k in keys}


def contamination(texts: dict, items: list[tuple], size: int) -> dict:
    """{key: (words, hit words, items, digest)}"""
    windows = defaultdict(set)
    for name, text in items:
        w = alnum(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            if name is not None:
                windows[tuple(w[i : i + n])].add(str(name))
    lengths = {len(x) for x in windows}
    out = {}
    for k, t in texts.items():
        w = alnum(t)
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    names |= found
        out[k] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = "".join(re.findall("[0-9]", m[0]))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def kneser_ney(train: list[str], texts: list[str], order: int, discounts, whole: bool = False) -> list[float | None]:
    """Perplexity of each text; ``discounts`` gives the three discounts from counts of counts. The
    n-grams run within each word and its end, or with ``whole`` across all of a text's words."""
    lead = (0,) * (order - 1)

    def grams(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        for run in ([found] if whole else [[w] for w in found]):
            signs = (*lead, *(max(b, 1) for word in run for b in (*word.encode(), 0x20)))
            for i in range(order - 1, len(signs)):
                yield signs[i - order + 1 : i + 1]

    counts = {order: Counter(g for t in train for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {}
    for k, c in counts.items():
        n = Counter(c.values())
        off[k] = discounts(n[1], n[2], n[3], n[4])
    totals = {k: Counter() for k in counts}
    kinds = {k: defaultdict(Counter) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            totals[k][g[:-1]] += n
            kinds[k][g[:-1]][min(n, 3)] += 1

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        total = totals[k][g[:-1]]
        if not total:
            return p(g[1:])
        n = counts[k][g]
        gamma = sum(off[k][i - 1] * m for i, m in kinds[k][g[:-1]].items()) / total
        return (max(0.0, n - off[k][min(n, 3) - 1]) if n else 0.0) / total + gamma * p(g[1:])

    out = []
    for t in texts:
        logs = [math.log(p(g)) for g in grams(t)]
        out.append(math.exp(-sum(logs) / len(logs)) if logs else None)
    return out


def resampled(docs: list[tuple], target: list, least: int, most: int, buckets: int, share: int, min_words: int, seed: int) -> list[tuple]:
    """(id, features, weight, score, rank) of each document."""

    def codes(text):
        w = alnum(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(least, most + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(c for _, x in docs for c in codes(x)), Counter(c for x in target for c in codes(x))
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)
    }
    rows = []
    for i, text in docs:
        c = codes(text)
        weight = sum(gain[b] for b in c) // len(c) if c else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(c), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(alnum(text))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = defaultdict(list)
    for k, r in enumerate(able):
        ranks[r].append(k + 1 if k < len(able) * share // 100 else None)
    return [(*r[:4], ranks[r].pop() if r in ranks and r[4] >= min_words else None) for r in rows]


def without_shared_lines(docs: list[tuple], min_chars: int, min_docs: int) -> list[tuple]:
    """(id, lines, dropped, kept text) of each document."""

    def key(line):
        return lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def filled(ident, text: str | None, seed: int, rate: int, spm: int) -> tuple:
    """(tokens, form, prefix length, middle length, output) of one document."""
    text = text or ""
    t = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(t), "plain", None, None, text
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if h[3] % 100 < spm:
        return len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"
