"""Fill-in-the-middle: documents cut into prefix, middle and suffix at token borders and put in another order.

A token is a run of the letters A-Z and a-z, or any other single code point. The borders of a text's
tokens form a :class:`~beatgrid.llm.boundaries.BoundarySet` over code points, read block by block from
the UTF-8 bytes; the two cuts are its elements of two ranks that a hash of the document's id draws. All
of it happens to one row at a time in tasks of Arrow batches, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.boundaries import BoundarySet
from beatgrid.llm.common import pieces, texts_of

#: Bytes of a text whose borders are looked for at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Form:
    """How documents are drawn and written. ``rate`` of 100 are cut, ``spm`` of 100 of those in the
    order suffix, prefix, middle; the three marks stand before prefix, suffix and middle."""

    seed: int = 1
    rate: int = 90
    spm: int = 20
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def write(self, form: str, prefix: str, middle: str, suffix: str) -> str:
        p, s, m = self.marks
        if form == "psm":
            return f"{p}{prefix}{s}{suffix}{m}{middle}"
        return f"{s}{suffix}{p}{prefix}{m}{middle}"

    def read(self, form: str, output: str) -> str:
        """The text that ``write`` was given, from its output alone."""
        if form == "plain":
            return output
        p, s, m = self.marks
        one, two = (p, s) if form == "psm" else (s, p)
        second = output.index(two, len(one))
        third = output.index(m, second + len(two))
        parts = output[len(one) : second], output[second + len(two) : third]
        prefix, suffix = parts if form == "psm" else parts[::-1]
        return prefix + output[third + len(m) :] + suffix


def draws(ident, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from the hash of ``seed:ident``; a null id is the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def borders(raw: bytes, block: int = BLOCK) -> BoundarySet:
    """Where tokens begin, in code points, and the text's end."""
    out, points, letter = BoundarySet(), 0, False
    for at in range(0, len(raw), block):
        data = np.frombuffer(raw, np.uint8, min(block, len(raw) - at), at)
        folded = data | 0x20
        letters = (folded >= ord("a")) & (folded <= ord("z"))
        inside = letters & np.concatenate([[letter], letters[:-1]])
        letter = bool(letters[-1])
        begins = (data & 0xC0) != 0x80
        order = np.cumsum(begins) - 1 + points
        out.add(order[begins & ~inside])
        points += int(np.count_nonzero(begins))
    out.add(np.array([points], np.int64))
    return out.sealed()


def cut(text: str, ident, how: Form) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, code points of the prefix, of the middle, output) of one text."""
    marks = borders(text.encode())
    n = len(marks) - 1
    h1, h2, h3, h4 = draws(ident, how.seed)
    if not text or any(m in text for m in how.marks) or h3 % 100 >= how.rate:
        return n, "plain", None, None, text
    a, b = marks.select(sorted((h1 % (n + 1), h2 % (n + 1)))).tolist()
    form = "spm" if h4 % 100 < how.spm else "psm"
    return n, form, a, b - a, how.write(form, text[:a], text[a:b], text[b:])


def transform(docs: DataFrame, how: Form | None = None, ident: str = "doc_id", text: str = "text", output: bool = True) -> DataFrame:
    """Per document: (ident, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256[, output]).

    A null text is empty; empty texts, texts that hold a mark and those not drawn stay as they are
    (``plain``, lengths null). Rows are independent, so repeated ids draw alike and an empty table stays
    empty; other columns are not read. Texts of any length are taken whole, one at a time. The restored
    text is rebuilt from the output and the form alone.
    """
    how = how or Form()
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    schema = f"ident {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                made = [cut(t, i, how) for i, t in zip(part.column(0).to_pylist(), texts_of(part))]
                columns = [
                    part.column(0),
                    pa.array([m[0] for m in made], pa.int64()),
                    pa.array([m[1] for m in made], pa.string()),
                    pa.array([m[2] for m in made], pa.int64()),
                    pa.array([m[3] for m in made], pa.int64()),
                    pa.array([hashlib.sha256(m[4].encode()).hexdigest() for m in made], pa.string()),
                    pa.array([hashlib.sha256(how.read(m[1], m[4]).encode()).hexdigest() for m in made], pa.string()),
                ]
                if output:
                    columns.append(pa.array([m[4] for m in made], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["ident", *[c.split(" ")[0] for c in schema.split(", ")[1:]]] + ["output"] * output)

    return rows.mapInArrow(run, schema + ", output string" * output).withColumnRenamed("ident", ident)
