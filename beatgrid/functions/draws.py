"""Random draws that depend on their arguments alone and that any engine with md5 repeats.

The arguments are written as text, null as nothing, joined by colons and hashed; the leading hex
digits of the hash are the draw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _leading(digits: int, parts: tuple) -> Column:
    texts = [F.coalesce((p if isinstance(p, Column) else F.lit(p)).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, digits), 16, 10).cast("bigint")


def draw(*parts) -> Column:
    """A whole number below 2^60."""
    return _leading(15, parts)


def uniform(*parts) -> Column:
    """A number in [0, 1) in steps of 2^-52."""
    return _leading(13, parts) / F.lit(float(2**52))


def fold(ident: Column, folds: int, seed: int = 42) -> Column:
    """A fold number of a row by its id."""
    return F.pmod(draw(ident, seed), F.lit(folds)).cast("int")
