"""Encodings: cycles, label bins, code groups and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid import dimensions


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value that repeats every ``period`` units."""
    angle = 2 * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin; one more label than edges. NULL stays NULL."""
    out = F.when(value <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(value <= edge, label)
    return out.when(value.isNotNull(), labels[-1])


def temperature_band(temp: Column) -> Column:
    # Upper edges and names of the bands.
    return bin_label(temp, [50, 70, 85], ["Cold", "Mild", "Warm", "Hot"])


def night_value(value: Column, hour: Column) -> Column:
    """The value between 20:00 and 06:59, else zero."""
    return value * F.when((hour >= 20) | (hour <= 6), 1).otherwise(0)


def lookup(value: Column, mapping: Mapping) -> Column:
    """Small map as an expression; keys that are missing give NULL."""
    out = None
    for key, label in mapping.items():
        out = F.when(value == key, label) if out is None else out.when(value == key, label)
    return out


def severity(report_class: Column) -> Column:
    return lookup(report_class, dimensions.SEVERITY)


def descent_group(code: Column) -> Column:
    out = lookup(code, dimensions.DESCENT_SINGLE)
    return out.when(code.isin(dimensions.DESCENT_ASIAN), "Asian").otherwise(
        dimensions.DESCENT_DEFAULT
    )


def with_category(
    df: DataFrame, categories: DataFrame, offence: str, key: str = "offence"
) -> DataFrame:
    """Add ``category`` by exact match; offences that are not listed give NULL.

    ``categories`` is the fixed offence list (139 rows); the planner broadcasts it by its size.
    """
    right = categories.select(F.col(key).alias(offence), "category")
    return df.join(right, offence, "left")
