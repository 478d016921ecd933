"""Cleaning steps. Each takes and returns a DataFrame, so they chain with ``transform``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.functions import calendar as cal
from beatgrid.functions.numeric import to_number
from beatgrid.operators.ordered import mode_value


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def fill_constants(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Replace NULL by a text constant; other types become text first."""
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.withColumns(
        {c: F.coalesce(col(c).cast("string"), F.lit(v)) for c, v in present.items()}
    )


def fill_mode(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Replace NULL by the most frequent value.

    The mode is a counted top-1, so no task sees all values; it enters as a scalar subquery.
    ``source`` may hold the same rows' column, staged.
    """
    if column not in df.columns:
        return df
    mode = mode_value((df if source is None else source).select(col(column).alias("v")), "v").scalar()
    return df.withColumn(column, F.coalesce(col(column), mode))


def drop_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop rows that hold the value; rows with NULL stay."""
    return df.filter(~col(column).eqNullSafe(F.lit(value)))


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    keep = F.lit(True)
    for c in columns:
        keep = keep & col(c).isNotNull()
    return df.filter(keep)


def parse_dates(df: DataFrame, columns: Sequence[str], formats: tuple[str, ...]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: cal.parse_timestamp(col(c), formats) for c in present})


def repair_age(
    df: DataFrame, column: str, default: float = 30.0, upper: float = 100.0, source: DataFrame | None = None
) -> DataFrame:
    """Negative -> mean of the positive values, then clip to 0..upper. Zero and NULL stay.

    ``source`` may hold the same rows' column, staged.
    """
    if column not in df.columns:
        return df
    mean = (df if source is None else source).agg(F.avg(F.when(col(column) > 0, col(column))).alias("mean_age")).scalar()
    age = col(column).cast("double")
    repaired = F.when(age < 0, F.coalesce(mean, F.lit(default))).otherwise(age)
    clipped = F.when(
        age.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(float(upper)), repaired))
    )
    return df.withColumn(column, clipped)


def allow_values(
    df: DataFrame, column: str, allowed: Sequence[str], otherwise: str
) -> DataFrame:
    return df.withColumn(
        column, F.when(col(column).isin(list(allowed)), col(column)).otherwise(otherwise)
    )


def until_year(df: DataFrame, column: str, max_year: int) -> DataFrame:
    """Keep rows up to the year; rows without a date drop out.

    Written as a bound on the column itself, so that it reaches a parquet scan.
    """
    bound = F.lit(f"{max_year + 1}-01-01").cast(dict(df.dtypes)[column])
    return df.filter(col(column) < bound)


def upper_case(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.upper(col(c)) for c in columns if kinds.get(c) == "string"})


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(col(c)) for c in columns if c in df.columns})


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order (NULL last).

    The rank filter turns into a group limit before the exchange: each task sends one row per
    key, so a key that holds a third of the table is no hot spot.
    """
    ranked = Window.partitionBy(*[col(k) for k in keys]).orderBy(
        *[col(c).asc_nulls_last() for c in order]
    )
    return df.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") == 1).drop("_rn")
