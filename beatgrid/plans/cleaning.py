"""Whole-table cleaning in its fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from beatgrid.config import CleaningParams
from beatgrid.operators import clean
from beatgrid.sources.files import materialised


def clean_reports(raw: DataFrame, params: CleaningParams = CleaningParams()) -> DataFrame:
    """Raw reports -> cleaned reports.

    The order matters: unknown sex is filled before invalid codes are dropped and before other
    values are normalised; the mode is taken over all rows, the mean age over the rows that
    are left at that point. Both come from the few columns they need, which are staged, so the
    reports are read once for them and once for the result.
    """
    p = params

    def known_rows(df: DataFrame) -> DataFrame:
        return (
            df.transform(clean.fill_constants, {p.sex_column: p.sex_unknown})
            .transform(clean.drop_value, p.sex_column, p.sex_invalid)
            .transform(clean.drop_nulls, p.required)
        )

    filled = raw.transform(clean.drop_columns, p.drop).transform(clean.fill_constants, p.fill)
    needed = [c for c in dict.fromkeys([p.mode_fill, p.sex_column, p.age_column, *p.required]) if c in filled.columns]
    few = materialised(filled.select(*[clean.col(c) for c in needed]), "few-columns")
    return (
        filled.transform(clean.fill_mode, p.mode_fill, few)
        .transform(known_rows)
        .transform(clean.parse_dates, p.dates, p.date_formats)
        .transform(clean.repair_age, p.age_column, p.age_default, p.age_max, known_rows(few))
        .transform(clean.allow_values, p.sex_column, p.sex_values, p.sex_unknown)
        .transform(clean.until_year, p.dates[0], p.max_year)
        .transform(clean.upper_case, p.upper)
    )


def clean_weather(raw: DataFrame, params: CleaningParams = CleaningParams()) -> DataFrame:
    # The numeric weather columns.
    numbers = ("Temp", "Wspeed", "Prec", "Sun_time")
    return (
        raw.transform(clean.dedupe_rows)
        .transform(clean.parse_dates, (p := params).dates[:1], p.date_formats)
        .transform(clean.coerce_numbers, numbers)
    )
