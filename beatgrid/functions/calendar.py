"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.encode import cycle


def hour_of_hhmm(hhmm: Column) -> Column:
    """Hour of a clock time written as the integer HHMM, e.g. 45 -> 0, 1330 -> 13."""
    return F.substring(F.lpad(hhmm.cast("string"), 4, "0"), 1, 2).cast("int")


def hour_start(ts: Column) -> Column:
    """Timestamp cut to its hour, without a time zone."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_stamp(date: Column, hour: Column) -> Column:
    """Date plus whole hours as a timestamp without a time zone."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def parse_timestamp(text: Column, formats: tuple[str, ...]) -> Column:
    """First format that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def same_day_last_year(date: Column) -> Column:
    return F.add_months(date, -12)


def is_weekend(date: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(date) >= 5


def is_long_weekend(date: Column) -> Column:
    """Friday, Saturday or Sunday."""
    return F.weekday(date) >= 4


def _fixed_holiday(date: Column, month: int, day: int, since: int | None = None) -> Column:
    """The day itself, or the Friday / Monday it is observed on when it falls on a weekend."""

    def falls_on(shifted: Column) -> Column:
        hit = (F.month(shifted) == month) & (F.dayofmonth(shifted) == day)
        return hit if since is None else hit & (F.year(shifted) >= since)

    return (
        falls_on(date)
        | ((F.weekday(date) == 0) & falls_on(F.date_sub(date, 1)))
        | ((F.weekday(date) == 4) & falls_on(F.date_add(date, 1)))
    )


def _nth_weekday(date: Column, month: int, weekday: int, first_day: int, last_day: int) -> Column:
    return (
        (F.month(date) == month)
        & (F.weekday(date) == weekday)
        & F.dayofmonth(date).between(first_day, last_day)
    )


def is_us_holiday(date: Column) -> Column:
    """US federal holidays with their observed days, from 1986 on.

    Fixed values: five dates (Juneteenth from 2021) and six weekday rules. A plain
    expression, so no calendar table has to be joined.
    """
    rules = [
        _fixed_holiday(date, 1, 1),
        _fixed_holiday(date, 6, 19, since=2021),
        _fixed_holiday(date, 7, 4),
        _fixed_holiday(date, 11, 11),
        _fixed_holiday(date, 12, 25),
        _nth_weekday(date, 1, 0, 15, 21),  # Martin Luther King Jr. Day
        _nth_weekday(date, 2, 0, 15, 21),  # Washington's Birthday
        _nth_weekday(date, 5, 0, 25, 31),  # Memorial Day
        _nth_weekday(date, 9, 0, 1, 7),  # Labor Day
        _nth_weekday(date, 10, 0, 8, 14),  # Columbus Day
        _nth_weekday(date, 11, 3, 22, 28),  # Thanksgiving
    ]
    out = rules[0]
    for rule in rules[1:]:
        out = out | rule
    return out


def date_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.weekday(date),
        "quarter": F.quarter(date),
    }


def week_flags(date: Column) -> dict[str, Column]:
    return {
        "weekend": F.when(is_long_weekend(date), "Weekend").otherwise("Weekday"),
        "is_weekend": is_weekend(date).cast("int"),
        "is_holiday": is_us_holiday(date),
        "is_weekend_or_holiday": is_weekend(date) | is_us_holiday(date),
        "week_type": F.when(is_weekend(date), "Weekend").otherwise("Weekday"),
    }


def period_keys(date: Column, hour: Column) -> dict[str, Column]:
    return {
        "year_month_key": F.concat_ws("_", F.year(date), F.month(date)),
        "date_hour_key": F.concat_ws("_", date.cast("string"), hour.cast("string")),
    }


def cycles(date: Column, hour: Column) -> dict[str, Column]:
    out = {}
    for name, value, period in (
        ("hour", hour, 24),
        ("day_of_week", F.weekday(date), 7),
        ("month", F.month(date), 12),
    ):
        out[f"{name}_sin"], out[f"{name}_cos"] = cycle(value, period)
    return out


def with_temporal(df: DataFrame, date: str = "date", hour: str = "hour") -> DataFrame:
    """All time features in one projection."""
    d, h = F.col(date), F.col(hour)
    return df.withColumns(
        {
            **date_parts(d),
            **cycles(d, h),
            **week_flags(d),
            "hour_ts": hour_stamp(d, h),
            **period_keys(d, h),
        }
    )
