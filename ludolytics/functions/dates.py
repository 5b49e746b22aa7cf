"""Date and timestamp column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(ts: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(ts, "MM")


def previous_month(day: Column | str) -> Column:
    """First day of the month before, as DATE."""
    return F.add_months(F.trunc(day, "MM"), -1)


def as_month(month: str | date) -> date:
    """A month argument as its first day; anything but a first day is refused."""
    day = month if isinstance(month, date) else date.fromisoformat(month)
    if day.day != 1:
        raise ValueError(f"not the first day of a month: {month}")
    return day


def shift_month(month: date, by: int) -> date:
    months = month.year * 12 + month.month - 1 + by
    return date(months // 12, months % 12 + 1, 1)


def in_month(ts: Column, month: date) -> Column:
    """Range form of ``date_trunc('month', ts) = month``, which reaches the scan."""
    return in_range(ts, month, shift_month(month, 1))


def in_range(ts: Column, start: date, end: date) -> Column:
    """``start <= ts < end``, compared in the type of ``ts``."""
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def epoch_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_seconds(seconds)


def release_timestamp(text: Column | str) -> Column:
    """``Jan 5, 2020`` or ``5 Jan, 2020``; anything else is NULL."""
    tidy = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.coalesce(
        F.try_to_timestamp(tidy, F.lit("MMM d, yyyy")),
        F.try_to_timestamp(tidy, F.lit("d MMM, yyyy")),
    )


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Completed 24-hour days, truncated towards zero."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return (micros / 86_400_000_000).cast("long")


def years_between(later: Column, earlier: Column) -> Column:
    return whole_days_between(later, earlier) / 365.25


def in_year(ts: Column, year: int) -> Column:
    return in_range(ts, date(year, 1, 1), date(year + 1, 1, 1))


def on_or_before(ts: Column, day: date) -> Column:
    """Range form of ``date(ts) <= day``."""
    return ts < F.date_add(F.lit(day), 1)


def between_days(ts: Column, after: date, until: date) -> Column:
    """Range form of ``after < date(ts) <= until``."""
    return (ts >= F.date_add(F.lit(after), 1)) & (ts < F.date_add(F.lit(until), 1))
