"""Dates: lenient parsing, measurement windows, ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_IN_YEAR = 365.25


def iso_date(raw: Column) -> Column:
    return F.try_to_date(raw, "yyyy-MM-dd")


def day_first_date(raw: Column) -> Column:
    return F.try_to_date(raw, "dd/MM/yyyy")


def window_start(reference: Column, months: int) -> Column:
    """First day of the closed window of `months` that ends on `reference`."""
    return F.date_add(F.add_months(reference, -months), 1)


def window_start_date(reference: dt.date, months: int) -> dt.date:
    """The same rule on the driver, where a date becomes a pushed-down literal."""
    total = reference.year * 12 + reference.month - 1 - months
    year, month = divmod(total, 12)
    month += 1
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    last_day = (following - dt.timedelta(days=1)).day
    return dt.date(year, month, min(reference.day, last_day)) + dt.timedelta(days=1)


def months_touched(start: dt.date, end: dt.date) -> list[str]:
    """Every calendar month (yyyyMM) a closed window touches."""
    first = start.year * 12 + start.month - 1
    last = end.year * 12 + end.month - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def filing_years(start: dt.date, end: dt.date) -> list[int]:
    """Years whose filings may be in force in a window: its own and the one before."""
    return list(range(start.year - 1, end.year + 1))


def years_since(started: Column, reference: Column) -> Column:
    return F.datediff(reference, started) / F.lit(DAYS_IN_YEAR)


def track_record(constituted: Column, first_seen: Column, reference: Column) -> Column:
    """Age in years from the constitution date, else from the first observation."""
    return years_since(F.coalesce(constituted, first_seen), reference)
