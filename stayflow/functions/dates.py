"""Date helpers with the boundary-count semantics of the reference's warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_col(c), "month")


def months_between_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries crossed from start to end (Jan 31 -> Feb 1 is 1)."""
    s, e = _col(start), _col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def years_between_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of year boundaries crossed (Dec 31 -> Jan 1 is 1)."""
    return F.year(_col(end)) - F.year(_col(start))


def day_name(c: str | Column) -> Column:
    """Three-letter English weekday name ('Mon' .. 'Sun')."""
    return F.date_format(_col(c), "E")


def is_weekend(c: str | Column) -> Column:
    """Saturday or Sunday (Spark numbers Sunday 1 and Saturday 7)."""
    return F.dayofweek(_col(c)).isin(1, 7)


def weekday_order(c: str | Column) -> Column:
    """Monday = 1 .. Sunday = 7, for ordering weekday names."""
    return ((F.dayofweek(_col(c)) + 5) % 7) + 1
