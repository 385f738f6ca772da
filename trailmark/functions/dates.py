"""Calendar periods on DATE columns.

Everything goes through DATE, not TIMESTAMP, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "quarter", "year")


def _check(period: str) -> None:
    if period not in PERIODS:
        raise ValueError(f"Unknown period: {period!r}, expected one of {PERIODS}")


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_start(c: str | Column, period: str) -> Column:
    """First day of the period holding ``c``; weeks start on Monday."""
    _check(period)
    day = F.to_date(as_column(c))
    return day if period == "day" else F.trunc(day, period)


def boundaries_between(period: str, start: str | Column, end: str | Column) -> Column:
    """Number of period boundaries crossed from ``start`` to ``end`` (31 Jan -> 1 Feb is one month)."""
    _check(period)
    a, b = F.to_date(as_column(start)), F.to_date(as_column(end))
    if period == "day":
        out = F.datediff(b, a)
    elif period == "week":
        out = F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / F.lit(7)
    elif period == "month":
        out = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    elif period == "quarter":
        out = (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)
    else:
        out = F.year(b) - F.year(a)
    return out.cast("bigint")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed seconds with microsecond precision, as a double."""
    span = as_column(end) - as_column(start)
    return span.cast("interval second").cast("decimal(20,6)").cast("double")


def days_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed time in fractional days."""
    return seconds_between(start, end) / F.lit(86400.0)


def timestamp_literal(value) -> Column:
    """Literal for an inclusive range bound given as text, date or datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")


def in_date_range(c: str | Column, date_range: tuple | None) -> Column:
    """Typed range test, inclusive at both ends; ``None`` keeps every row."""
    if date_range is None:
        return F.lit(True)
    lo, hi = date_range
    return as_column(c).between(timestamp_literal(lo), timestamp_literal(hi))
