"""Arithmetic that stays defined under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmark.functions.dates import as_column


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as a double, NULL when the denominator is 0."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def percent(num: str | Column, den: str | Column, digits: int | None = 2) -> Column:
    """``100 * num / den``, NULL when the denominator is 0."""
    out = F.try_divide(as_column(num).cast("double") * F.lit(100.0), as_column(den).cast("double"))
    return out if digits is None else F.round(out, digits)


def flag(condition: Column) -> Column:
    """1 or 0; NULL conditions count as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))
