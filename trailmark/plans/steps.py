"""Ordered steps as functions that can be put one after another.

How far a user gets through k steps depends on the order of all their events, yet need not be found by one task
that reads them in order. What the events of a span of time do is a function of the steps done before it: an array
with the steps done after it for 0 .. k-1 done before. Two spans that follow each other are the functions one after
the other. So seconds are folded first, then hours of seconds, then all hours, each a grouped aggregation whose
groups are bounded by the clock, whoever holds how many events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = (1, 3600)  # seconds; a span holds whole spans of the one before


def seconds_of(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970 in the order of the column, with or without time zone."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_seconds(c)
    day = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint")


def _unchanged(k: int) -> Column:
    return F.array(*[F.lit(i) for i in range(k)])


def _second(k: int, moments: Column, kind: T.DataType) -> Column:
    """The function of one second from its distinct (moment, bits of the steps that happen then)."""

    def meet(a: Column, e: Column) -> Column:
        happens = F.call_function("shiftright", e["bits"], a["done"]).bitwiseAND(F.lit(1)) == 1
        later = a["at"].isNull() | (e["at"] > a["at"])  # one step a moment: the next must be strictly later
        moved = F.struct((a["done"] + 1).alias("done"), e["at"].alias("at"))
        return F.when((a["done"] < k) & happens & later, moved).otherwise(a)

    start = F.array(*[F.struct(F.lit(i).alias("done"), F.lit(None).cast(kind).alias("at")) for i in range(k)])
    return F.aggregate(moments, start, lambda acc, e: F.transform(acc, lambda a: meet(a, e)), lambda acc: F.transform(acc, lambda a: a["done"]))


def _composed(k: int, parts: Column) -> Column:
    """One function for parts (span, f) in the order of their spans."""
    ordered = F.sort_array(parts)
    return F.aggregate(
        ordered, _unchanged(k), lambda f, part: F.transform(f, lambda i: F.when(i < k, F.get(part["f"], i)).otherwise(i))
    )


def steps_done(events: DataFrame, keys: Sequence[str], time_column: str, happens: Sequence[Column], spans: Sequence[int] = SPANS) -> DataFrame:
    """``keys`` and ``done``: how many of the steps follow each other in the key's events, 0 .. k.

    Step i happens at an event where ``happens[i]`` is true; its first time strictly after step i - 1 counts.
    Events of no step and events without a time are left out, and with them keys that have no others. One scan and
    one grouping per span and one over all of them; an event may be of several steps, steps may be alike.
    """
    k = len(happens)
    if not 1 <= k <= 31:
        raise ValueError(f"{k} steps; 1 to 31 can be told apart")
    bits = sum((F.when(h, F.lit(1 << i)).otherwise(F.lit(0)) for i, h in enumerate(happens)), F.lit(0))
    rows = events.withColumn("__bits", bits).where((F.col("__bits") > 0) & F.col(time_column).isNotNull())
    at = F.floor(seconds_of(rows, time_column) / spans[0]).cast("bigint")
    rows = rows.select(*keys, at.alias("__span"), F.struct(F.col(time_column).alias("at"), F.col("__bits").alias("bits")).alias("__moment"))
    found = rows.groupBy(*keys, "__span").agg(F.sort_array(F.collect_set("__moment")).alias("__moments"))
    found = found.select(*keys, "__span", _second(k, F.col("__moments"), events.schema[time_column].dataType).alias("f"))
    for wide, narrow in zip(spans[1:], spans):
        part = F.struct(F.col("__span").alias("span"), F.col("f"))
        found = (
            found.groupBy(*keys, F.floor(F.col("__span") * narrow / wide).cast("bigint").alias("__wide"))
            .agg(F.collect_list(part).alias("__parts"))
            .select(*keys, F.col("__wide").alias("__span"), _composed(k, F.col("__parts")).alias("f"))
        )
    whole = found.groupBy(*keys).agg(F.collect_list(F.struct(F.col("__span").alias("span"), F.col("f"))).alias("__parts"))
    return whole.select(*keys, F.get(_composed(k, F.col("__parts")), F.lit(0)).alias("done"))
