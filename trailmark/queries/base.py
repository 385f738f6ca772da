"""Helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.sources.standins import Views, with_views

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Portable result columns: dates as text, doubles rounded, counts as bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def rnd(x: str, digits: int = 6) -> str:
    """SQL for a double rounded half away from zero, through decimals so ties do not depend on binary."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"100.0 * CAST({num} AS DOUBLE) / nullif({den}, 0)", digits)


def t_two_sided_sql(t: str, df: str, steps: int = 2000) -> str:
    """SQL for a two-sided t p-value by Simpson's rule on the density, as an independent check."""
    weight = f"CASE WHEN k = 0 OR k = {steps} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    density = (
        f"exp(lgamma(({df} + 1) / 2e0) - lgamma({df} / 2e0)) / sqrt({df} * pi()) "
        f"* power(1 + power(abs({t}) * k / {steps}e0, 2) / {df}, -({df} + 1) / 2e0)"
    )
    return f"(SELECT 1 - 2 * abs({t}) / {steps}e0 / 3 * sum(({weight}) * {density}) FROM range({steps + 1}) simpson(k))"


class Registry:
    """Collects queries and the SQL text that checks each."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, digits: int = 6):
        def keep(build: Callable[[Views], DataFrame]):
            self.queries[name] = lambda spark, sf_dir: plain(build(Views(spark, sf_dir)), digits)
            if sql is not None:
                self.oracles[name] = with_views(sql)
            return build

        return keep
