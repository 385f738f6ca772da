"""Data quality, frequency tables, cross-tabs, histograms and volume series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.functions.numeric import percent, ratio
from trailmark.plans.local import local_table, side_by_side
from trailmark.plans.quantiles import exact_percentiles
from trailmark.plans.skew import attach_group_values


def _as_text(field: T.StructField) -> Column:
    """A column as text that tells its values apart; NULL stays NULL."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # -0.0 is 0.0
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        c = F.when(c.isNotNull(), F.to_json(F.struct(c)))
    elif isinstance(field.dataType, T.BinaryType):
        c = F.hex(c)
    return c.cast("string")


def check_data_quality(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, non-null and null counts, null share, distinct values.

    The table is read once: each row gives its (column, value) pairs, which are counted map-side before they are
    shuffled, so neither many columns nor a frequent value cost a scan or a group of their own.
    """
    fields = df.schema.fields
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), _as_text(f).alias("v")) for i, f in enumerate(fields)])
    values = df.select(F.explode(pairs).alias("x")).groupBy("x.at", "x.v").agg(F.count("*").alias("n"))
    counted = values.groupBy("at").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("non_null"),
        F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("null_count"),
        F.count("v").alias("unique"),
    )
    told = [{"at": i, "table": name, "column": f.name, "dtype": f.dataType.simpleString()} for i, f in enumerate(fields)]
    columns = local_table(df.sparkSession, told, "at int, table string, column string, dtype string")
    rows = columns.join(counted, "at", "left").fillna(0, ["non_null", "null_count", "unique"])
    share = percent("null_count", F.col("non_null") + F.col("null_count"), 4)
    return rows.select("table", "column", "dtype", "non_null", "null_count", share.alias("null_pct"), "unique")


def duplicate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the first of each key value: COUNT(*) - COUNT(DISTINCT key)."""
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    return per_key.agg(
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("k")).cast("bigint").alias("duplicates")
    ).select(F.lit(name).alias("table"), F.lit(key).alias("key"), "duplicates")


def value_range(df: DataFrame, column: str, name: str) -> DataFrame:
    """Smallest and largest value of a column, as text."""
    return df.agg(F.min(column).cast("string").alias("min_value"), F.max(column).cast("string").alias("max_value")).select(
        F.lit(name).alias("table"), F.lit(column).alias("column"), "min_value", "max_value"
    )


def unknown_ids(left: DataFrame, right: DataFrame, key: str = "user_id") -> DataFrame:
    """Distinct ids on the left that the right does not have (set difference)."""
    ids = left.where(F.col(key).isNotNull()).select(key).distinct()
    return ids.join(right.select(key), key, "left_anti")


def orphan_count(left: DataFrame, right: DataFrame, key: str = "user_id") -> DataFrame:
    """Referential check: how many distinct ids are unknown on the right."""
    return unknown_ids(left, right, key).agg(F.count("*").alias("orphans"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share (percent)."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(column, "count", percent("count", total, 4).alias("pct"))


def _count_cells(columns: str, values: Sequence[str], other: str) -> list[Column]:
    """Sums of ``n`` per listed value, and of all that is not listed, NULL included."""
    listed = F.coalesce(F.col(columns).isin(*values), F.lit(False))
    picks = {v: F.col(columns) == v for v in values} | {other: ~listed}
    return [F.coalesce(F.sum(F.when(p, F.col("n"))), F.lit(0)).cast("bigint").alias(v) for v, p in picks.items()]


def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence[str], other: str = "Other") -> DataFrame:
    """Counts per (row, column value), absent cells 0; values not listed count under ``other``."""
    cells = _count_cells(columns, values, other)
    return df.groupBy(rows, columns).agg(F.count("*").alias("n")).groupBy(rows).agg(*cells)


def crosstab(
    df: DataFrame, rows: str, columns: str, values: Sequence[str], total: str = "All", other: str = "Other"
) -> DataFrame:
    """Counts per (row, column value) with row, column and grand totals; the cells of a row add up to its total."""
    counts = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).groupBy(rows, columns).agg(
        F.count("*").alias("n")
    )
    cells = _count_cells(columns, values, other)
    both = counts.rollup(rows).agg(*cells, F.sum("n").alias(total), F.grouping(rows).alias("is_total"))
    label = F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(rows).cast("string"))
    return both.where(F.col(total).isNotNull()).select(label.alias(rows), *values, other, total)


def histogram(df: DataFrame, column: str, bins: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the group's smallest and largest value; the last bin is closed.

    Without groups, bounds and bins combine map-side and only bins are shuffled. With groups, values are
    counted first, so what meets the group's bounds in a join is distinct values.
    """
    rows = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("v"))
    if keys:
        counts = rows.groupBy(*keys, "v").agg(F.count("*").alias("n"))
    else:
        counts = rows.withColumn("n", F.lit(1).cast("bigint"))
    bounds = counts.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if keys:
        joined = attach_group_values(counts, bounds, keys, ["v"])
    else:
        joined = counts.select("*", *[bounds.select(c).scalar().alias(c) for c in ("lo", "hi")])
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0))
    binned = joined.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    return (
        binned.groupBy(*keys, "bin", "lo", width.alias("width"))
        .agg(F.sum("n").alias("count"))
        .select(
            *keys,
            "bin",
            F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
            F.round(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 6).alias("bin_end"),
            "count",
        )
    )


def integer_histogram(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per integer value."""
    return df.groupBy(*keys, F.floor(column).cast("bigint").alias("bin")).agg(F.count("*").alias("count"))


def volume_by(df: DataFrame, ts: str, period: str, out: str) -> DataFrame:
    """Rows per calendar period."""
    day = F.to_date(ts)
    start = day if period == "day" else F.trunc(day, period)
    return df.groupBy(start.alias(out)).agg(F.count("*").alias("count"))


def daily_volume(events: DataFrame, window: int = 7) -> DataFrame:
    """Events per day with the mean of the last ``window`` days present, NULL until there are enough.

    The unpartitioned window runs over one row per day.
    """
    days = volume_by(events, "timestamp", "day", "event_date")
    recent = W.partitionBy(F.lit(1)).orderBy("event_date").rowsBetween(-(window - 1), 0)
    return days.withColumn(
        f"ma{window}",
        F.when(F.count("*").over(recent) == window, F.round(F.avg("count").over(recent), 6)),
    )


def event_stats(events: DataFrame) -> DataFrame:
    """Events, users with events, events per user (one decimal), and the spread over users."""
    per_user = events.groupBy("user_id").agg(F.count("*").alias("n"))
    totals = per_user.agg(
        F.sum("n").alias("total_events"),
        F.count("user_id").alias("unique_users"),
        F.min("n").alias("min_events"),
        F.max("n").alias("max_events"),
    )
    median = exact_percentiles(per_user, [], "n", {"median_events": 0.5})
    return side_by_side(totals, median).select(
        "total_events",
        "unique_users",
        F.round(ratio("total_events", "unique_users"), 1).alias("avg_events_per_user"),
        "min_events",
        F.round("median_events", 2).alias("median_events"),
        "max_events",
    )


def validation_report(
    tables: Mapping[str, DataFrame], churn: DataFrame, experiment_rates: DataFrame, orphans: DataFrame
) -> DataFrame:
    """Load-time report in long form: row counts, churn, metric rates per experiment arm, orphans.

    ``churn`` is by the last status of each user, as ``revenue.churn_rate_by_last_status`` gives it.
    """
    parts = [
        df.agg(F.count("*").cast("double").alias("value")).select(
            F.lit("rows").alias("check"), F.lit(name).alias("item"), "value"
        )
        for name, df in tables.items()
    ]
    parts.append(
        churn.select(F.lit("churn_pct").alias("check"), F.lit("subscriptions").alias("item"), F.col("churn_pct").alias("value"))
    )
    parts.append(
        experiment_rates.select(
            F.lit("metric_rate").alias("check"),
            F.concat_ws("/", "experiment_id", "metric_name", "variant").alias("item"),
            F.col("rate").alias("value"),
        )
    )
    parts.append(
        orphans.select(
            F.lit("orphans").alias("check"), F.lit("events.user_id").alias("item"), F.col("orphans").cast("double").alias("value")
        )
    )
    return reduce(DataFrame.unionByName, parts)
