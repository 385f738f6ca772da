"""Data quality, frequency, histogram and volume queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators import profile as pf
from trailmark.operators.revenue import churn_rate_by_last_status
from trailmark.operators.experiment import metric_rates
from trailmark.plans.lineage import ensure_checkpoint_dir
from trailmark.queries.base import Registry, pct, rnd
from trailmark.sources.catalog import Catalog, filter_events, table_info, table_rows
from trailmark.sources.standins import TABLES

registry = Registry()


@registry.add(
    "scan_events_filtered",
    """SELECT event_id, user_id, CAST(timestamp AS VARCHAR) AS timestamp, event_type, value, properties, session_id FROM events_e
    WHERE event_type IN ('purchase', 'signup') AND timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07 12:00:00'""",
)
def _(v):
    return filter_events(v.events_e, ["purchase", "signup"], date_range=("2024-01-05", "2024-01-07 12:00:00"))


def catalog(v) -> Catalog:
    """A catalog over tables written from the views, as a user would keep them."""
    ensure_checkpoint_dir(v.spark)
    kept = Catalog(v.spark, f"{v.spark.sparkContext.getCheckpointDir()}/catalog-{uuid.uuid4().hex}")
    kept.write_table("events", v.events_e.drop("value"))
    kept.write_table("users", v.users_e.drop("region"))
    return kept


@registry.add(
    "catalog_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(timestamp AS VARCHAR) AS timestamp, event_type, properties,
        session_id FROM events_e
    WHERE event_type IN ('purchase', 'signup') AND timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07 12:00:00'""",
)
def _(v):
    return catalog(v).query_events(["purchase", "signup"], date_range=("2024-01-05", "2024-01-07 12:00:00"))


@registry.add(
    "catalog_template",
    """SELECT plan_type, count(*) AS users, count(DISTINCT country) AS countries FROM users_e GROUP BY plan_type""",
)
def _(v):
    return catalog(v).query_raw_table("users", "SELECT plan_type, count(*) AS users, count(DISTINCT country) AS countries FROM {table} GROUP BY plan_type")


@registry.add(
    "catalog_audit",
    """SELECT 'users' AS "table", true AS present, (SELECT count(*) FROM users_e) AS "rows" UNION ALL
    SELECT 'events', true, (SELECT count(*) FROM events_e) UNION ALL SELECT 'subscriptions', false, NULL""",
)
def _(v):
    kept = catalog(v)
    found = kept.get_table_info().drop("size_mb")
    return kept.validate_paths().drop("size_mb").join(found, "table", "left")


@registry.add("table_rows", " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS "rows" FROM {t}""" for t in TABLES))
def _(v):
    return table_rows(v.spark, {t: v.path(t) for t in TABLES})


@registry.add("table_info")
def _(v):
    return table_info(v.spark, {t: v.path(t) for t in TABLES})


@registry.add(
    "free_sql",
    """SELECT event_type, count(*) AS "count" FROM events_e GROUP BY event_type""",
)
def _(v):
    return v.spark.sql("SELECT event_type, count(*) AS count FROM {t} GROUP BY event_type", t=v.events_e)


PROFILED = {
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"},
    "subscriptions_o": {
        "subscription_id": "bigint", "user_id": "bigint", "plan": "string", "start_date": "date", "end_date": "date", "status": "string",
        "mrr": "double", "cancellation_reason": "string",
    },
}


def profile_sql(table: str, column: str, dtype: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", '{dtype}' AS dtype, count({column}) AS non_null,
        count(*) - count({column}) AS null_count, {pct(f'(count(*) - count({column}))', 'count(*)', 4)} AS null_pct,
        count(DISTINCT {column}) AS "unique" FROM {table}"""


@registry.add("column_profile", " UNION ALL ".join(profile_sql(t, c, d) for t, cs in PROFILED.items() for c, d in cs.items()))
def _(v):
    parts = [pf.check_data_quality(getattr(v, t).select(*cs), t) for t, cs in PROFILED.items()]
    return reduce(DataFrame.unionByName, parts)


KEYS = {"events": "event_id", "orders": "o_custkey", "customer": "c_custkey", "lineitem": "l_orderkey"}


@registry.add(
    "duplicate_keys",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{k}' AS "key", count(*) - count(DISTINCT {k}) AS duplicates FROM {t}""" for t, k in KEYS.items()
    ),
)
def _(v):
    return reduce(DataFrame.unionByName, [pf.duplicate_keys(getattr(v, t), k, t) for t, k in KEYS.items()])


RANGES = {"users_e": "signup_date", "subscriptions_o": "start_date", "events_o": "timestamp"}


@registry.add(
    "date_ranges",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {t}"""
        for t, c in RANGES.items()
    ),
)
def _(v):
    return reduce(DataFrame.unionByName, [pf.value_range(getattr(v, t), c, t) for t, c in RANGES.items()])


@registry.add(
    "orphan_users",
    """SELECT 'events_e' AS "table", count(DISTINCT user_id) AS orphans FROM events_e WHERE user_id NOT IN (SELECT user_id FROM users_o)
    UNION ALL SELECT 'customer', count(DISTINCT c_custkey) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def _(v):
    a = pf.orphan_count(v.events_e, v.users_o).select(F.lit("events_e").alias("table"), "orphans")
    customers = v.customer.withColumnRenamed("c_custkey", "user_id")
    return a.unionByName(pf.orphan_count(customers, v.events).select(F.lit("customer").alias("table"), "orphans"))


@registry.add("unknown_ids", "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(v):
    return pf.unknown_ids(v.customer, v.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@registry.add(
    "freq_pct",
    f"""SELECT acquisition_channel, count(*) AS "count", {pct('count(*)', '(SELECT count(*) FROM users_o)', 4)} AS pct
    FROM users_o GROUP BY acquisition_channel""",
)
def _(v):
    return pf.frequency(v.users_o, "acquisition_channel")


ARMS = ["control_group", "rollout_group"]


def cells(values: list[str]) -> str:
    listed = ", ".join(f"'{a}'" for a in values)
    picked = ", ".join(f"count(*) FILTER (WHERE variant = '{a}') AS {a}" for a in values)
    return f"""{picked}, count(*) FILTER (WHERE variant IS NULL OR variant NOT IN ({listed})) AS "Other\""""


@registry.add(
    "crosstab_margins",
    f"""SELECT coalesce(u.country, 'All') AS country, {cells(ARMS)}, count(*) AS "All" FROM assignments a JOIN users_o u ON a.user_id = u.user_id
    WHERE experiment_id = 'exp_004' GROUP BY GROUPING SETS ((u.country), ())""",
)
def _(v):
    joined = v.assignments.where(F.col("experiment_id") == "exp_004").join(v.users_o, "user_id")
    return pf.crosstab(joined, "country", "variant", ARMS)


VARIANTS = ["control", "treatment", "day_7_upsell", "day_3_upsell", "rollout_group", "control_group"]


@registry.add(
    "variant_pivot",
    f"""SELECT experiment_id, {cells(VARIANTS)}
    FROM assignments GROUP BY experiment_id""",
)
def _(v):
    return pf.pivot_counts(v.assignments, "experiment_id", "variant", VARIANTS)


@registry.add(
    "histogram_bins",
    f"""WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 50 AS width FROM orders),
    x AS (SELECT CAST(least(floor((o_totalprice - lo) / width), 49) AS INTEGER) AS bin, lo, width FROM orders, b)
    SELECT bin, {rnd('lo + bin * width')} AS bin_start, {rnd('lo + (bin + 1) * width')} AS bin_end, count(*) AS "count"
    FROM x GROUP BY bin, lo, width""",
)
def _(v):
    return pf.histogram(v.orders, "o_totalprice", 50)


@registry.add(
    "daily_volume_ma7",
    f"""WITH d AS (SELECT CAST(timestamp AS DATE) AS event_date, count(*) AS n FROM events_e GROUP BY 1)
    SELECT CAST(event_date AS VARCHAR) AS event_date, n AS "count",
        CASE WHEN count(*) OVER w = 7 THEN {rnd('avg(n) OVER w')} END AS ma7
    FROM d WINDOW w AS (ORDER BY event_date ROWS 6 PRECEDING)""",
)
def _(v):
    return pf.daily_volume(v.events_e)


@registry.add(
    "monthly_signups",
    """SELECT CAST(CAST(date_trunc('month', signup_date) AS DATE) AS VARCHAR) AS signup_month, count(*) AS "count" FROM users_o GROUP BY 1""",
)
def _(v):
    return pf.volume_by(v.users_o, "signup_date", "month", "signup_month")


@registry.add(
    "events_per_user_stats",
    f"""WITH p AS (SELECT user_id, count(*) AS n FROM events_e GROUP BY user_id)
    SELECT CAST(sum(n) AS BIGINT) AS total_events, count(*) AS unique_users, {rnd('sum(n) * 1.0 / count(*)', 1)} AS avg_events_per_user,
        min(n) AS min_events, {rnd('quantile_cont(n, 0.5)', 2)} AS median_events, max(n) AS max_events FROM p""",
)
def _(v):
    return pf.event_stats(v.events_e)


LOADED = {
    "users": "users_o", "events": "events_o", "subscriptions": "subscriptions_o", "feature_usage": "feature_usage_o",
    "experiment_assignments": "assignments", "experiment_metrics": "metrics",
}


@registry.add(
    "validation_report",
    " UNION ALL ".join(f"""SELECT 'rows' AS "check", '{n}' AS item, CAST(count(*) AS DOUBLE) AS value FROM {t}""" for n, t in LOADED.items())
    + f"""
    UNION ALL SELECT 'churn_pct', 'subscriptions', {pct("count(*) FILTER (WHERE status = 'cancelled')", 'count(*)')} FROM
        (SELECT status, row_number() OVER (PARTITION BY user_id ORDER BY start_date DESC, subscription_id DESC) AS i FROM subscriptions_o) WHERE i = 1
    UNION ALL SELECT 'metric_rate', concat(a.experiment_id, '/', m.metric_name, '/', a.variant), {rnd('avg(m.metric_value)')}
        FROM metrics m JOIN assignments a ON m.experiment_id = a.experiment_id AND m.user_id = a.user_id
        GROUP BY a.experiment_id, m.metric_name, a.variant
    UNION ALL SELECT 'orphans', 'events.user_id', count(DISTINCT user_id) FROM events_e WHERE user_id NOT IN (SELECT user_id FROM users_o)""",
)
def _(v):
    return pf.validation_report(
        {name: getattr(v, view) for name, view in LOADED.items()},
        churn_rate_by_last_status(v.subscriptions_o),
        metric_rates(v.assignments, v.metrics),
        pf.orphan_count(v.events_e, v.users_o),
    )
