"""Product-telemetry views over the test tables.

Each view is one SQL text that Spark and an ANSI SQL engine both accept, so a query and its check
read the same rows. ``{h8(...)}`` marks the one expression the two spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The test tables' columns. A given schema spares reading footers to infer it.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# name -> (views and tables it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "users_e": (
        ("customer", "nation", "events"),
        """
        SELECT c.c_custkey AS user_id, n.n_name AS country, c.c_mktsegment AS acquisition_channel,
               concat('os_', CAST(c.c_custkey % 4 AS STRING)) AS device_os,
               CAST(n.n_regionkey AS INTEGER) AS region,
               DATE '2023-12-04' + CAST((c.c_custkey * 7919) % 42 AS INTEGER) AS signup_date,
               CASE WHEN c.c_acctbal < 0 THEN 'free' WHEN c.c_custkey % 2 = 0 THEN 'premium_monthly'
                    ELSE 'premium_annual' END AS plan_type
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        JOIN (SELECT DISTINCT user_id FROM {events}) e ON c.c_custkey = e.user_id
        """,
    ),
    "events_e": (
        ("events",),
        """
        SELECT event_id, user_id, ts AS timestamp, event_type, value, props AS properties,
               concat(CAST(user_id AS STRING), '_', CAST(CAST(ts AS DATE) AS STRING)) AS session_id
        FROM {events}
        """,
    ),
    "users_o": (
        ("orders", "customer", "nation"),
        """
        SELECT o.user_id, o.signup_date, c.c_mktsegment AS acquisition_channel, n.n_name AS country,
               CASE WHEN c.c_acctbal < 0 THEN 'free' ELSE 'premium_monthly' END AS plan_type,
               c.c_acctbal AS balance, o.n_orders
        FROM (SELECT o_custkey AS user_id, CAST(min(o_orderdate) AS DATE) AS signup_date, count(*) AS n_orders
              FROM {orders} GROUP BY o_custkey) o
        JOIN {customer} c ON o.user_id = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        """,
    ),
    "events_o": (
        ("orders",),
        """
        SELECT o_orderkey AS event_id, o_custkey AS user_id, o_orderdate AS timestamp, o_orderstatus AS event_type
        FROM {orders}
        """,
    ),
    "subscriptions_o": (
        ("orders",),
        """
        SELECT o_orderkey AS subscription_id, o_custkey AS user_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'premium_annual' WHEN '2-HIGH' THEN 'premium_monthly'
                    WHEN '3-MEDIUM' THEN 'premium_monthly' WHEN '5-LOW' THEN 'trial' ELSE 'free' END AS plan,
               CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderstatus = 'O' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST((o_orderkey * 37) % 400 AS INTEGER) END AS end_date,
               CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'renewed' ELSE 'active' END AS status,
               o_totalprice AS mrr,
               CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 5 WHEN 0 THEN 'price' WHEN 1 THEN 'not_using'
                    WHEN 2 THEN 'switched_competitor' WHEN 3 THEN 'technical_issues' END END AS cancellation_reason
        FROM {orders}
        """,
    ),
    "feature_usage_o": (
        ("lineitem", "orders"),
        """
        SELECT o.o_custkey AS user_id, l.feature_name, min(l.first_used_at) AS first_used_at,
               CAST(sum(l.usage_count) AS BIGINT) AS usage_count, max(l.last_used_at) AS last_used_at
        FROM (SELECT l_orderkey, concat('feature_', CAST(l_partkey % 20 AS STRING)) AS feature_name,
                     CAST(min(l_shipdate) AS DATE) AS first_used_at, CAST(max(l_shipdate) AS DATE) AS last_used_at,
                     count(*) AS usage_count
              FROM {lineitem} GROUP BY l_orderkey, concat('feature_', CAST(l_partkey % 20 AS STRING))) l
        JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, l.feature_name
        """,
    ),
    "assignments": (
        ("customer", "nation"),
        """
        SELECT 'exp_001' AS experiment_id, c_custkey AS user_id,
               CASE WHEN {h8(concat('exp_001|', CAST(c_custkey AS STRING)))} % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant,
               DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) AS assigned_at
        FROM {customer}
        UNION ALL
        SELECT 'exp_002', c_custkey,
               CASE WHEN {h8(concat('exp_002|', CAST(c_custkey AS STRING)))} % 2 = 0 THEN 'day_7_upsell' ELSE 'day_3_upsell' END,
               DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER)
        FROM {customer}
        UNION ALL
        SELECT 'exp_004', c.c_custkey, CASE WHEN n.n_regionkey IN (0, 1) THEN 'rollout_group' ELSE 'control_group' END,
               DATE '2024-01-15' + CAST(c.c_custkey % 7 AS INTEGER)
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        """,
    ),
    "metrics": (
        ("orders",),
        """
        SELECT 'exp_001' AS experiment_id, o_custkey AS user_id, 'activated' AS metric_name,
               CAST(max(CASE WHEN o_orderdate < TIMESTAMP '1995-07-01 00:00:00' THEN 1 ELSE 0 END) AS DOUBLE) AS metric_value
        FROM {orders} GROUP BY o_custkey
        UNION ALL
        SELECT 'exp_001', o_custkey, 'revenue', sum(o_totalprice) FROM {orders} GROUP BY o_custkey
        UNION ALL
        SELECT 'exp_002', o_custkey, 'reactivated',
               CAST(max(CASE WHEN o_orderdate >= TIMESTAMP '2001-03-01 00:00:00' THEN 1 ELSE 0 END) AS DOUBLE)
        FROM {orders} GROUP BY o_custkey
        UNION ALL
        SELECT 'exp_002', o_custkey, 'orders', CAST(count(*) AS DOUBLE) FROM {orders} GROUP BY o_custkey
        """,
    ),
}

_HASH = re.compile(r"\{h8\((.*)\)\}")


def _render(sql: str, dialect: str) -> str:
    spelling = (
        r"CAST(conv(substr(md5(\1), 1, 8), 16, 10) AS BIGINT)"
        if dialect == "spark"
        else r"CAST(('0x' || substr(md5(\1), 1, 8)) AS BIGINT)"
    )
    return _HASH.sub(spelling, sql)


class Views:
    """The test tables and the stand-in views over them, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in TABLES):
            raise AttributeError(name)
        if name not in self._frames:
            if name in VIEWS:
                needs, sql = VIEWS[name]
                frames = {n: getattr(self, n) for n in needs}
                self._frames[name] = self.spark.sql(_render(sql, "spark"), **frames)
            else:
                self._frames[name] = self.spark.read.schema(TABLES[name]).parquet(self.path(name))
        return self._frames[name]


def with_views(body: str) -> str:
    """SQL text for another engine: the views ``body`` names, as CTEs in front of it."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    ctes = [f"{v} AS ({_render(VIEWS[v][1], 'ansi').format(**{n: n for n in VIEWS[v][0]})})" for v in used]
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
