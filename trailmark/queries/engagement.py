"""Activity, churn comparison and running-state queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmark.operators import engagement as en
from trailmark.operators.profile import integer_histogram
from trailmark.queries.base import Registry, pct, rnd

registry = Registry()
FEATURE = "feature_1"

# Users, their orders as activity events, and their subscriptions.
WEEK1 = """w AS (SELECT e.user_id, count(*) AS week1_scans FROM {events} e JOIN {users} u ON e.user_id = u.user_id
    WHERE e.event_type = '{event}' AND e.timestamp <= CAST(u.signup_date AS TIMESTAMP) + INTERVAL {days} DAY GROUP BY e.user_id)"""
WEEK1_E = WEEK1.format(events="events_e", users="users_e", event="click", days=7)
WEEK1_O = WEEK1.format(events="events_o", users="users_o", event="F", days=7)
OUTCOMES = f"""{WEEK1_O}, c AS (SELECT user_id, bool_or(status = 'cancelled') AS churned FROM subscriptions_o GROUP BY user_id),
    o AS (SELECT u.user_id, u.signup_date, u.acquisition_channel, coalesce(w.week1_scans, 0) AS week1_scans,
          coalesce(w.week1_scans, 0) >= 1 AS onboarded, coalesce(c.churned, false) AS churned
          FROM users_o u LEFT JOIN w ON u.user_id = w.user_id LEFT JOIN c ON u.user_id = c.user_id)"""


def outcomes(v):
    return en.user_outcomes(v.users_o, v.events_o, v.subscriptions_o, "F", threshold=1)


@registry.add("first_week_activity", f"WITH {WEEK1_E} SELECT user_id, week1_scans FROM w")
def _(v):
    return en.first_week_activity(v.events_e, v.users_e, "click")


@registry.add(
    "first_week_activity_from_signup",
    "WITH "
    + WEEK1_E.replace("GROUP BY e.user_id)", "AND e.timestamp >= CAST(u.signup_date AS TIMESTAMP) GROUP BY e.user_id)")
    + " SELECT user_id, week1_scans FROM w",
)
def _(v):
    return en.first_week_activity(v.events_e, v.users_e, "click", from_signup=True)


@registry.add(
    "first_week_histogram", f'WITH {WEEK1_E} SELECT week1_scans AS bin, count(*) AS "count" FROM w GROUP BY week1_scans'
)
def _(v):
    return integer_histogram(en.first_week_activity(v.events_e, v.users_e, "click"), "week1_scans")


@registry.add(
    "churn_by_onboarding",
    f"""WITH {OUTCOMES}, r AS (SELECT avg(CASE WHEN NOT onboarded THEN CAST(churned AS INT) * 100.0 END) AS n,
        avg(CASE WHEN onboarded THEN CAST(churned AS INT) * 100.0 END) AS y FROM o)
    SELECT {rnd('coalesce(n, 0)', 4)} AS churn_pct_not_onboarded, {rnd('coalesce(y, 0)', 4)} AS churn_pct_onboarded,
        {rnd('coalesce(n, 1) / greatest(coalesce(y, 1), 0.01)', 4)} AS churn_ratio FROM r""",
)
def _(v):
    return en.churn_by_onboarding(outcomes(v))


@registry.add(
    "churn_by_feature",
    f"""WITH {OUTCOMES}, r AS (SELECT avg(CASE WHEN f.user_id IS NULL THEN CAST(churned AS INT) * 100.0 END) AS n,
        avg(CASE WHEN f.user_id IS NOT NULL THEN CAST(churned AS INT) * 100.0 END) AS y
        FROM o LEFT JOIN (SELECT DISTINCT user_id FROM feature_usage_o WHERE feature_name = '{FEATURE}') f ON o.user_id = f.user_id)
    SELECT {rnd('coalesce(n, 0)', 4)} AS churn_pct_without, {rnd('coalesce(y, 0)', 4)} AS churn_pct_with,
        {rnd('(1 - coalesce(y, 0) / greatest(coalesce(n, 1), 0.01)) * 100', 4)} AS reduction_pct FROM r""",
)
def _(v):
    return en.churn_by_feature(outcomes(v), v.feature_usage_o, FEATURE)


def churn_sql(key: str) -> str:
    return f"""WITH {OUTCOMES} SELECT {key}, count(*) AS users, count(*) FILTER (WHERE churned) AS churned_users,
        {pct('count(*) FILTER (WHERE churned)', 'count(*)', 4)} AS churn_pct FROM o GROUP BY 1"""


@registry.add("churn_by_segment", churn_sql("acquisition_channel"))
def _(v):
    return en.churn_by(outcomes(v), "acquisition_channel")


@registry.add("churn_by_quarter", churn_sql("quarter(signup_date) AS signup_quarter"))
def _(v):
    return en.churn_by_quarter(outcomes(v))


# Usage and events in one long list of facts, counted per user by kind.
ENGAGEMENT = """fact AS (SELECT user_id, feature_name AS feature, usage_count AS uses, NULL AS event_id, NULL AS kind, NULL AS day FROM feature_usage_o
        UNION ALL SELECT user_id, NULL, NULL, event_id, event_type, CAST(timestamp AS DATE) FROM events_o),
    eng AS (SELECT u.user_id, u.plan_type, count(DISTINCT feature) AS n_features, CAST(coalesce(sum(uses), 0) AS BIGINT) AS total_usage,
        count(event_id) AS total_events, count(*) FILTER (WHERE kind = 'F') AS total_scans, count(*) FILTER (WHERE kind = 'O') AS total_opens,
        count(DISTINCT day) AS active_days
        FROM users_o u LEFT JOIN fact USING (user_id) GROUP BY u.user_id, u.plan_type)"""


@registry.add("engagement_features", f"WITH {ENGAGEMENT} SELECT * FROM eng")
def _(v):
    return en.engagement_features(v.users_o.select("user_id", "plan_type"), v.events_o, v.feature_usage_o, "F", "O")


@registry.add(
    "unresolved_counter",
    """WITH d AS (SELECT *, CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN -1 ELSE 0 END AS delta FROM events_e),
    s AS (SELECT *, sum(delta) OVER w AS s FROM d WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)),
    m AS (SELECT *, min(s) OVER (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS m FROM s)
    SELECT user_id, event_id, CAST(s - least(0, m) AS BIGINT) AS unresolved FROM m""",
)
def _(v):
    return en.unresolved_counter(v.events_e, "error", "click").drop("timestamp")


RELEASES = [("2024-01-01", "2024-01-09", "3.0.0"), ("2024-01-10", "2024-01-19", "3.1.0"), ("2024-01-22", "2024-01-26", "3.2.0")]


@registry.add(
    "version_lookup",
    f"""WITH r(a, b, version) AS (VALUES {', '.join(f"(DATE '{a}', DATE '{b}', '{x}')" for a, b, x in RELEASES)})
    SELECT coalesce(r.version, '4.2.0') AS app_version, count(*) AS events, count(DISTINCT CAST(e.timestamp AS DATE)) AS days
    FROM events_e e LEFT JOIN r ON CAST(e.timestamp AS DATE) BETWEEN r.a AND r.b GROUP BY 1""",
)
def _(v):
    tagged = v.events_e.select(
        en.version_on("timestamp", RELEASES, "4.2.0").alias("app_version"), F.to_date("timestamp").alias("day")
    )
    daily = tagged.groupBy("app_version", "day").agg(F.count("*").alias("n"))
    return daily.groupBy("app_version").agg(F.sum("n").alias("events"), F.count("day").alias("days"))


# Releases as a table: one on every third day of the first nine months that has orders, for 40 days each, so they overlap.
RELEASE_ROWS = """SELECT DISTINCT CAST(timestamp AS DATE) AS start_date, CAST(timestamp AS DATE) + 40 AS end_date
    FROM events_o WHERE day(timestamp) % 3 = 0 AND month(timestamp) <= 9"""


@registry.add(
    "version_lookup_table",
    f"""WITH r AS ({RELEASE_ROWS}), d AS (SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM events_o),
    held AS (SELECT day, min(start_date) AS start_date FROM d JOIN r ON day BETWEEN start_date AND end_date GROUP BY day),
    v AS (SELECT CASE WHEN held.day IS NULL THEN 'none' ELSE concat('v', CAST(held.start_date AS VARCHAR)) END AS app_version
          FROM events_o e LEFT JOIN held ON CAST(e.timestamp AS DATE) = held.day)
    SELECT app_version, count(*) AS events FROM v GROUP BY app_version""",
)
def _(v):
    start = F.to_date("timestamp")
    picked = v.events_o.where((F.dayofmonth("timestamp") % 3 == 0) & (F.month("timestamp") <= 9)).select(start.alias("start_date")).distinct()
    name = F.concat(F.lit("v"), F.col("start_date").cast("string"))
    releases = picked.select("start_date", F.date_add("start_date", 40).alias("end_date"), name.alias("version"))
    return en.with_version(v.events_o, "timestamp", releases, "none").groupBy("app_version").agg(F.count("*").alias("events"))


# Some of the property texts are taken away and some cut off, as broken senders do.
SENT = """(SELECT user_id, CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN substr(properties, 1, 4) ELSE properties END AS text FROM events_e)"""


@registry.add(
    "events_by_property",
    f"""SELECT CAST(json_extract_string(CASE WHEN json_valid(text) THEN text END, '$.k') AS BIGINT) AS k, text IS NOT NULL AND NOT json_valid(text) AS malformed,
        count(*) AS events, count(DISTINCT user_id) AS users FROM {SENT} GROUP BY 1, 2""",
)
def _(v):
    place = F.col("event_id") % 50
    text = F.when(place == 0, F.lit(None)).when(place == 1, F.substring("properties", 1, 4)).otherwise(F.col("properties"))
    read = en.with_property(v.events_e.withColumn("properties", text), {"k": "bigint"})
    return read.groupBy("k", "malformed").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))
