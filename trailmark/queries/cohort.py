"""Retention queries."""

from __future__ import annotations

from trailmark.operators import cohort as co
from trailmark.queries.base import Registry, pct, rnd

registry = Registry()
FEATURE = "feature_1"


def retention_sql(users: str, events: str, event: str, period: str, most: int, group: str = "", label: str = "") -> str:
    """CTE ``ret`` from a presence grid: each member beside each period that occurs, marked where the member was there.

    ``label`` is the expression behind the further key ``group``.
    """
    key = f"{group}, " if group else ""
    named = f"{label} AS {group}, " if group else ""
    return f"""presence AS (
        SELECT member.*, span.activity_period, EXISTS (
            SELECT 1 FROM {events} e WHERE e.event_type = '{event}' AND e.user_id = member.user_id
            AND CAST(date_trunc('{period}', e.timestamp) AS DATE) = span.activity_period) AS there
        FROM (SELECT DISTINCT {named}user_id, CAST(date_trunc('{period}', signup_date) AS DATE) AS cohort_period FROM {users}) member
        CROSS JOIN (SELECT DISTINCT CAST(date_trunc('{period}', timestamp) AS DATE) AS activity_period FROM {events}) span),
    grid AS (SELECT {key}cohort_period, activity_period, date_diff('{period}', cohort_period, activity_period) AS periods_out,
        count(*) AS cohort_size, count(*) FILTER (WHERE there) AS active_users
        FROM presence GROUP BY {key}cohort_period, activity_period),
    ret AS (SELECT *, {pct('active_users', 'cohort_size')} AS retention_pct FROM grid WHERE active_users > 0 AND periods_out <= {most})"""


WEEKLY = retention_sql("users_e", "events_e", "purchase", "week", 8)
MONTHLY = retention_sql("users_o", "events_o", "F", "month", 12)
ADOPTERS = f"SELECT user_id FROM feature_usage_o WHERE feature_name = '{FEATURE}'"
BY_FEATURE = retention_sql(
    "users_o", "events_o", "F", "month", 12, "adoption_status", f"if(user_id IN ({ADOPTERS}), 'Adopted', 'Not Adopted')"
)
BY_CHANNEL = retention_sql("users_e", "events_e", "purchase", "week", 8, "acquisition_channel", "acquisition_channel")
COLUMNS = """CAST(cohort_period AS VARCHAR) AS cohort_period, cohort_size, CAST(activity_period AS VARCHAR) AS activity_period,
    periods_out, active_users, retention_pct"""


def weekly(v):
    return co.calculate_retention_cohorts(v.users_e, v.events_e, "week", "purchase", 8)


def monthly(v):
    return co.calculate_retention_cohorts(v.users_o, v.events_o, "month", "F", 12)


def by_feature(v):
    return co.compare_feature_adoption_retention(
        v.users_o, v.events_o, v.feature_usage_o, FEATURE, "month", 12, activity_event="F"
    )


def by_channel(v):
    return co.compare_channel_cohorts(v.users_e, v.events_e, "week", 8, activity_event="purchase")


@registry.add("retention_weekly", f"WITH {WEEKLY} SELECT {COLUMNS} FROM ret")
def _(v):
    return weekly(v)


@registry.add("retention_monthly", f"WITH {MONTHLY} SELECT {COLUMNS} FROM ret")
def _(v):
    return monthly(v)


def cell(p: int) -> str:
    return f"max(CASE WHEN periods_out = {p} THEN retention_pct END) AS week_{p if p >= 0 else f'minus_{-p}'}"


@registry.add(
    "retention_pivot",
    f"""WITH {WEEKLY} SELECT CAST(cohort_period AS VARCHAR) AS cohort_period, max(cohort_size) AS cohort_size,
        {', '.join(cell(p) for p in range(-2, 9))} FROM ret GROUP BY cohort_period""",
)
def _(v):
    return co.pivot_retention_table(weekly(v), -2, 8)


@registry.add(
    "retention_recent",
    f"""WITH {WEEKLY} SELECT {COLUMNS} FROM ret WHERE cohort_period IN
        (SELECT DISTINCT cohort_period FROM ret ORDER BY cohort_period DESC LIMIT 5)""",
)
def _(v):
    return co.recent_cohorts(weekly(v), 5)


@registry.add(
    "retention_by_feature",
    f"""WITH {BY_FEATURE} SELECT adoption_status, CAST(cohort_period AS VARCHAR) AS cohort_period, cohort_size, periods_out,
        active_users, retention_pct FROM ret""",
)
def _(v):
    return by_feature(v)


TWO = """CURVE AS (SELECT periods_out, avg(CASE WHEN {test} THEN retention_pct END) AS a,
    avg(CASE WHEN NOT ({test}) THEN retention_pct END) AS b FROM ret GROUP BY periods_out)"""
LAST = """LAST_ONE AS (SELECT (SELECT a FROM CURVE WHERE a IS NOT NULL ORDER BY periods_out DESC LIMIT 1) AS a,
    (SELECT b FROM CURVE WHERE b IS NOT NULL ORDER BY periods_out DESC LIMIT 1) AS b)"""
ADOPTED = TWO.format(test="adoption_status = 'Adopted'")
Q4 = TWO.format(test="month(cohort_period) IN (10, 11, 12)")
ADOPTED_OUT = f"{rnd('a')} AS adopted, {rnd('b')} AS not_adopted, {pct('(a - b)', 'b', 4)} AS change_pct"
Q4_OUT = f"{rnd('a')} AS q4, {rnd('b')} AS other, {rnd('a - b')} AS difference_pp"


@registry.add("retention_feature_curve", f"WITH {BY_FEATURE}, {ADOPTED} SELECT periods_out, {ADOPTED_OUT} FROM CURVE")
def _(v):
    return co.feature_curves(by_feature(v))


@registry.add("retention_feature_final", f"WITH {BY_FEATURE}, {ADOPTED}, {LAST} SELECT {ADOPTED_OUT} FROM LAST_ONE")
def _(v):
    return co.feature_final_change(by_feature(v))


@registry.add(
    "retention_by_channel",
    f"""WITH {BY_CHANNEL} SELECT acquisition_channel, CAST(cohort_period AS VARCHAR) AS cohort_period, cohort_size,
        periods_out AS weeks_out, active_users, retention_pct FROM ret""",
)
def _(v):
    return by_channel(v)


@registry.add(
    "retention_channel_curve",
    f"""WITH {BY_CHANNEL} SELECT acquisition_channel, periods_out AS weeks_out, {rnd('avg(retention_pct)')} AS mean_retention
        FROM ret GROUP BY acquisition_channel, periods_out""",
)
def _(v):
    return co.mean_curve(by_channel(v), ["acquisition_channel"], "weeks_out")


@registry.add("retention_q4_vs_rest", f"WITH {MONTHLY}, {Q4} SELECT periods_out, {Q4_OUT} FROM CURVE")
def _(v):
    return co.q4_curves(monthly(v))


@registry.add("retention_q4_final", f"WITH {MONTHLY}, {Q4}, {LAST} SELECT {Q4_OUT} FROM LAST_ONE")
def _(v):
    return co.q4_final_difference(monthly(v))
