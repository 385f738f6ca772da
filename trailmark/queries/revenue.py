"""Revenue and churn queries."""

from __future__ import annotations

from trailmark.operators import revenue as rv
from trailmark.queries.base import Registry, pct, rnd

registry = Registry()
AS_OF = "2001-12-31"
MONTHS = f"date_diff('month', start_date, coalesce(end_date, DATE '{AS_OF}'))"
COHORT = "CAST(date_trunc('month', signup_date) AS DATE)"
PRICES = "price(plan, monthly) AS (VALUES ('free', 0.00), ('premium_monthly', 9.99), ('premium_annual', 99.99))"


def worth_sql(months: str, key: str) -> str:
    """CTE ``worth`` (k, user_id, revenue): a user's first subscription carries the sum over all of the user's."""
    return f"""{PRICES}, paid AS (
        SELECT user_id, sum(coalesce(monthly, 0) * {months}) OVER one AS revenue,
            row_number() OVER (one ORDER BY subscription_id) AS nth
        FROM subscriptions_o LEFT JOIN price USING (plan) WINDOW one AS (PARTITION BY user_id)),
    worth AS (SELECT k, m.user_id, CAST(coalesce(revenue, 0) AS DOUBLE) AS revenue
        FROM (SELECT DISTINCT {key} AS k, user_id FROM users_o) m LEFT JOIN paid ON paid.user_id = m.user_id AND nth = 1)"""


# Payers stand at the end of a cohort's order, so both medians are read off by rank.
@registry.add(
    "ltv_by_cohort",
    f"""WITH {worth_sql(f'greatest({MONTHS}, 1)', COHORT)}, line AS (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY revenue) AS r, count(*) OVER (PARTITION BY k) AS n,
            sum(CASE WHEN revenue > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY k) AS payers FROM worth),
    mark AS (SELECT *, r IN ((n + 1) // 2, (n + 2) // 2) AS mid,
        revenue > 0 AND r - (n - payers) IN ((payers + 1) // 2, (payers + 2) // 2) AS mid_paying FROM line)
    SELECT CAST(k AS VARCHAR) AS cohort_period, count(*) AS cohort_size, count(*) FILTER (WHERE revenue > 0) AS paying_users,
        {rnd('sum(revenue) / count(*)', 2)} AS avg_ltv, {rnd('avg(revenue) FILTER (WHERE mid)', 2)} AS median_ltv_all,
        {rnd('avg(revenue) FILTER (WHERE mid_paying)', 2)} AS median_ltv_paying, {rnd('sum(revenue)', 2)} AS total_revenue
    FROM mark GROUP BY k""",
)
def _(v):
    return rv.calculate_ltv_by_cohort(v.users_o, v.subscriptions_o, AS_OF)


@registry.add(
    "ltv_by_channel",
    f"""WITH {worth_sql(MONTHS, 'acquisition_channel')}
    SELECT k AS acquisition_channel, count(*) AS total_users, {rnd('sum(revenue) / count(*)', 2)} AS avg_ltv,
        {rnd('sum(revenue)', 2)} AS total_revenue FROM worth GROUP BY k""",
)
def _(v):
    return rv.calculate_ltv_by_channel(v.users_o, v.subscriptions_o, AS_OF)


@registry.add(
    "ltv_simple",
    f"""WITH {PRICES}, per_plan AS (SELECT user_id, coalesce(monthly, 0) AS each, count(*) AS held, count(*) - count(end_date) AS still_open
        FROM subscriptions_o LEFT JOIN price USING (plan) GROUP BY ALL),
    holder AS (SELECT user_id, sum(held) AS held, sum(each * held) AS value, sum(each * still_open) AS open_value FROM per_plan GROUP BY user_id)
    SELECT CAST(k AS VARCHAR) AS cohort_period, count(*) AS cohort_size, count(held) AS users_with_subs,
        {rnd('CAST(coalesce(sum(open_value), 0) AS DOUBLE)', 2)} AS active_mrr, {rnd('CAST(sum(value) AS DOUBLE) / sum(held)', 2)} AS avg_sub_value
    FROM (SELECT DISTINCT {COHORT} AS k, user_id FROM users_o) m LEFT JOIN holder USING (user_id) GROUP BY k""",
)
def _(v):
    return rv.simple_ltv(v.users_o, v.subscriptions_o)


@registry.add(
    "plan_mix", 'SELECT plan, count(*) AS "count", count(DISTINCT user_id) AS unique_users FROM subscriptions_o GROUP BY plan'
)
def _(v):
    return rv.plan_mix(v.subscriptions_o)


@registry.add(
    "subscription_ranges",
    f"""SELECT plan, CAST(min(start_date) AS VARCHAR) AS earliest_start, CAST(max(start_date) AS VARCHAR) AS latest_start,
        count(*) AS total_subs, count(CASE WHEN end_date IS NULL THEN 1 END) AS active_subs,
        {rnd(f"avg(date_diff('day', start_date, coalesce(end_date, DATE '{AS_OF}')))")} AS avg_days
    FROM subscriptions_o GROUP BY plan""",
)
def _(v):
    return rv.subscription_ranges(v.subscriptions_o, AS_OF)


@registry.add(
    "subscription_coverage",
    f"""SELECT count(DISTINCT c.c_custkey) AS total_users, count(DISTINCT s.user_id) AS users_with_subs,
        {pct('count(DISTINCT s.user_id)', 'count(DISTINCT c.c_custkey)')} AS pct_with_subs
    FROM customer c LEFT JOIN subscriptions_o s ON c.c_custkey = s.user_id""",
)
def _(v):
    return rv.subscription_coverage(v.customer.withColumnRenamed("c_custkey", "user_id"), v.subscriptions_o)


@registry.add(
    "mrr_by_plan",
    f"""SELECT coalesce(plan, 'All') AS plan, count(*) AS "count", {rnd('sum(mrr)', 2)} AS "sum", {rnd('avg(mrr)', 2)} AS "mean"
    FROM subscriptions_o WHERE status = 'active' GROUP BY GROUPING SETS ((plan), ())""",
)
def _(v):
    return rv.mrr_by_plan(v.subscriptions_o)


@registry.add(
    "churn_rate",
    f"""SELECT count(*) FILTER (WHERE status = 'cancelled') AS cancelled, count(*) AS subscriptions,
        {pct("count(*) FILTER (WHERE status = 'cancelled')", 'count(*)')} AS churn_pct FROM subscriptions_o""",
)
def _(v):
    return rv.churn_rate(v.subscriptions_o)


@registry.add(
    "churn_reasons",
    """SELECT cancellation_reason, count(*) AS "count" FROM subscriptions_o
    WHERE status = 'cancelled' AND cancellation_reason IS NOT NULL GROUP BY cancellation_reason""",
)
def _(v):
    return rv.cancellation_reasons(v.subscriptions_o)


LATEST = """SELECT user_id, min(start_date) AS first_start, max(end_date) AS last_end,
    arg_max(status, (start_date, subscription_id)) AS last_status FROM subscriptions_o GROUP BY user_id"""


@registry.add(
    "user_active_period",
    f"""SELECT user_id, CAST(first_start AS VARCHAR) AS first_start, CAST(last_end AS VARCHAR) AS last_end, last_status FROM ({LATEST})""",
)
def _(v):
    return rv.last_status(v.subscriptions_o)


@registry.add(
    "churn_rate_last_status",
    f"""SELECT count(*) FILTER (WHERE last_status = 'cancelled') AS churned_users, count(*) AS users,
        {pct("count(*) FILTER (WHERE last_status = 'cancelled')", 'count(*)')} AS churn_pct FROM ({LATEST})""",
)
def _(v):
    return rv.churn_rate_by_last_status(v.subscriptions_o)
