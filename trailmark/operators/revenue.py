"""Lifetime value, plan mix, recurring revenue and churn."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.dates import boundaries_between, period_start
from trailmark.functions.numeric import percent, ratio
from trailmark.plans.quantiles import exact_percentiles

# Monthly price per plan. The annual plan's figure is charged per month as well.
PLAN_PRICES = {"free": "0.00", "premium_monthly": "9.99", "premium_annual": "99.99"}


def price_of(plan: str, prices: Mapping[str, str] = PLAN_PRICES, unknown: str | None = "0.00") -> Column:
    """Exact decimal price of a plan column; ``unknown=None`` leaves other plans NULL."""
    out = F.lit(None if unknown is None else unknown).cast("decimal(10,2)")
    for name, price in prices.items():
        out = F.when(F.col(plan) == name, F.lit(price).cast("decimal(10,2)")).otherwise(out)
    return out


def money(c: str | Column) -> Column:
    """Rounded to cents through decimals, so half cents round up whatever their binary form."""
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value.cast("decimal(24,6)"), 2).cast("double")


def subscription_revenue(
    subscriptions: DataFrame,
    as_of: str,
    prices: Mapping[str, str] = PLAN_PRICES,
    min_months: int | None = 1,
    unknown_price: str | None = "0.00",
) -> DataFrame:
    """Revenue per user: price times month boundaries, open subscriptions ending at ``as_of``."""
    end = F.coalesce(F.to_date("end_date"), F.lit(as_of).cast("date"))
    months = boundaries_between("month", F.col("start_date"), end)
    if min_months is not None:
        months = F.greatest(months, F.lit(min_months).cast("bigint"))
    amount = price_of("plan", prices, unknown_price) * months.cast("decimal(10,0)")
    return subscriptions.groupBy("user_id").agg(
        F.coalesce(F.sum(amount).cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)")).alias("total_revenue")
    )


def _with_revenue(users: DataFrame, revenue: DataFrame, key: Column) -> DataFrame:
    """One row per user: key, revenue with 0 for users who have none."""
    zero = F.lit(0).cast("decimal(24,2)")
    return users.select("user_id", key).distinct().join(revenue, "user_id", "left").withColumn(
        "revenue", F.coalesce("total_revenue", zero)
    )


def calculate_ltv_by_cohort(
    users: DataFrame,
    subscriptions: DataFrame,
    as_of: str,
    cohort_period: str = "month",
    prices: Mapping[str, str] = PLAN_PRICES,
) -> DataFrame:
    """Cumulative revenue per signup cohort: mean, medians over all and over paying users, total."""
    key = period_start("signup_date", cohort_period).alias("cohort_period")
    rows = _with_revenue(users, subscription_revenue(subscriptions, as_of, prices), key)
    totals = rows.groupBy("cohort_period").agg(
        F.count("*").alias("cohort_size"),
        F.count_if(F.col("revenue") > 0).alias("paying_users"),
        F.sum("revenue").cast("double").alias("total_revenue"),
    )
    # Both medians at once: each user counts under 'all', and under 'paying' when they paid.
    measures = F.when(F.col("revenue") > 0, F.array(F.lit("all"), F.lit("paying"))).otherwise(
        F.array(F.lit("all"))
    )
    long = rows.select("cohort_period", F.explode(measures).alias("measure"), "revenue")
    medians = (
        exact_percentiles(long, ["cohort_period", "measure"], "revenue", {"median": 0.5})
        .groupBy("cohort_period")
        .agg(
            F.max(F.when(F.col("measure") == "all", F.col("median"))).alias("median_all"),
            F.max(F.when(F.col("measure") == "paying", F.col("median"))).alias("median_paying"),
        )
    )
    same = F.col("t.cohort_period").eqNullSafe(F.col("m.cohort_period"))
    return (
        totals.alias("t")
        .join(medians.alias("m"), same)
        .select(
            "t.cohort_period",
            "cohort_size",
            "paying_users",
            money(ratio("total_revenue", "cohort_size")).alias("avg_ltv"),
            money("median_all").alias("median_ltv_all"),
            money("median_paying").alias("median_ltv_paying"),
            money("total_revenue").alias("total_revenue"),
        )
        .orderBy("cohort_period")
    )


def calculate_ltv_by_channel(
    users: DataFrame, subscriptions: DataFrame, as_of: str, prices: Mapping[str, str] = PLAN_PRICES
) -> DataFrame:
    """Revenue per acquisition channel; here a stay inside one month earns nothing."""
    revenue = subscription_revenue(subscriptions, as_of, prices, min_months=None, unknown_price=None)
    rows = _with_revenue(users, revenue, F.col("acquisition_channel"))
    totals = rows.groupBy("acquisition_channel").agg(
        F.count("*").alias("total_users"), F.sum("revenue").cast("double").alias("total_revenue")
    )
    return totals.select(
        "acquisition_channel",
        "total_users",
        money(ratio("total_revenue", "total_users")).alias("avg_ltv"),
        money("total_revenue").alias("total_revenue"),
    ).orderBy("acquisition_channel")


def simple_ltv(
    users: DataFrame,
    subscriptions: DataFrame,
    cohort_period: str = "month",
    prices: Mapping[str, str] = PLAN_PRICES,
) -> DataFrame:
    """Subscribers, open monthly revenue and mean plan value (over subscription rows) per cohort."""
    value = price_of("plan", prices)
    per_user = subscriptions.groupBy("user_id").agg(
        F.count("*").alias("subs"),
        F.sum(value).alias("value"),
        F.sum(F.when(F.col("end_date").isNull(), value)).alias("open_value"),
    )
    joined = users.select("user_id", period_start("signup_date", cohort_period).alias("cohort_period")).distinct().join(
        per_user, "user_id", "left"
    )
    out = joined.groupBy("cohort_period").agg(
        F.count("*").alias("cohort_size"),
        F.count("subs").alias("users_with_subs"),
        F.coalesce(F.sum("open_value").cast("double"), F.lit(0.0)).alias("active_mrr"),
        F.sum("value").cast("double").alias("value"),
        F.sum("subs").alias("subs"),
    )
    return out.select(
        "cohort_period",
        "cohort_size",
        "users_with_subs",
        money("active_mrr").alias("active_mrr"),
        money(ratio("value", "subs")).alias("avg_sub_value"),
    ).orderBy("cohort_period")


def _per_user_and(subscriptions: DataFrame, *keys: str, **aggregates: Column) -> DataFrame:
    """Aggregate per user first, so counting users later needs no distinct."""
    return subscriptions.groupBy("user_id", *keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def plan_mix(subscriptions: DataFrame) -> DataFrame:
    """Subscription rows and distinct users per plan."""
    return (
        _per_user_and(subscriptions, "plan", subs=F.count("*"))
        .groupBy("plan")
        .agg(F.sum("subs").alias("count"), F.count("user_id").alias("unique_users"))
    )


def subscription_ranges(subscriptions: DataFrame, as_of: str) -> DataFrame:
    """Start date range, open subscriptions and mean age in days per plan."""
    end = F.coalesce(F.to_date("end_date"), F.lit(as_of).cast("date"))
    days = boundaries_between("day", F.col("start_date"), end)
    return subscriptions.groupBy("plan").agg(
        F.min("start_date").alias("earliest_start"),
        F.max("start_date").alias("latest_start"),
        F.count("*").alias("total_subs"),
        F.count_if(F.col("end_date").isNull()).alias("active_subs"),
        F.round(F.avg(days), 6).alias("avg_days"),
    )


def subscription_coverage(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Users, users with a subscription, and the share."""
    subscribers = subscriptions.select("user_id").distinct().withColumn("has", F.lit(1))
    counts = (
        users.where(F.col("user_id").isNotNull())
        .select("user_id")
        .distinct()
        .join(subscribers, "user_id", "left")
        .agg(F.count("*").alias("total_users"), F.count("has").alias("users_with_subs"))
    )
    return counts.select("*", percent("users_with_subs", "total_users").alias("pct_with_subs"))


def mrr_by_plan(subscriptions: DataFrame, status: str = "active") -> DataFrame:
    """Count, sum and mean of mrr per plan over active subscriptions, and in total (plan 'All')."""
    active = subscriptions.where(F.col("status") == status)
    per_plan = active.groupBy("plan").agg(F.count("*").alias("count"), F.sum("mrr").alias("sum"))
    both = per_plan.rollup("plan").agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.grouping("plan").alias("is_total")
    )
    return both.where(F.col("count").isNotNull()).select(
        F.when(F.col("is_total") == 1, F.lit("All")).otherwise(F.col("plan")).alias("plan"),
        "count",
        money("sum").alias("sum"),
        money(ratio("sum", "count")).alias("mean"),
    )


def churn_rate(subscriptions: DataFrame) -> DataFrame:
    """Cancelled subscription rows over all subscription rows (percent)."""
    counts = subscriptions.agg(
        F.count_if(F.col("status") == "cancelled").alias("cancelled"), F.count("*").alias("subscriptions")
    )
    return counts.select("*", percent("cancelled", "subscriptions").alias("churn_pct"))


def cancellation_reasons(subscriptions: DataFrame) -> DataFrame:
    """Cancelled subscriptions per given reason."""
    cancelled = subscriptions.where((F.col("status") == "cancelled") & F.col("cancellation_reason").isNotNull())
    return cancelled.groupBy("cancellation_reason").agg(F.count("*").alias("count"))


def last_status(subscriptions: DataFrame) -> DataFrame:
    """First start, last end and latest status per user; the latest is by start date, then id."""
    latest = F.struct("start_date", "subscription_id")
    return subscriptions.groupBy("user_id").agg(
        F.min("start_date").alias("first_start"),
        F.max("end_date").alias("last_end"),
        F.max_by("status", latest).alias("last_status"),
    )


def churn_rate_by_last_status(subscriptions: DataFrame) -> DataFrame:
    """Share of subscribers whose latest subscription is cancelled (percent)."""
    counts = last_status(subscriptions).agg(
        F.count_if(F.col("last_status") == "cancelled").alias("churned_users"), F.count("*").alias("users")
    )
    return counts.select("*", percent("churned_users", "users").alias("churn_pct"))
