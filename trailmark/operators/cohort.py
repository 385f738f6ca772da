"""Retention cohorts, their pivots and comparison curves.

Every variant is the same two aggregations: distinct (user, period) activity joined to the user's
cohort, counted per (cohort, period), over cohort sizes. Extra keys (adoption, channel) ride along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.dates import boundaries_between, period_start
from trailmark.functions.numeric import percent


def user_activity(events: DataFrame, activity_event: str, period: str) -> DataFrame:
    """Distinct (user, period) pairs with the activity event."""
    return (
        events.where((F.col("event_type") == activity_event) & F.col("user_id").isNotNull())
        .select("user_id", period_start("timestamp", period).alias("activity_period"))
        .distinct()
    )


def _retention(cohorts: DataFrame, activity: DataFrame, extra: Sequence[str], period: str, max_periods: int,
               min_periods: int | None) -> DataFrame:
    keys = [*extra, "cohort_period"]
    out = F.col("periods_out")
    active = (
        cohorts.join(activity, "user_id")
        .groupBy(*keys, "activity_period")
        .agg(F.count("*").alias("active_users"))
        .withColumn("periods_out", boundaries_between(period, "cohort_period", "activity_period"))
        .where(out <= max_periods)
    )
    if min_periods is not None:
        active = active.where(out >= min_periods)
    sizes = cohorts.groupBy(*keys).agg(F.count("*").alias("cohort_size"))
    return active.join(sizes, keys).select(
        *keys,
        "cohort_size",
        "activity_period",
        "periods_out",
        "active_users",
        percent("active_users", "cohort_size").alias("retention_pct"),
    )


def _cohorts(users: DataFrame, period: str, *extra: str | Column) -> DataFrame:
    return users.where(F.col("user_id").isNotNull()).select(
        "user_id", period_start("signup_date", period).alias("cohort_period"), *extra
    ).distinct()  # a user counts once in a cohort, however often listed


def calculate_retention_cohorts(
    users: DataFrame,
    events: DataFrame,
    cohort_period: str = "week",
    activity_event: str = "scan_completed",
    max_periods: int = 12,
    min_periods: int | None = None,
) -> DataFrame:
    """Share of each signup cohort active in each later period.

    Activity before signup gives negative ``periods_out``; it is kept unless ``min_periods`` is set.
    Sorted by cohort and period.
    """
    cohorts = _cohorts(users, cohort_period)
    activity = user_activity(events, activity_event, cohort_period)
    out = _retention(cohorts, activity, [], cohort_period, max_periods, min_periods)
    return out.orderBy("cohort_period", "periods_out")


def pivot_retention_table(retention: DataFrame, first: int = 0, last: int = 12, label: str = "week") -> DataFrame:
    """Cohorts as rows, one column per period from ``first`` to ``last``, NULL where nobody was active.

    Columns are named by the true period; a negative period n is ``<label>_minus_n``.
    """
    names = {p: f"{label}_{p}" if p >= 0 else f"{label}_minus_{-p}" for p in range(first, last + 1)}
    cells = [F.max(F.when(F.col("periods_out") == p, F.col("retention_pct"))).alias(n) for p, n in names.items()]
    return retention.groupBy("cohort_period").agg(F.max("cohort_size").alias("cohort_size"), *cells)


def recent_cohorts(retention: DataFrame, n: int = 5) -> DataFrame:
    """The retention rows of the n latest cohorts."""
    latest = retention.select("cohort_period").distinct().orderBy(F.desc("cohort_period")).limit(n)
    return retention.join(latest, "cohort_period", "left_semi")


def with_adoption(users: DataFrame, feature_usage: DataFrame, feature_name: str) -> DataFrame:
    """Users with a boolean ``adopted``: did they ever use the feature."""
    adopters = (
        feature_usage.where(F.col("feature_name") == feature_name)
        .select("user_id")
        .distinct()
        .withColumn("__adopted", F.lit(True))
    )
    return users.join(adopters, "user_id", "left").withColumn(
        "adopted", F.coalesce("__adopted", F.lit(False))
    ).drop("__adopted")


def compare_feature_adoption_retention(
    users: DataFrame,
    events: DataFrame,
    feature_usage: DataFrame,
    feature_name: str,
    cohort_period: str = "week",
    max_periods: int = 12,
    activity_event: str = "scan_completed",
    min_periods: int | None = None,
) -> DataFrame:
    """Retention split by whether the user ever used the feature, sorted by cohort, status and period."""
    status = F.when(F.col("adopted"), F.lit("Adopted")).otherwise(F.lit("Not Adopted")).alias("adoption_status")
    cohorts = _cohorts(with_adoption(users, feature_usage, feature_name), cohort_period, status)
    activity = user_activity(events, activity_event, cohort_period)
    out = _retention(cohorts, activity, ["adoption_status"], cohort_period, max_periods, min_periods)
    return out.drop("activity_period").orderBy("cohort_period", "adoption_status", "periods_out")


def compare_channel_cohorts(
    users: DataFrame,
    events: DataFrame,
    cohort_period: str = "week",
    max_periods: int = 8,
    activity_event: str = "scan_completed",
    min_periods: int | None = None,
) -> DataFrame:
    """Retention split by acquisition channel, sorted by channel, cohort and period."""
    cohorts = _cohorts(users, cohort_period, "acquisition_channel")
    activity = user_activity(events, activity_event, cohort_period)
    out = _retention(cohorts, activity, ["acquisition_channel"], cohort_period, max_periods, min_periods)
    out = out.withColumnRenamed("periods_out", f"{cohort_period}s_out").drop("activity_period")
    return out.orderBy("acquisition_channel", "cohort_period", f"{cohort_period}s_out")


def mean_curve(retention: DataFrame, by: Sequence[str], period: str = "periods_out") -> DataFrame:
    """Unweighted mean of the cohorts' retention per period."""
    return retention.groupBy(*by, period).agg(F.round(F.avg("retention_pct"), 6).alias("mean_retention"))


def _two_curves(retention: DataFrame, is_first: Column, first: str, second: str) -> DataFrame:
    """Mean retention per period for the rows where ``is_first`` holds and for the rest."""
    pct = F.col("retention_pct")
    return retention.groupBy("periods_out").agg(
        F.avg(F.when(is_first, pct)).alias(first), F.avg(F.when(~is_first, pct)).alias(second)
    )


def _final(curves: DataFrame, first: str, second: str) -> DataFrame:
    """The last period's value of each curve."""
    return curves.agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("periods_out"))).alias(c) for c in (first, second)]
    )


def feature_curves(feature_retention: DataFrame) -> DataFrame:
    """Mean curves of adopters and non-adopters with the relative change per period (percent)."""
    curves = _two_curves(feature_retention, F.col("adoption_status") == "Adopted", "adopted", "not_adopted")
    change = percent(F.col("adopted") - F.col("not_adopted"), "not_adopted", 4)
    return curves.select(
        "periods_out",
        F.round("adopted", 6).alias("adopted"),
        F.round("not_adopted", 6).alias("not_adopted"),
        change.alias("change_pct"),
    )


def feature_final_change(feature_retention: DataFrame) -> DataFrame:
    """The last period's adopter and non-adopter means and their relative change (percent)."""
    curves = _two_curves(feature_retention, F.col("adoption_status") == "Adopted", "adopted", "not_adopted")
    last = _final(curves, "adopted", "not_adopted")
    change = percent(F.col("adopted") - F.col("not_adopted"), "not_adopted", 4)
    return last.select(
        F.round("adopted", 6).alias("adopted"),
        F.round("not_adopted", 6).alias("not_adopted"),
        change.alias("change_pct"),
    )


def _is_q4() -> Column:
    return F.month("cohort_period").isin(10, 11, 12)


def q4_curves(retention: DataFrame) -> DataFrame:
    """Mean curves of October-December cohorts and of the others, with the difference in points."""
    curves = _two_curves(retention, _is_q4(), "q4", "other")
    return curves.select(
        "periods_out",
        F.round("q4", 6).alias("q4"),
        F.round("other", 6).alias("other"),
        F.round(F.col("q4") - F.col("other"), 6).alias("difference_pp"),
    )


def q4_final_difference(retention: DataFrame) -> DataFrame:
    """The last period's Q4 and other means and their difference in points."""
    last = _final(_two_curves(retention, _is_q4(), "q4", "other"), "q4", "other")
    return last.select(
        F.round("q4", 6).alias("q4"),
        F.round("other", 6).alias("other"),
        F.round(F.col("q4") - F.col("other"), 6).alias("difference_pp"),
    )
