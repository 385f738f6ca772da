"""First-week activity, churn comparisons, engagement features and running per-user state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.numeric import flag, percent
from trailmark.operators.cohort import with_adoption


def first_week_activity(
    events: DataFrame,
    users: DataFrame,
    event_type: str = "scan_completed",
    days: int = 7,
    from_signup: bool = False,
    out: str = "week1_scans",
) -> DataFrame:
    """Events of a type up to midnight ``days`` days after signup, per user with at least one.

    There is no lower bound unless ``from_signup``. Events are first counted per (user, day), so a
    very active user reaches the join as a few rows. Midnight itself belongs to the window, so events
    at exactly midnight are counted apart.
    """
    day = F.to_date("timestamp")
    at_midnight = F.col("timestamp") == day.cast("timestamp_ntz")
    daily = (
        events.where((F.col("event_type") == event_type) & F.col("user_id").isNotNull())
        .groupBy("user_id", day.alias("day"), at_midnight.alias("at_midnight"))
        .agg(F.count("*").alias("n"))
    )
    signup = F.to_date("signup_date")
    last = F.date_add(signup, days)
    inside = (F.col("day") < last) | ((F.col("day") == last) & F.col("at_midnight"))
    if from_signup:
        inside = inside & (F.col("day") >= signup)
    return (
        daily.join(users.select("user_id", "signup_date"), "user_id")
        .where(inside)
        .groupBy("user_id")
        .agg(F.sum("n").alias(out))
    )


def churned_users(subscriptions: DataFrame) -> DataFrame:
    """Per subscriber: was any of their subscriptions cancelled."""
    return subscriptions.groupBy("user_id").agg(F.bool_or(F.col("status") == "cancelled").alias("churned"))


def user_outcomes(
    users: DataFrame,
    events: DataFrame,
    subscriptions: DataFrame,
    event_type: str = "scan_completed",
    threshold: int = 3,
) -> DataFrame:
    """Users with week-one activity, the onboarded flag and the churn flag (0 and false when absent)."""
    scans = first_week_activity(events, users, event_type)
    return (
        users.join(scans, "user_id", "left")
        .join(churned_users(subscriptions), "user_id", "left")
        .withColumn("week1_scans", F.coalesce("week1_scans", F.lit(0).cast("bigint")))
        .withColumn("onboarded", F.col("week1_scans") >= threshold)
        .withColumn("churned", F.coalesce("churned", F.lit(False)))
    )


def churn_by(outcomes: DataFrame, *keys: str | Column) -> DataFrame:
    """Churn percentage per group, with group sizes."""
    counts = outcomes.groupBy(*keys).agg(F.count("*").alias("users"), F.count_if("churned").alias("churned_users"))
    return counts.withColumn("churn_pct", percent("churned_users", "users", 4))


def churn_by_quarter(outcomes: DataFrame) -> DataFrame:
    """Churn percentage per calendar quarter of signup."""
    return churn_by(outcomes, F.quarter("signup_date").alias("signup_quarter"))


def churn_by_onboarding(outcomes: DataFrame) -> DataFrame:
    """One row: churn of users below and at the activity threshold, and their ratio."""
    sides = outcomes.agg(
        F.avg(F.when(~F.col("onboarded"), flag(F.col("churned")) * 100.0)).alias("not_onboarded"),
        F.avg(F.when(F.col("onboarded"), flag(F.col("churned")) * 100.0)).alias("onboarded"),
    )
    # An absent side counts as 1 in the ratio, and the divisor never falls under 0.01.
    floor = F.greatest(F.coalesce("onboarded", F.lit(1.0)), F.lit(0.01))
    return sides.select(
        F.round(F.coalesce("not_onboarded", F.lit(0.0)), 4).alias("churn_pct_not_onboarded"),
        F.round(F.coalesce("onboarded", F.lit(0.0)), 4).alias("churn_pct_onboarded"),
        F.round(F.coalesce("not_onboarded", F.lit(1.0)) / floor, 4).alias("churn_ratio"),
    )


def churn_by_feature(outcomes: DataFrame, feature_usage: DataFrame, feature_name: str) -> DataFrame:
    """One row: churn without and with the feature, and the reduction (percent)."""
    tagged = with_adoption(outcomes.select("user_id", "churned"), feature_usage, feature_name)
    sides = tagged.agg(
        F.avg(F.when(~F.col("adopted"), flag(F.col("churned")) * 100.0)).alias("without"),
        F.avg(F.when(F.col("adopted"), flag(F.col("churned")) * 100.0)).alias("with"),
    )
    floor = F.greatest(F.coalesce("without", F.lit(1.0)), F.lit(0.01))
    return sides.select(
        F.round(F.coalesce("without", F.lit(0.0)), 4).alias("churn_pct_without"),
        F.round(F.coalesce("with", F.lit(0.0)), 4).alias("churn_pct_with"),
        F.round((1 - F.coalesce("with", F.lit(0.0)) / floor) * 100, 4).alias("reduction_pct"),
    )


def event_engagement(events: DataFrame, scan_event: str = "scan_completed", open_event: str = "app_open") -> DataFrame:
    """Per user: events, scans, opens and active days, counted by day first so no distinct is needed."""
    daily = (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date("timestamp").alias("day"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("event_type") == scan_event).alias("scans"),
            F.count_if(F.col("event_type") == open_event).alias("opens"),
        )
    )
    return daily.groupBy("user_id").agg(
        F.sum("n").alias("total_events"),
        F.sum("scans").alias("total_scans"),
        F.sum("opens").alias("total_opens"),
        F.count("day").alias("active_days"),
    )


def feature_engagement(feature_usage: DataFrame) -> DataFrame:
    """Per user: distinct features used and total usage."""
    per_feature = feature_usage.groupBy("user_id", "feature_name").agg(F.sum("usage_count").alias("usage"))
    return per_feature.groupBy("user_id").agg(
        F.count("feature_name").alias("n_features"), F.sum("usage").alias("total_usage")
    )


def engagement_features(
    users: DataFrame,
    events: DataFrame,
    feature_usage: DataFrame,
    scan_event: str = "scan_completed",
    open_event: str = "app_open",
) -> DataFrame:
    """Users with engagement counts, 0 where a user has no events or no feature use."""
    names = ["n_features", "total_usage", "total_events", "total_scans", "total_opens", "active_days"]
    return (
        users.join(feature_engagement(feature_usage), "user_id", "left")
        .join(event_engagement(events, scan_event, open_event), "user_id", "left")
        .fillna(0, subset=names)
    )


def unresolved_counter(
    events: DataFrame,
    opens: str = "threat_detected",
    closes: str = "threat_resolved",
    chunk: str = "hour",
    out: str = "unresolved",
) -> DataFrame:
    """Open issues of each user after each event: +1 on ``opens``, -1 on ``closes``, never below 0.

    With s the running sum of +-1 and m its running minimum, the counter is s - least(0, m). Both are
    taken inside (user, time chunk) first and shifted by the totals of the user's earlier chunks, so
    no task sorts more than one user's chunk. Both steps read the same columns, so they share a shuffle.
    """
    delta = F.when(F.col("event_type") == opens, 1).when(F.col("event_type") == closes, -1).otherwise(0)
    rows = events.where(F.col("user_id").isNotNull()).select(
        "user_id",
        "event_id",
        "timestamp",
        delta.cast("bigint").alias("delta"),
        F.date_trunc(chunk, "timestamp").alias("chunk"),
    )
    inside = (
        W.partitionBy("user_id", "chunk").orderBy("timestamp", "event_id").rowsBetween(W.unboundedPreceding, 0)
    )
    local = rows.withColumn("s", F.sum("delta").over(inside))
    local = local.withColumn("m", F.min("s").over(inside))
    chunks = local.groupBy("user_id", "chunk").agg(F.sum("delta").alias("total"), F.min("s").alias("low"))
    before = W.partitionBy("user_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.withColumn("s0", F.coalesce(F.sum("total").over(before), F.lit(0)))
    carried = carried.withColumn("m0", F.min(F.col("s0") + F.col("low")).over(before))
    level = F.col("s0") + F.col("s")
    lowest = F.least(F.lit(0), F.col("m0"), F.col("s0") + F.col("m"))
    return local.join(carried, ["user_id", "chunk"]).select(
        "user_id", "event_id", "timestamp", (level - lowest).alias(out)
    )


def version_on(day: str | Column, releases: Sequence[tuple[str, str, str]], default: str) -> Column:
    """Version whose inclusive date interval holds the day, else the default; the first match wins."""
    value = F.to_date(day) if isinstance(day, str) else day
    found = F.lit(default)
    for start, end, version in reversed(releases):
        bounds = [F.lit(date.fromisoformat(d)) for d in (start, end)]
        found = F.when(value.between(*bounds), F.lit(version)).otherwise(found)
    return found


def with_version(
    df: DataFrame, day: str | Column, releases: DataFrame, default: str | None = None, out: str = "app_version", order: str = "start_date"
) -> DataFrame:
    """``df`` with the version whose inclusive dates hold ``day``, else ``default``, from a table of releases.

    ``releases`` has (start_date, end_date, version) and any number of rows; of several that hold a day, the one of
    least ``order`` wins, then the least version. A NULL end is open: it reaches the last day asked for. Releases
    become one row per day, so the join is by the day and bounded by the calendar, however many releases overlap.
    """
    asked = df.withColumn("__day", F.to_date(day) if isinstance(day, str) else day)
    start = F.to_date("start_date")
    end = F.coalesce(F.to_date("end_date"), F.greatest(asked.agg(F.max("__day")).scalar(), start))
    spans = releases.where("end_date is null or start_date <= end_date").select(
        F.col(order).alias("order"), "version", F.explode(F.sequence(start, end)).alias("__day")
    )
    first = spans.groupBy("__day").agg(F.min(F.struct("order", "version")).alias("__first"))
    found = F.coalesce(F.col("__first.version"), F.lit(default))
    return asked.join(first, "__day", "left").withColumn(out, found).drop("__day", "__first")


def with_property(events: DataFrame, names: Mapping[str, str], column: str = "properties", malformed: str = "malformed") -> DataFrame:
    """``events`` with properties read from their JSON text: ``names`` maps a property to its type.

    A property that lacks, is null, or does not fit its type is NULL. ``malformed`` tells text that is no JSON from
    text without the property; NULL text is not malformed. The text is parsed once a row.
    """
    parsed = events.withColumn("__json", F.try_parse_json(column))
    values = {name: F.try_variant_get("__json", f"$.{name}", kind) for name, kind in names.items()}
    wrong = F.col(column).isNotNull() & F.col("__json").isNull()
    return parsed.withColumns({**values, malformed: wrong}).drop("__json")


def property_text(df: DataFrame, columns: Sequence[str], out: str = "properties") -> DataFrame:
    """``df`` with ``columns`` written as one JSON text, NULLs left out."""
    return df.withColumn(out, F.to_json(F.struct(*columns)))
