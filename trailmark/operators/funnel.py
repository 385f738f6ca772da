"""Conversion funnels, time to convert and drop-off breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.dates import days_between, in_date_range
from trailmark.functions.numeric import percent
from trailmark.plans.quantiles import exact_percentiles
from trailmark.plans.steps import SPANS, steps_done

Steps = Sequence[tuple[str, str]]
CONVERT_PERCENTILES = {"median_days": 0.5, "p25_days": 0.25, "p75_days": 0.75, "p90_days": 0.9}


def step_events(events: DataFrame, steps: Steps, date_range: tuple | None = None) -> DataFrame:
    """Events of the funnel's types inside the range, with a user."""
    wanted = F.col("event_type").isin(sorted({event for _, event in steps}))
    out = events.where(wanted & F.col("user_id").isNotNull())
    return out.where(in_date_range("timestamp", date_range)) if date_range else out


def step_flags(events: DataFrame, steps: Steps, date_range: tuple | None = None) -> DataFrame:
    """One row per user: did_0 .. did_k, whether the user ever did each step."""
    return (
        step_events(events, steps, date_range)
        .groupBy("user_id")
        .agg(*[F.bool_or(F.col("event_type") == event).alias(f"did_{i}") for i, (_, event) in enumerate(steps)])
    )


def step_mapping(steps: Steps) -> dict[str, str]:
    return {f"step_{i}_users": name for i, (name, _) in enumerate(steps)}


def _with_segment(per_user: DataFrame, users: DataFrame | None, segment_by: str | None) -> DataFrame:
    if not segment_by:
        return per_user
    if users is None:
        raise ValueError("segment_by needs the users table")
    # A user listed twice with one value is one user; with two values, one in each segment.
    return per_user.join(users.select("user_id", segment_by).distinct(), "user_id", "left")


def _count_steps(reached: DataFrame, n: int, keys: list[str]) -> DataFrame:
    counts = reached.groupBy(*keys).agg(*[F.count_if(f"did_{i}").alias(f"step_{i}_users") for i in range(n)])
    rates = []
    for i in range(1, n):
        rates.append(percent(f"step_{i}_users", "step_0_users").alias(f"step_0_to_{i}_rate"))
        rates.append(percent(f"step_{i}_users", f"step_{i - 1}_users").alias(f"step_{i - 1}_to_{i}_incremental"))
    return counts.select("*", *rates)


def calculate_funnel(
    events: DataFrame,
    funnel_steps: Steps,
    users: DataFrame | None = None,
    segment_by: str | None = None,
    date_range: tuple | None = None,
    mode: str = "any_order",
    within: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Users reaching each step, of those who did step 0.

    ``any_order`` counts a step whenever the user ever did it, so a later step can exceed an earlier
    one. ``ordered`` needs every step after the one before it, inside one ``within`` value (such as
    ``session_id``) if given. Without a segment there is always exactly one row.
    """
    n = len(funnel_steps)
    if mode == "any_order":
        reached = step_flags(events, funnel_steps, date_range).where("did_0")
    elif mode == "ordered":
        reached = ordered_flags(events, funnel_steps, date_range, within)
    else:
        raise ValueError(f"Unknown mode: {mode}")
    reached = _with_segment(reached, users, segment_by)
    return _count_steps(reached, n, [segment_by] if segment_by else []), step_mapping(funnel_steps)


def ordered_flags(
    events: DataFrame,
    steps: Steps,
    date_range: tuple | None = None,
    within: str | None = None,
    spans: Sequence[int] = SPANS,
) -> DataFrame:
    """One row per user with did_0 .. did_k, each step strictly after the one before.

    The events are read once and folded to step functions by spans of time (``plans.steps``), so neither a step
    nor a heavy user costs a join.
    """
    keys = ["user_id"] + ([within] if within else [])
    source = step_events(events, steps, date_range)
    if within:
        source = source.where(F.col(within).isNotNull())
    done = steps_done(source, keys, "timestamp", [F.col("event_type") == event for _, event in steps], spans).where("done > 0")
    furthest = done.groupBy("user_id").agg(F.max("done").alias("done")) if within else done
    return furthest.select("user_id", *[(F.col("done") > i).alias(f"did_{i}") for i in range(len(steps))])


def funnel_long(funnel: DataFrame, steps: Steps, keys: Sequence[str] = ()) -> DataFrame:
    """One row per step: users, share of the first step, and what was lost to the next step."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("step"),
                    F.lit(name).alias("label"),
                    F.col(f"step_{i}_users").alias("users"),
                    percent(f"step_{i}_users", "step_0_users").alias("pct_of_first"),
                    (F.col(f"step_{i}_users") - F.col(f"step_{i + 1}_users")).alias("drop_off")
                    if i + 1 < len(steps)
                    else F.lit(None).cast("bigint").alias("drop_off"),
                    percent(F.col(f"step_{i}_users") - F.col(f"step_{i + 1}_users"), f"step_{i}_users").alias(
                        "drop_off_pct"
                    )
                    if i + 1 < len(steps)
                    else F.lit(None).cast("double").alias("drop_off_pct"),
                )
                for i, (name, _) in enumerate(steps)
            ]
        )
    )
    return funnel.select(*keys, rows.alias("r")).select(*keys, "r.*")


def top_segments(funnel: DataFrame, segment: str, k: int = 6, by: str = "step_0_users") -> DataFrame:
    """The k largest segments with their rates from step 0; ties go to the smaller segment name."""
    rates = [c for c in funnel.columns if c.endswith("_rate")]
    return funnel.orderBy(F.desc(by), F.asc(segment)).limit(k).select(segment, by, *rates)


def funnel_validity(funnel: DataFrame, steps: Steps, keys: Sequence[str] = ()) -> DataFrame:
    """Per adjacent step pair: does the count not rise, and does the incremental stay within 100%."""
    checks = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f"step_{i - 1}_to_{i}").alias("stage"),
                    (F.col(f"step_{i}_users") <= F.col(f"step_{i - 1}_users")).alias("not_rising"),
                    F.coalesce(F.col(f"step_{i - 1}_to_{i}_incremental") <= 100, F.lit(True)).alias(
                        "incremental_ok"
                    ),
                    F.col(f"step_{i - 1}_to_{i}_incremental").alias("value"),
                )
                for i in range(1, len(steps))
            ]
        )
    )
    return funnel.select(*keys, checks.alias("c")).select(*keys, "c.*")


def conversion_times(events: DataFrame, start_event: str, end_event: str) -> DataFrame:
    """Days from each user's first start event to their first end event, where the latter is later."""
    is_start, is_end = F.col("event_type") == start_event, F.col("event_type") == end_event
    return (
        events.where(F.col("event_type").isin(start_event, end_event) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min(F.when(is_start, F.col("timestamp"))).alias("start_time"),
            F.min(F.when(is_end, F.col("timestamp"))).alias("end_time"),
        )
        .where(F.col("end_time") > F.col("start_time"))
        .select("user_id", days_between("start_time", "end_time").alias("days_to_convert"))
    )


def calculate_time_to_convert(
    events: DataFrame,
    start_event: str,
    end_event: str,
    users: DataFrame | None = None,
    segment_by: str | None = None,
) -> DataFrame:
    """Converted users and the median, 25th, 75th and 90th percentile of days to convert."""
    keys = [segment_by] if segment_by else []
    times = _with_segment(conversion_times(events, start_event, end_event), users, segment_by)
    spread = exact_percentiles(times, keys, "days_to_convert", CONVERT_PERCENTILES, count="converted_users")
    return spread.select(*keys, "converted_users", *[F.round(name, 2).alias(name) for name in CONVERT_PERCENTILES])


def drop_off_counts(
    events: DataFrame,
    users: DataFrame,
    funnel_steps: Steps,
    segments: Sequence[str] = ("country", "acquisition_channel"),
    date_range: tuple | None = None,
) -> DataFrame:
    """Per stage and segment: users at the stage, and those who never did the next step."""
    flags = step_flags(events, funnel_steps, date_range)
    stages = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("stage_no"),
                    F.lit(name).alias("dropped_at_stage"),
                    F.col(f"did_{i}").alias("here"),
                    (~F.col(f"did_{i + 1}")).alias("lost"),
                )
                for i, (name, _) in enumerate(funnel_steps[:-1])
            ]
        )
    )
    return (
        flags.join(users.select("user_id", *segments), "user_id", "left")
        .select(*segments, stages.alias("s"))
        .select(*segments, "s.*")
        .where("here")
        .groupBy("stage_no", "dropped_at_stage", *segments)
        .agg(F.count_if("lost").alias("dropped_users"), F.count("*").alias("users_in_segment"))
        .where(F.col("dropped_users") > 0)
    )


def calculate_drop_off_reasons(
    events: DataFrame,
    users: DataFrame,
    funnel_steps: Steps,
    segments: Sequence[str] = ("country", "acquisition_channel"),
    date_range: tuple | None = None,
    top: int = 10,
) -> DataFrame:
    """The segments losing most users at each stage; ties go by segment value."""
    counts = drop_off_counts(events, users, funnel_steps, segments, date_range)
    order = W.partitionBy("stage_no").orderBy(F.desc("dropped_users"), *[F.asc_nulls_first(s) for s in segments])
    return (
        counts.withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= top)
        .select(
            "dropped_at_stage",
            "dropped_users",
            *segments,
            "users_in_segment",
            percent("dropped_users", "users_in_segment").alias("drop_off_rate"),
        )
    )


def experiment_funnel(
    events: DataFrame,
    assignments: DataFrame,
    experiment_id: str,
    stages: Sequence[tuple[str, str]],
    date_range: tuple | None = None,
) -> DataFrame:
    """Users per stage and variant, with each stage's rate of the first stage (percent)."""
    arms = assignments.where(F.col("experiment_id") == experiment_id).select("user_id", "variant")
    first = stages[0][0]
    counts = (
        step_flags(events, stages, date_range)
        .join(arms, "user_id")
        .groupBy("variant")
        .agg(*[F.count_if(f"did_{i}").alias(name) for i, (name, _) in enumerate(stages)])
    )
    return counts.select("*", *[percent(name, first).alias(f"{name}_rate") for name, _ in stages[1:]])


def experiment_funnel_lift(
    funnel: DataFrame,
    stages: Sequence[tuple[str, str]],
    control_label: str = "control",
    treatment_label: str = "treatment",
) -> DataFrame:
    """Relative lift (percent) of each stage rate, treatment against control; 0 if the control rate is 0."""
    names = [name for name, _ in stages[1:]]

    def of(label: str, name: str) -> Column:
        return F.max(F.when(F.col("variant") == label, F.col(f"{name}_rate")))

    wide = funnel.agg(
        *[of(control_label, n).alias(f"c_{n}") for n in names],
        *[of(treatment_label, n).alias(f"t_{n}") for n in names],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("stage"),
                F.col(f"c_{n}").alias("control_rate"),
                F.col(f"t_{n}").alias("treatment_rate"),
                F.when(
                    F.col(f"c_{n}") > 0,
                    F.round((F.col(f"t_{n}") - F.col(f"c_{n}")) / F.col(f"c_{n}") * 100, 1),
                )
                .when(F.col(f"c_{n}") == 0, F.lit(0.0))
                .alias("lift_pct"),
            )
            for n in names
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")
