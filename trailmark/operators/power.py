"""Sample size and power for proportion tests, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.dates import as_column
from trailmark.functions.normal import z_quantile


def _z_alpha(alpha: float, two_sided: bool) -> float:
    return z_quantile(1 - alpha / 2) if two_sided else z_quantile(1 - alpha)


def control_size(p1: Column, mde: Column, z_alpha: Column, z_beta: Column, ratio: float = 1.0) -> Column:
    """Users needed in control for a relative lift ``mde``; NULL if the two rates coincide."""
    r = F.lit(float(ratio))
    p2 = p1 * (1 + mde)
    pooled = (p1 + r * p2) / (1 + r)
    root = z_alpha * F.sqrt((1 + 1 / r) * pooled * (1 - pooled)) + z_beta * F.sqrt(
        p1 * (1 - p1) + p2 * (1 - p2) / r
    )
    return F.ceil(F.try_divide(root * root, (p2 - p1) * (p2 - p1)))


def compute_sample_size(
    plans: DataFrame,
    baseline: str | Column = "baseline_rate",
    mde: str | Column = "mde",
    alpha: float = 0.05,
    power: float = 0.80,
    two_sided: bool = True,
    ratio: float = 1.0,
) -> DataFrame:
    """Add the required sizes and effects to a table of baselines and relative lifts."""
    p1, lift = as_column(baseline), as_column(mde)
    n = control_size(p1, lift, F.lit(_z_alpha(alpha, two_sided)), F.lit(z_quantile(power)), ratio)
    n_treatment = F.ceil(n * F.lit(float(ratio)))
    return plans.select(
        "*",
        n.alias("n_control"),
        n_treatment.alias("n_treatment"),
        (n + n_treatment).alias("n_total"),
        (p1 * (1 + lift)).alias("treatment_rate"),
        (p1 * (1 + lift) - p1).alias("absolute_effect"),
        lift.alias("relative_effect"),
        F.lit(alpha).alias("alpha"),
        F.lit(power).alias("power"),
    )


def power_curve(
    baselines: DataFrame,
    baseline: str | Column = "baseline_rate",
    mde_percents: Sequence[int] = tuple(range(2, 31, 2)),
    alpha: float = 0.05,
    power_levels: Sequence[float] = (0.70, 0.80, 0.90),
) -> DataFrame:
    """Required size over a grid of relative lifts (whole percents) and power levels, per baseline row."""
    keep = [c for c in baselines.columns]
    levels = F.array(
        *[F.struct(F.lit(p).alias("power"), F.lit(z_quantile(p)).alias("z_beta")) for p in power_levels]
    )
    grid = (
        baselines.withColumn("__p1", as_column(baseline))
        .withColumn("__pct", F.explode(F.array(*[F.lit(int(p)) for p in mde_percents])))
        .withColumn("__level", F.explode(levels))
    )
    lift = F.col("__pct") / F.lit(100.0)
    n = control_size(F.col("__p1"), lift, F.lit(_z_alpha(alpha, True)), F.col("__level.z_beta"))
    return grid.select(
        *keep,
        lift.alias("mde"),
        F.col("__level.power").alias("power"),
        n.alias("n_per_variant"),
        (n * 2).alias("n_total"),
    )


def one_baseline(spark: SparkSession, rate: float) -> DataFrame:
    """A one-row plan for asking about a single baseline."""
    return spark.range(1).select(F.lit(float(rate)).alias("baseline_rate"))
