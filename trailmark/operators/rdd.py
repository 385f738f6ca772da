"""Regression discontinuity around an activity threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.normal import two_sided_p, z_quantile
from trailmark.functions.numeric import flag


def rdd_data(users: DataFrame, running: DataFrame, outcome_users: DataFrame, running_col: str, cutoff: int = 3) -> DataFrame:
    """Per user: running variable (0 if absent), centred, side of the cutoff, 0/1 outcome membership."""
    members = outcome_users.select("user_id").distinct().withColumn("__in", F.lit(True))
    x = F.coalesce(F.col(running_col), F.lit(0)).cast("bigint")
    return (
        users.select("user_id")
        .join(running.select("user_id", running_col), "user_id", "left")
        .join(members, "user_id", "left")
        .select(
            "user_id",
            x.alias("running"),
            (x - cutoff).alias("centered"),
            flag(x >= cutoff).alias("above"),
            flag(F.col("__in")).alias("outcome"),
        )
    )


def rdd_bins(data: DataFrame, min_users: int = 50) -> DataFrame:
    """Mean outcome per value of the running variable, for values with enough users."""
    return (
        data.groupBy("running", "above")
        .agg(F.round(F.avg("outcome"), 6).alias("mean_outcome"), F.count("*").alias("users"))
        .where(F.col("users") >= min_users)
    )


def rdd_estimate(data: DataFrame, bandwidth: int = 3, alpha: float = 0.05) -> DataFrame:
    """Jump at the cutoff: local linear fit with a slope per side, HC1 errors, normal inference. One row.

    Rows are collapsed to (side, x) first. Each side is its own line; with h = 1/n - mean(x)(x - mean(x))/Sxx
    the weight of a row in that side's intercept, the variance is the sum of (h * residual)^2.
    """
    x, y = F.col("centered").cast("double"), F.col("outcome").cast("double")
    points = (
        data.where(F.col("centered").between(-bandwidth, bandwidth))
        .groupBy(F.col("above").alias("side"), x.alias("x"))
        .agg(F.count("*").cast("double").alias("n"), F.sum(y).alias("s"), (F.var_pop(y) * F.count(y)).alias("q"))
    )
    n, mx, my = F.sum("n"), F.sum(F.col("n") * F.col("x")) / F.sum("n"), F.sum("s") / F.sum("n")
    lines = points.groupBy("side").agg(  # two rows
        n.alias("side_n"),
        mx.alias("mx"),
        my.alias("my"),
        (F.sum(F.col("n") * F.col("x") * F.col("x")) - F.sum("n") * mx * mx).alias("sxx"),
        (F.sum(F.col("x") * F.col("s")) - F.sum("n") * mx * my).alias("sxy"),
    )
    lines = lines.withColumn("slope", F.try_divide("sxy", "sxx")).withColumn(
        "intercept", F.col("my") - F.col("slope") * F.col("mx")
    )
    joined = points.join(F.broadcast(lines), "side")
    fit = F.col("intercept") + F.col("slope") * F.col("x")
    weight = 1 / F.col("side_n") - F.try_divide(F.col("mx") * (F.col("x") - F.col("mx")), F.col("sxx"))
    square = F.col("q") + F.col("n") * F.pow(F.col("s") / F.col("n") - fit, 2)
    per_side = joined.groupBy("side", "side_n", "intercept", "slope").agg(F.sum(weight * weight * square).alias("v"))
    wide = per_side.agg(
        F.sum("side_n").alias("n"),
        F.sum("v").alias("v"),
        *[F.max(F.when(F.col("side") == s, F.col("intercept"))).alias(f"a{s}") for s in (0, 1)],
        *[F.max(F.when(F.col("side") == s, F.col("slope"))).alias(f"b{s}") for s in (0, 1)],
    )
    out = wide.withColumn("effect", F.col("a1") - F.col("a0")).withColumn(
        "std_error", F.sqrt(F.try_divide(F.col("n"), F.col("n") - 4) * F.col("v"))
    )
    out = out.withColumn("z", F.try_divide("effect", "std_error"))
    half = F.lit(z_quantile(1 - alpha / 2)) * F.col("std_error")
    return out.select(
        "effect",
        "std_error",
        F.col("z").alias("z_stat"),
        two_sided_p("z").alias("p_value"),
        (F.col("effect") - half).alias("ci_lower"),
        (F.col("effect") + half).alias("ci_upper"),
        F.col("a0").alias("left_intercept"),
        F.col("b0").alias("left_slope"),
        F.col("b1").alias("right_slope"),
        F.col("n").cast("bigint").alias("n_obs"),
    )
