"""Propensity scores, one-to-one matching within a caliper, balance, effect and sensitivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.normal import two_sided_p, upper_tail_p, z_quantile
from trailmark.functions.numeric import flag
from trailmark.operators.engagement import engagement_features
from trailmark.operators.propensity import SeparationError, fit_propensity, propensity_scores, score_equations
from trailmark.plans.lineage import cut
from trailmark.plans.local import side_by_side
from trailmark.plans.nearest import match_cells
from trailmark.plans.skew import offsets_in_groups, rank_in_groups

# The confounders matched on.
MATCH_COVARIATES = ("plan_premium", "n_features", "total_events", "total_scans", "total_opens", "active_days")
RANK_BLOCK = 256

__all__ = [
    "MATCH_COVARIATES", "SeparationError", "arm_outcomes", "balance", "caliper_width", "critical_gamma", "estimate_effect", "fit_propensity",
    "match_pairs", "matched_units", "pair_outcomes", "propensity_scores", "psm_dataset", "score_equations", "score_summary", "sensitivity_analysis",
]


def psm_dataset(
    users: DataFrame,
    events: DataFrame,
    feature_usage: DataFrame,
    subscriptions: DataFrame,
    feature_name: str,
    scan_event: str = "scan_completed",
    open_event: str = "app_open",
) -> DataFrame:
    """One row per user: adopted and churned (0/1), plan_premium and the engagement covariates."""

    def members(df: DataFrame, name: str) -> DataFrame:
        return df.select("user_id").distinct().withColumn(name, F.lit(True))

    adopters = members(feature_usage.where(F.col("feature_name") == feature_name), "__adopted")
    churned = members(subscriptions.where(F.col("status") == "cancelled"), "__churned")
    base = engagement_features(users, events, feature_usage, scan_event, open_event)
    joined = base.join(adopters, "user_id", "left").join(churned, "user_id", "left")
    return joined.select(
        "user_id",
        flag(F.col("__adopted")).alias("adopted"),
        flag(F.col("__churned")).alias("churned"),
        flag(F.col("plan_type") != "free").alias("plan_premium"),
        *MATCH_COVARIATES[1:],
        "total_usage",
    )


def arm_outcomes(data: DataFrame, treatment: str, outcome: str) -> DataFrame:
    """Users and mean outcome per arm."""
    return data.groupBy(treatment).agg(F.count("*").alias("users"), F.round(F.avg(outcome), 6).alias("outcome_rate"))


def score_summary(scored: DataFrame, treatment: str) -> DataFrame:
    """Spread of the propensity score per arm."""
    return scored.groupBy(treatment).agg(
        F.count("*").alias("users"),
        F.avg("propensity").alias("mean"),
        F.stddev_samp("propensity").alias("std"),
        F.min("propensity").alias("min"),
        F.max("propensity").alias("max"),
    )


def caliper_width(scored: DataFrame, caliper: float = 0.2, score: str = "logit") -> float:
    """``caliper`` standard deviations of the score, as one number."""
    return float(caliper * (scored.agg(F.stddev_samp(score)).first()[0] or 0.0))


def _allocate(units: DataFrame, flows: DataFrame, score: str, other: str) -> DataFrame:
    """Give the ranked users of each cell to the cell's flows in turn: (score_t, score_c, k, id).

    Flows become blocks of ranks and users join on their block, so a large cell is many small joins.
    """
    spans = offsets_in_groups(flows, [score], other, F.col("n"), "lo").withColumn("hi", F.col("lo") + F.col("n"))
    blocks = spans.withColumn(
        "block", F.explode(F.sequence(F.floor((F.col("lo") + 1) / RANK_BLOCK), F.floor(F.col("hi") / RANK_BLOCK)))
    )
    placed = units.withColumn("block", F.floor(F.col("rank") / RANK_BLOCK))
    return (
        placed.join(blocks, (placed["score"] == blocks[score]) & (placed["block"] == blocks["block"]))
        .where((F.col("rank") > F.col("lo")) & (F.col("rank") <= F.col("hi")))
        .select("score_t", "score_c", (F.col("rank") - F.col("lo")).alias("k"), "id")
    )


def match_pairs(
    scored: DataFrame, treatment: str, width: float, score: str = "logit", id_column: str = "user_id", cells_per_task: int = 50_000
) -> DataFrame:
    """One-to-one pairs without replacement, nearest scores first, at most ``width`` apart.

    Equal scores are told apart by the md5 of the id; a score that is NULL or no finite number matches nobody.
    Columns: treated_id, control_id, distance.
    """
    units = cut(
        scored.select(
            F.col(id_column).alias("id"), F.col(score).cast("double").alias("score"), F.col(treatment).cast("int").alias("arm")
        ).where("arm is not null and abs(score) < double('infinity')")
    )
    cells = units.groupBy("score").agg(
        F.count_if(F.col("arm") == 1).alias("n_t"), F.count_if(F.col("arm") == 0).alias("n_c")
    )
    flows = match_cells(cells, width, cells_per_task)
    ranked = rank_in_groups(units, ["score", "arm"], "id")
    treated = _allocate(ranked.where("arm = 1"), flows, "score_t", "score_c").withColumnRenamed("id", "treated_id")
    control = _allocate(ranked.where("arm = 0"), flows, "score_c", "score_t").withColumnRenamed("id", "control_id")
    return treated.join(control, ["score_t", "score_c", "k"]).select(
        "treated_id", "control_id", F.abs(F.col("score_t") - F.col("score_c")).alias("distance")
    )


def pair_outcomes(pairs: DataFrame, data: DataFrame, outcome: str, id_column: str = "user_id") -> DataFrame:
    """Pairs with both outcomes."""
    t = data.select(F.col(id_column).alias("treated_id"), F.col(outcome).cast("double").alias("y_t"))
    c = data.select(F.col(id_column).alias("control_id"), F.col(outcome).cast("double").alias("y_c"))
    return pairs.join(t, "treated_id").join(c, "control_id")


def estimate_effect(
    pairs: DataFrame, data: DataFrame, treatment: str, outcome: str, id_column: str = "user_id", alpha: float = 0.05
) -> DataFrame:
    """Mean pair difference with its error, next to the unmatched difference. One row."""
    diff = F.col("y_t") - F.col("y_c")
    matched = pair_outcomes(pairs, data, outcome, id_column).agg(
        F.avg(diff).alias("att"), F.stddev_samp(diff).alias("sd"), F.count("*").alias("n_matched_pairs")
    )
    y = F.col(outcome).cast("double")
    arms = data.agg(
        (F.avg(F.when(F.col(treatment) == 1, y)) - F.avg(F.when(F.col(treatment) == 0, y))).alias("naive_difference"),
        F.count_if(F.col(treatment) == 1).alias("n_treated"),
    )
    out = side_by_side(matched, arms).withColumn(
        "std_error", F.try_divide(F.col("sd"), F.sqrt(F.col("n_matched_pairs").cast("double")))
    )
    out = out.withColumn("t_stat", F.try_divide("att", "std_error"))
    half = F.lit(z_quantile(1 - alpha / 2)) * F.col("std_error")
    return out.select(
        "att",
        "std_error",
        "t_stat",
        two_sided_p("t_stat").alias("p_value"),
        (F.col("att") - half).alias("ci_lower"),
        (F.col("att") + half).alias("ci_upper"),
        "n_matched_pairs",
        (F.col("n_treated") - F.col("n_matched_pairs")).alias("n_unmatched_treated"),
        "naive_difference",
        (F.col("naive_difference") - F.col("att")).alias("bias_removed"),
    )


def balance(data: DataFrame, treatment: str, covariates: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Covariate means per arm and their standardised difference, one row per covariate."""
    arm = F.col(treatment)
    stats = data.agg(
        *[
            f(F.when(arm == a, F.col(c).cast("double"))).alias(f"{n}{a}_{c}")
            for c in covariates
            for a in (0, 1)
            for n, f in (("m", F.avg), ("v", F.var_samp))
        ]
    )

    def smd(c: str):
        pooled = F.sqrt((F.col(f"v1_{c}") + F.col(f"v0_{c}")) / 2)
        return F.when(pooled > 0, (F.col(f"m1_{c}") - F.col(f"m0_{c}")) / pooled).otherwise(F.lit(0.0))

    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("covariate"),
                F.round(F.col(f"m1_{c}"), 6).alias("mean_treated"),
                F.round(F.col(f"m0_{c}"), 6).alias("mean_control"),
                F.round(smd(c), 6).alias("smd"),
                (F.abs(smd(c)) < threshold).alias("balanced"),
            )
            for c in covariates
        ]
    )
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def matched_units(pairs: DataFrame, data: DataFrame, id_column: str = "user_id") -> DataFrame:
    """The rows of ``data`` that are in a pair."""
    ids = pairs.select(F.explode(F.array("treated_id", "control_id")).alias(id_column))
    return data.join(ids, id_column, "left_semi")


def sensitivity_analysis(effect: DataFrame, max_gamma: float = 3.0, step: float = 0.1) -> DataFrame:
    """Rosenbaum bounds for a 0/1 outcome: how strong a hidden bias would undo the effect.

    With pair differences of -1, 0, 1, the mean, its error and the number of pairs give back the
    discordant pairs. At bias gamma at most gamma/(1+gamma) of them favour the effect by chance.
    """
    n = F.col("n_matched_pairs").cast("double")
    d = n * F.col("att") * F.col("att") + n * (n - 1) * F.col("std_error") * F.col("std_error")
    favour = (d + n * F.abs("att")) / 2
    steps = int(round((max_gamma - 1.0) / step))
    gamma = F.explode(F.sequence(F.lit(0), F.lit(steps)))
    grid = effect.select(F.round(d, 0).alias("discordant"), F.round(favour, 0).alias("favour"), gamma.alias("i"))
    grid = grid.withColumn("gamma", F.round(F.lit(1.0) + F.col("i") * F.lit(float(step)), 6))
    p = F.col("gamma") / (1 + F.col("gamma"))
    z = F.try_divide(F.col("favour") - F.col("discordant") * p, F.sqrt(F.col("discordant") * p * (1 - p)))
    out = grid.withColumn("z", z).withColumn("p_value_upper", upper_tail_p("z"))
    return out.select(
        "gamma", "discordant", "favour", "p_value_upper", (F.col("p_value_upper") < 0.05).alias("significant_at_005")
    )


def critical_gamma(bounds: DataFrame) -> DataFrame:
    """The smallest gamma at which the effect is no longer significant (NULL if none)."""
    return bounds.agg(F.min(F.when(~F.col("significant_at_005"), F.col("gamma"))).alias("critical_gamma"))
