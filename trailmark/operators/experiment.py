"""A/B test analysis for all experiments in one plan.

Metrics are summed per user, joined to assignments, and reduced to arm totals once; every test is
then arithmetic on one row per experiment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.normal import chi2_1df_p, two_sided_p, z_quantile
from trailmark.functions.numeric import flag, percent, ratio
from trailmark.functions.ranksum import SMALL, exact_u_p
from trailmark.functions.student import t_critical, t_two_sided_p
from trailmark.operators.power import compute_sample_size
from trailmark.plans.lineage import cut
from trailmark.plans.local import local_table
from trailmark.plans.quantiles import ordered_buckets, shuffle_partitions
from trailmark.plans.skew import attach_group_values

CONFIG_DDL = (
    "experiment_id string, name string, primary_metric string, expected_lift double, "
    "analysis_method string, control_label string, treatment_label string, desired_direction string"
)
DID = "difference_in_differences"
CONTROL, TREATMENT = "control", "treatment"

# The four known experiments with the arm labels their data uses.
EXPERIMENTS = {
    "exp_001": {"name": "new_onboarding_flow", "expected_lift": 0.15, "primary_metric": "activated"},
    "exp_002": {
        "name": "threat_explainer_v2",
        "expected_lift": -0.20,
        "primary_metric": "viewed_help",
        "desired_direction": "decrease",
    },
    "exp_003": {
        "name": "premium_upsell_timing",
        "expected_lift": -0.25,
        "primary_metric": "converted_to_premium",
        "control_label": "day_7_upsell",
        "treatment_label": "day_3_upsell",
    },
    "exp_004": {
        "name": "real_time_protection_default",
        "expected_lift": 0.10,
        "primary_metric": "threat_resolved",
        "analysis_method": DID,
        "control_label": "control_group",
        "treatment_label": "rollout_group",
    },
}


def experiment_config(spark: SparkSession, experiments: Mapping[str, Mapping] = EXPERIMENTS) -> DataFrame:
    """Experiment settings as a small table; labels and direction have defaults."""
    rows = []
    for experiment_id, given in experiments.items():
        defaults = {
            "analysis_method": "ab_test",
            "control_label": CONTROL,
            "treatment_label": TREATMENT,
            "desired_direction": "increase",
            "expected_lift": None,
        }
        rows.append({"experiment_id": experiment_id, **defaults, **given})
    return local_table(spark, rows, CONFIG_DDL)


def unknown_metrics(metrics: DataFrame, config: DataFrame) -> DataFrame:
    """One row, one text: the configured primary metrics that never occur, empty when all do."""
    known = metrics.select("experiment_id", F.col("metric_name").alias("primary_metric")).distinct()
    wanted = config.where(F.col("analysis_method") != DID).select("experiment_id", "primary_metric")
    missing = wanted.join(known, ["experiment_id", "primary_metric"], "left_anti")
    names = F.sort_array(F.collect_set(F.concat_ws("/", "experiment_id", "primary_metric")))
    return missing.agg(F.array_join(names, ", ").alias("missing"))


def arm_values(assignments: DataFrame, metrics: DataFrame, config: DataFrame, validate: bool = True) -> DataFrame:
    """(experiment_id, user_id, arm, value): the primary metric per assigned user, 0 without one.

    ``arm`` is 'control' or 'treatment' by the configured labels; other variants are left out.
    Several metric rows of a user are summed, so they cannot multiply the user. A metric that never
    occurs would read as all zeros; with ``validate`` the query fails instead, naming it.
    """
    c = config.select("experiment_id", "primary_metric", "control_label", "treatment_label")
    arm = F.when(F.col("variant") == F.col("control_label"), F.lit(CONTROL)).when(
        F.col("variant") == F.col("treatment_label"), F.lit(TREATMENT)
    )
    assigned = assignments.join(c, "experiment_id").select("experiment_id", "user_id", arm.alias("arm"))
    per_user = (
        metrics.join(c.select("experiment_id", F.col("primary_metric").alias("metric_name")), ["experiment_id", "metric_name"])
        .groupBy("experiment_id", "user_id")
        .agg(F.sum(F.col("metric_value").cast("double")).alias("value"))
    )
    absent = F.lit(0.0)
    if validate:
        missing = unknown_metrics(metrics, config).scalar()
        failure = F.raise_error(F.concat(F.lit("Unknown metric: "), missing)).cast("double")
        absent = F.when(missing == "", absent).otherwise(failure)
    return (
        assigned.where(F.col("arm").isNotNull())
        .join(per_user, ["experiment_id", "user_id"], "left")
        .select("experiment_id", "user_id", "arm", F.coalesce("value", absent).alias("value"))
    )


def arm_totals(values: DataFrame, keys: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """One row per experiment: size, sum, mean and variance of each arm (NULL for an empty arm)."""
    per_arm = values.groupBy(*keys, "arm").agg(
        F.count("*").alias("n"),
        F.sum("value").alias("total"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("var"),
    )
    cells = []
    for arm, s in ((CONTROL, "c"), (TREATMENT, "t")):
        pick = F.col("arm") == arm
        cells.append(F.coalesce(F.max(F.when(pick, F.col("n"))), F.lit(0)).alias(f"n_{s}"))
        for name in ("total", "mean", "var"):
            cells.append(F.max(F.when(pick, F.col(name))).alias(f"{name}_{s}"))
    return per_arm.groupBy(*keys).agg(*cells)


def value_counts(values: DataFrame, keys: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """(keys, value, c, t): how many users of each arm have a value. Written once, for what reads it several times."""
    return cut(
        values.groupBy(*keys, "value").agg(
            F.count_if(F.col("arm") == CONTROL).alias("c"), F.count_if(F.col("arm") == TREATMENT).alias("t")
        )
    )


def totals_of_counts(counts: DataFrame, keys: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """``arm_totals`` of the values behind ``value_counts``; squares are taken about the arm's mean."""
    sides = ("c", "t")
    v = F.col("value")
    means = counts.where(v.isNotNull()).groupBy(*keys).agg(
        *[F.sum(s).alias(f"k_{s}") for s in sides], *[F.sum(F.when(F.col(s) > 0, F.col(s) * v)).alias(f"total_{s}") for s in sides]
    )
    means = means.select("*", *[F.try_divide(f"total_{s}", f"k_{s}").alias(f"mean_{s}") for s in sides])
    placed = attach_group_values(counts.where(v.isNotNull()), means, keys, ["value"])
    squares = placed.groupBy(*keys).agg(*[F.sum(F.col(s) * (v - F.col(f"mean_{s}")) * (v - F.col(f"mean_{s}"))).alias(f"ss_{s}") for s in sides])
    sizes = counts.groupBy(*keys).agg(*[F.sum(s).alias(f"n_{s}") for s in sides])
    on = lambda a, b: reduce(and_, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    joined = sizes.alias("n").join(means.alias("m"), on("n", "m"), "left").join(squares.alias("q"), on("n", "q"), "left")
    var = {s: F.when(F.col(f"k_{s}") > 1, F.col(f"ss_{s}") / (F.col(f"k_{s}") - 1)) for s in sides}
    cells = [c for s in sides for c in (F.col(f"n_{s}"), F.col(f"total_{s}"), F.col(f"mean_{s}"), var[s].alias(f"var_{s}"))]
    return joined.select(*[F.col(f"n.{k}").alias(k) for k in keys], *cells)


SRM_COLUMNS = (
    "n_control", "n_treatment", "observed_ratio", "expected_ratio", "chi2_statistic", "srm_p_value", "srm_detected"
)


def check_srm(
    counts: DataFrame,
    n_control: str = "n_control",
    n_treatment: str = "n_treatment",
    expected_ratio: float = 0.5,
    alpha: float = 0.001,
) -> DataFrame:
    """Chi-square goodness of fit of the arm sizes to the planned split; NULL when an arm is empty."""
    n = F.col(n_control) + F.col(n_treatment)
    e_c, e_t = n * F.lit(expected_ratio), n * F.lit(1 - expected_ratio)
    chi2 = F.try_divide((F.col(n_control) - e_c) * (F.col(n_control) - e_c), e_c) + F.try_divide(
        (F.col(n_treatment) - e_t) * (F.col(n_treatment) - e_t), e_t
    )
    has_both = (F.col(n_control) > 0) & (F.col(n_treatment) > 0)
    out = counts.withColumn("__chi2", F.when(has_both, chi2)).withColumn("__p", chi2_1df_p("__chi2"))
    return out.select(
        *counts.columns,
        F.round(ratio(n_control, n), 4).alias("observed_ratio"),
        F.lit(expected_ratio).alias("expected_ratio"),
        F.round("__chi2", 4).alias("chi2_statistic"),
        F.col("__p").alias("srm_p_value"),
        (F.col("__p") < alpha).alias("srm_detected"),
    )


def variant_srm(assignments: DataFrame, config: DataFrame, expected_ratio: float = 0.5, alpha: float = 0.001) -> DataFrame:
    """Sample ratio check of every experiment."""
    labels = config.select("experiment_id", "control_label", "treatment_label")
    counts = (
        assignments.groupBy("experiment_id", "variant")
        .agg(F.count("*").alias("n"))
        .join(labels, "experiment_id")
        .groupBy("experiment_id")
        .agg(
            F.coalesce(F.sum(F.when(F.col("variant") == F.col("control_label"), F.col("n"))), F.lit(0)).alias("n_control"),
            F.coalesce(F.sum(F.when(F.col("variant") == F.col("treatment_label"), F.col("n"))), F.lit(0)).alias("n_treatment"),
        )
    )
    return check_srm(counts, expected_ratio=expected_ratio, alpha=alpha)


def proportion_test(
    totals: DataFrame, alpha: float = 0.05, test_type: str = "z_test", keys: Sequence[str] = ("experiment_id",)
) -> DataFrame:
    """Two-proportion test on arm totals: pooled z, or Pearson chi-square without correction.

    The interval is always the unpooled Wald interval. Equal arms with no spread give statistic 0.
    A control rate of 0 gives an infinite relative lift.
    """
    if test_type not in ("z_test", "chi_square"):
        raise ValueError(f"Unknown test_type: {test_type}")
    n_c, n_t = F.col("n_c").cast("double"), F.col("n_t").cast("double")
    base = totals.withColumn("p_c", F.try_divide(F.col("total_c"), n_c)).withColumn(
        "p_t", F.try_divide(F.col("total_t"), n_t)
    )
    p_c, p_t, lift = F.col("p_c"), F.col("p_t"), F.col("p_t") - F.col("p_c")
    pooled = F.try_divide(F.col("total_c") + F.col("total_t"), n_c + n_t)
    se = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_c) + F.try_divide(F.lit(1.0), n_t)))
    base = base.withColumn("lift", lift).withColumn("z", F.when(se > 0, lift / se).when(se == 0, F.lit(0.0)))
    if test_type == "z_test":
        base = base.withColumn("stat", F.col("z")).withColumn("p_value", two_sided_p("z"))
    else:
        # For a 2x2 table Pearson's statistic is the square of the pooled z.
        base = base.withColumn("stat", F.col("z") * F.col("z")).withColumn("p_value", chi2_1df_p("stat"))
    half = F.lit(z_quantile(1 - alpha / 2)) * F.sqrt(p_c * (1 - p_c) / n_c + p_t * (1 - p_t) / n_t)
    relative = F.when(p_c > 0, F.col("lift") / p_c).when(p_c == 0, F.lit(float("inf")))
    return base.select(
        *keys,
        F.col("n_c").alias("n_control"),
        F.col("n_t").alias("n_treatment"),
        F.round("p_c", 6).alias("control_rate"),
        F.round("p_t", 6).alias("treatment_rate"),
        F.round("lift", 6).alias("absolute_lift"),
        F.round(relative, 4).alias("relative_lift"),
        F.round("stat", 4).alias("statistic"),
        "p_value",
        (F.col("p_value") < alpha).alias("significant"),
        F.round(F.col("lift") - half, 6).alias("ci_lower"),
        F.round(F.col("lift") + half, 6).alias("ci_upper"),
        F.lit(alpha).alias("alpha"),
        F.lit(test_type).alias("test_type"),
    )


def _mean_columns(keys: Sequence[str]) -> list[Column]:
    lift = F.col("mean_t") - F.col("mean_c")
    pooled = F.sqrt(
        F.try_divide((F.col("n_c") - 1) * F.col("var_c") + (F.col("n_t") - 1) * F.col("var_t"), F.col("n_c") + F.col("n_t") - 2)
    )
    relative = F.when(F.col("mean_c") != 0, lift / F.col("mean_c")).when(F.col("mean_c") == 0, F.lit(float("inf")))
    return [
        *[F.col(k) for k in keys],
        F.round("mean_c", 6).alias("control_mean"),
        F.round("mean_t", 6).alias("treatment_mean"),
        F.col("n_c").alias("n_control"),
        F.col("n_t").alias("n_treatment"),
        F.round(lift, 6).alias("absolute_lift"),
        F.round(relative, 4).alias("relative_lift"),
        F.round(F.when(pooled > 0, lift / pooled).when(pooled == 0, F.lit(0.0)), 4).alias("cohens_d"),
    ]


def means_test(
    values: DataFrame, alpha: float = 0.05, test_type: str = "welch", keys: Sequence[str] = ("experiment_id",)
) -> DataFrame:
    """Difference of means between arms: Welch, Student or rank-sum (two-sided).

    The interval always uses Welch's error and degrees of freedom; the rank-sum test has none.
    ``df`` is the degrees of freedom of the reported t statistic. An experiment whose arms are too small
    for the test (none in an arm; for t, fewer than two) keeps its row, with NULL statistics.
    """
    if test_type == "mann_whitney":
        counts = value_counts(values, keys)
        totals, ranks = totals_of_counts(counts, keys), rank_sum_of_counts(counts, keys)
        on = [F.col(f"m.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
        joined = totals.alias("m").join(ranks.alias("u"), on, "left")
        return joined.select(
            *[c for c in _mean_columns([f"m.{k}" for k in keys])],
            F.round("u_statistic", 4).alias("statistic"),
            F.lit(None).cast("double").alias("df"),
            "p_value",
            (F.col("p_value") < alpha).alias("significant"),
            F.lit(None).cast("double").alias("ci_lower"),
            F.lit(None).cast("double").alias("ci_upper"),
            F.lit(alpha).alias("alpha"),
            F.lit(test_type).alias("test_type"),
        )
    if test_type not in ("welch", "student"):
        raise ValueError(f"Unknown test_type: {test_type}")
    totals = arm_totals(values, keys)
    n_c, n_t = F.col("n_c").cast("double"), F.col("n_t").cast("double")
    enough = (F.col("n_c") > 1) & (F.col("n_t") > 1)
    a, b = F.try_divide(F.col("var_c"), n_c), F.try_divide(F.col("var_t"), n_t)
    spread = F.try_divide(a * a, n_c - 1) + F.try_divide(b * b, n_t - 1)
    welch_df = F.coalesce(F.try_divide((a + b) * (a + b), spread), n_c + n_t - 2)
    base = totals.withColumn("welch_se", F.sqrt(a + b)).withColumn("welch_df", F.when(enough, welch_df))
    if test_type == "welch":
        base = base.withColumn("se", F.col("welch_se")).withColumn("df", F.col("welch_df"))
    else:
        shared = F.try_divide((n_c - 1) * F.col("var_c") + (n_t - 1) * F.col("var_t"), n_c + n_t - 2)
        sizes = F.try_divide(F.lit(1.0), n_c) + F.try_divide(F.lit(1.0), n_t)
        base = base.withColumn("se", F.sqrt(shared * sizes)).withColumn("df", F.when(enough, n_c + n_t - 2))
    base = base.withColumn("t", F.try_divide(F.col("mean_t") - F.col("mean_c"), F.col("se")))
    base = base.withColumn("p_value", t_two_sided_p("t", "df")).withColumn(
        "half", t_critical(F.lit(alpha), "welch_df") * F.col("welch_se")
    )
    lift = F.col("mean_t") - F.col("mean_c")
    return base.select(
        *_mean_columns(keys),
        F.round("t", 4).alias("statistic"),
        "df",
        "p_value",
        (F.col("p_value") < alpha).alias("significant"),
        F.round(lift - F.col("half"), 6).alias("ci_lower"),
        F.round(lift + F.col("half"), 6).alias("ci_upper"),
        F.lit(alpha).alias("alpha"),
        F.lit(test_type).alias("test_type"),
    )


def rank_sum(
    values: DataFrame, keys: Sequence[str] = ("experiment_id",), buckets: int | None = None, method: str = "auto"
) -> DataFrame:
    """Mann-Whitney U of the treatment arm, its two-sided p-value and the method that gave it.

    The p-value is normal with tie and continuity correction, or exact. By 'auto' it is exact when an
    arm has at most SMALL users and no values tie; 'exact' asks for it whenever no values tie.
    ``buckets`` defaults to the session's shuffle partitions and does not change the result.

    Values are collapsed to a histogram and cut in ordered buckets. A treatment value beats the control
    values of all lower buckets and the lower ones of its own, so windows stay inside a bucket.
    """
    return rank_sum_of_counts(value_counts(values, keys), keys, buckets, method)


def rank_sum_of_counts(
    counts: DataFrame, keys: Sequence[str] = ("experiment_id",), buckets: int | None = None, method: str = "auto"
) -> DataFrame:
    """``rank_sum`` of the values behind ``value_counts``."""
    if method not in ("auto", "exact", "normal"):
        raise ValueError(f"Unknown method: {method}")
    hist = ordered_buckets(counts, keys, "value", buckets or shuffle_partitions(counts))
    inside = W.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    c, t = F.col("c").cast("double"), F.col("t").cast("double")
    within = hist.withColumn("c_below", F.coalesce(F.sum("c").over(inside), F.lit(0)).cast("double"))
    size = c + t
    per_bucket = within.groupBy(*keys, "bucket").agg(
        F.sum(t * (F.col("c_below") + c / 2)).alias("u_in"),
        F.sum(size * size * size - size).alias("ties"),
        F.sum("c").alias("c"),
        F.sum("t").alias("t"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    in_order = W.partitionBy(*keys).orderBy("bucket")
    earlier = in_order.rowsBetween(W.unboundedPreceding, -1)
    # A retried task may see other cuts; buckets that overlap would be an error, so they are one.
    overlap = F.lag("high").over(in_order) >= F.col("low")
    u_row = F.col("u_in") + t * F.coalesce(F.sum("c").over(earlier), F.lit(0)).cast("double")
    rows = per_bucket.withColumn("u_row", u_row).withColumn("overlap", F.coalesce(overlap, F.lit(False)))
    sums = rows.groupBy(*keys).agg(
        F.sum("u_row").alias("u"),
        F.sum("ties").alias("ties"),
        F.sum("c").cast("double").alias("n_c"),
        F.sum("t").cast("double").alias("n_t"),
        F.bool_or("overlap").alias("overlap"),
    )
    n = F.col("n_c") + F.col("n_t")
    u_max = F.greatest(F.col("u"), F.col("n_c") * F.col("n_t") - F.col("u"))
    var = F.col("n_c") * F.col("n_t") / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1)))
    z = F.try_divide(u_max - F.col("n_c") * F.col("n_t") / 2 - 0.5, F.sqrt(var))
    checked = F.when(F.col("overlap"), F.raise_error(F.lit("bucket cuts changed mid-query")).cast("double"))
    out = sums.where((F.col("n_c") > 0) & (F.col("n_t") > 0)).withColumn("z", F.greatest(z, F.lit(0.0)))
    wanted = {"auto": F.least("n_c", "n_t") <= SMALL, "exact": F.lit(True), "normal": F.lit(False)}[method]
    exactly = wanted & (F.col("ties") == 0)
    exact = exact_u_p(F.when(exactly, F.col("u")), F.col("n_c"), F.col("n_t"))
    return out.select(
        *keys,
        checked.otherwise(F.col("u")).alias("u_statistic"),
        "z",
        F.coalesce(exact, F.least(two_sided_p("z"), F.lit(1.0))).alias("p_value"),
        F.when(exactly, F.lit("exact")).otherwise(F.lit("normal")).alias("method"),
    )


def correct_multiple_tests(
    tests: DataFrame,
    p_value: str = "p_value",
    family: Sequence[str] = (),
    alpha: float = 0.05,
    method: str = "both",
) -> DataFrame:
    """Bonferroni and Benjamini-Hochberg columns next to each test's raw p-value.

    The adjusted BH value is p * m / rank with ties at their lowest rank, capped at 1 and not made
    monotone; the BH decision is the step-up rule. Windows run over one row per test. Rows come sorted
    by family and p-value.
    """
    if method not in ("bonferroni", "bh", "both"):
        raise ValueError(f"Unknown method: {method}")
    keys = list(family) or [F.lit(1)]
    whole = W.partitionBy(*keys)
    p = F.col(p_value)
    out = tests.withColumn("__m", F.count(p).over(whole).cast("double")).withColumnRenamed(p_value, "p_value_raw")
    p = F.col("p_value_raw")
    out = out.withColumn("significant_raw", p < alpha)
    if method in ("bonferroni", "both"):
        out = out.withColumn("p_value_bonferroni", F.least(p * F.col("__m"), F.lit(1.0)))
        out = out.withColumn("significant_bonferroni", F.col("p_value_bonferroni") < alpha)
    if method in ("bh", "both"):
        order = whole.orderBy(p.asc_nulls_last())
        out = out.withColumn("__rank", F.rank().over(order)).withColumn("__rn", F.row_number().over(order))
        passed = F.when(p <= F.col("__rn") / F.col("__m") * F.lit(alpha), p)
        out = out.withColumn("p_value_bh", F.least(p * F.col("__m") / F.col("__rank"), F.lit(1.0)))
        out = out.withColumn("significant_bh", F.coalesce(p <= F.max(passed).over(whole), F.lit(False)))
        out = out.drop("__rank", "__rn")
    return out.drop("__m").orderBy(*family, p.asc_nulls_last())


def decide(srm: Column, significant: Column, lift: Column, direction: Column | None = None) -> Column:
    """Ship decision; with a direction, a significant move the desired way ships."""
    good = lift > 0
    bad = lift < 0
    if direction is not None:
        lower = direction == "decrease"
        good, bad = F.when(lower, lift < 0).otherwise(lift > 0), F.when(lower, lift > 0).otherwise(lift < 0)
    return (
        F.when(srm.isNull() | significant.isNull(), F.lit("NO DATA"))
        .when(srm, F.lit("INVALID"))
        .when(significant & good, F.lit("SHIP"))
        .when(significant & bad, F.lit("DO NOT SHIP"))
        .otherwise(F.lit("INCONCLUSIVE"))
    )


def _nest(df: DataFrame, keep: Sequence[str], name: str, only: Sequence[str] | None = None) -> DataFrame:
    """Fold the columns not kept (or ``only`` some of them) into one struct."""
    return df.select(*keep, F.struct(*(only or [c for c in df.columns if c not in keep])).alias(name))


def analyze_experiments(
    assignments: DataFrame,
    metrics: DataFrame,
    config: DataFrame,
    metric_type: str = "proportion",
    alpha: float = 0.05,
    bootstrap: DataFrame | None = None,
    validate: bool = True,
) -> DataFrame:
    """One row per experiment: nested srm_check, primary_test, chi_square_test, bootstrap, decisions.

    ``decision`` reads any significant rise as good; ``business_decision`` follows the desired direction.
    ``bootstrap`` is the result of ``bootstrap_ci`` over the same arm values, if wanted. An experiment
    without users, or without users in an arm, reads NO DATA.
    """
    if metric_type not in ("proportion", "continuous"):
        raise ValueError(f"Unknown metric_type: {metric_type}")
    values = arm_values(assignments, metrics, config, validate)
    # Every test is arithmetic on the experiment's one row of totals, so results are added side by side.
    if metric_type == "proportion":
        rows = arm_totals(values)
        rows = _nest(proportion_test(rows, alpha, keys=rows.columns), rows.columns, "primary_test")
        rows = _nest(proportion_test(rows, alpha, "chi_square", rows.columns), rows.columns, "chi_square_test")
        rows = rows.withColumnsRenamed({"n_c": "n_control", "n_t": "n_treatment"})
    else:
        rows = _nest(means_test(values, alpha), ["experiment_id"], "primary_test")
        rows = rows.select("*", "primary_test.n_control", "primary_test.n_treatment")
    tests = [c for c in rows.columns if c.endswith("_test")]
    rows = _nest(check_srm(rows), ["experiment_id", *tests], "srm_check", only=SRM_COLUMNS)
    out = config.select("experiment_id", "primary_metric", "desired_direction").join(rows, "experiment_id", "left")
    if bootstrap is not None:
        out = out.join(_nest(bootstrap, ["experiment_id"], "bootstrap"), "experiment_id", "left")
    args = (F.col("srm_check.srm_detected"), F.col("primary_test.significant"), F.col("primary_test.relative_lift"))
    return out.select(
        "*",
        F.lit(metric_type).alias("metric_type"),
        decide(*args).alias("decision"),
        decide(*args, F.col("desired_direction")).alias("business_decision"),
    )


def summarize_all_experiments(
    assignments: DataFrame, metrics: DataFrame, config: DataFrame, alpha: float = 0.05, validate: bool = True
) -> DataFrame:
    """Decision table over all experiments; those needing difference-in-differences read SKIP."""
    tested = config.where(F.col("analysis_method") != DID)
    totals = arm_totals(arm_values(assignments, metrics, tested, validate))
    test = check_srm(proportion_test(totals, alpha))
    skipped = F.col("analysis_method") == DID
    decision = decide(F.col("srm_detected"), F.col("significant"), F.col("relative_lift"))
    business = decide(F.col("srm_detected"), F.col("significant"), F.col("relative_lift"), F.col("desired_direction"))
    return (
        config.join(test, "experiment_id", "left").select(
            "experiment_id",
            "name",
            "primary_metric",
            "expected_lift",
            F.when(skipped, F.lit("SKIP")).otherwise(decision).alias("decision"),
            F.when(skipped, F.lit("SKIP")).otherwise(business).alias("business_decision"),
            "p_value",
            F.col("relative_lift").alias("observed_lift"),
            "ci_lower",
            "ci_upper",
            "significant",
            (~F.col("srm_detected")).alias("srm_clean"),
        )
    )


def method_agreement(analysis: DataFrame) -> DataFrame:
    """z, chi-square and bootstrap verdicts side by side."""
    z, chi, boot = (F.col(f"{n}.significant") for n in ("primary_test", "chi_square_test", "bootstrap"))
    return analysis.select(
        "experiment_id",
        F.col("primary_test.p_value").alias("z_test_p"),
        z.alias("z_test_sig"),
        F.col("chi_square_test.p_value").alias("chi_sq_p"),
        chi.alias("chi_sq_sig"),
        F.col("bootstrap.p_value_bootstrap").alias("bootstrap_p"),
        boot.alias("bootstrap_sig"),
        ((z == chi) & (chi == boot)).alias("all_agree"),
    )


def power_audit(
    assignments: DataFrame, metrics: DataFrame, config: DataFrame, alpha: float = 0.05, power: float = 0.80
) -> DataFrame:
    """Required against actual control size per experiment, from its own control rate."""
    tested = config.where(F.col("analysis_method") != DID)
    totals = arm_totals(arm_values(assignments, metrics, tested))
    plans = totals.join(tested.select("experiment_id", "name", "expected_lift"), "experiment_id").select(
        "experiment_id", "name", F.col("mean_c").alias("baseline_rate"), F.abs("expected_lift").alias("mde"), F.col("n_c").alias("actual_n")
    )
    sized = compute_sample_size(plans, alpha=alpha, power=power)
    return sized.select(
        "experiment_id",
        "name",
        F.round("baseline_rate", 6).alias("baseline_rate"),
        "mde",
        F.col("n_control").alias("required_n"),
        "actual_n",
        (F.col("actual_n") >= F.col("n_control")).alias("powered"),
    )


def assignment_balance(assignments: DataFrame) -> DataFrame:
    """Users per experiment and variant, and the variant's share of the experiment (percent)."""
    counts = assignments.groupBy("experiment_id", "variant").agg(F.count("*").alias("users"))
    whole = W.partitionBy("experiment_id")
    return counts.withColumn("pct", percent("users", F.sum("users").over(whole), 4))


def metric_names(metrics: DataFrame) -> DataFrame:
    """Distinct metric names per experiment, one row each."""
    return metrics.groupBy("experiment_id", "metric_name").agg(F.count("*").alias("rows"))


def metric_rates(assignments: DataFrame, metrics: DataFrame) -> DataFrame:
    """Mean value per experiment, metric and variant, over users with the metric."""
    joined = metrics.join(assignments.select("experiment_id", "user_id", "variant"), ["experiment_id", "user_id"])
    return joined.groupBy("experiment_id", "metric_name", "variant").agg(
        F.round(F.avg(F.col("metric_value").cast("double")), 6).alias("rate")
    )


def geo_confounding(
    assignments: DataFrame,
    users: DataFrame,
    experiment_id: str,
    treatment_label: str = TREATMENT,
    low: float = 0.4,
    high: float = 0.6,
) -> DataFrame:
    """Treated share by country, flagged where it is far from an even split."""
    counts = (
        assignments.where(F.col("experiment_id") == experiment_id)
        .join(users.select("user_id", "country"), "user_id", "left")
        .groupBy("country")
        .agg(F.count("*").alias("users"), F.sum(flag(F.col("variant") == treatment_label)).alias("treated"))
    )
    share = ratio("treated", "users")
    return counts.select(
        "country", "users", F.round(share, 6).alias("treatment_rate"), ((share > high) | (share < low)).alias("confounded")
    )


def assign_variants(
    users: DataFrame,
    experiment_id: str,
    variants: Sequence[str],
    allocation: Sequence[float],
    start_date: str,
    end_date: str,
    eligible: Column | None = None,
    rule: Column | None = None,
) -> DataFrame:
    """Variant per user signed up inside the experiment dates, by a fixed hash of experiment and user.

    ``eligible`` narrows the audience; ``rule`` replaces the hash, as for a rollout by country.
    """
    audience = users.where(F.to_date("signup_date").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date")))
    if eligible is not None:
        audience = audience.where(eligible)
    digest = F.md5(F.concat_ws("|", F.lit(experiment_id), F.col("user_id").cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    chosen, upto = F.lit(variants[-1]), 1.0
    for variant, share in list(zip(variants, allocation))[-2::-1]:
        upto = sum(allocation[: list(variants).index(variant) + 1])
        chosen = F.when(draw < F.lit(float(upto)), F.lit(variant)).otherwise(chosen)
    return audience.select(
        F.lit(experiment_id).alias("experiment_id"),
        "user_id",
        (rule if rule is not None else chosen).alias("variant"),
        F.to_date("signup_date").alias("assigned_at"),
    )


# The known audiences of the experiments table, as SQL tests on the users (None: everyone).
AUDIENCES = {"all_new_users": None, "all_users": None, "free_users": "plan_type = 'free'", "geo_based": None}


def assign_from_table(
    users: DataFrame,
    experiments: DataFrame,
    audiences: Mapping[str, str | None] = AUDIENCES,
    geo: str = "geo_based",
    rollout_countries: Sequence[str] = (),
) -> DataFrame:
    """(experiment_id, user_id, variant, assigned_at) for every experiment of a table, in one plan.

    ``experiments`` is typed as the catalog loads it: dates, ``variants`` and ``allocation`` as arrays, ``targeting``
    one of ``audiences``. A user who signed up between an experiment's dates, both included, draws a variant from a
    fixed hash of experiment and user: the first whose running total of shares is above the draw. An experiment
    targeted ``geo`` gives its first variant to users of ``rollout_countries`` and its second to the others. Dates
    meet by the day, so no join compares ranges. An unknown audience, another number of shares than of variants, or
    shares that do not sum to 1 fail the query.
    """
    total = F.aggregate("allocation", F.lit(0.0), lambda a, x: a + x)
    sound = (F.size("variants") == F.size("allocation")) & (F.abs(total - 1) < 1e-9) & F.forall("allocation", lambda x: x >= 0)
    sound = F.coalesce(sound & F.col("targeting").isin(sorted(audiences)), F.lit(False))
    failure = F.raise_error(F.concat(F.lit("Unusable experiment: "), F.coalesce("experiment_id", F.lit("NULL")))).cast("string")
    upto = F.transform("allocation", lambda _, i: F.aggregate(F.slice("allocation", F.lit(1), i + 1), F.lit(0.0), lambda a, x: a + x))
    days = F.explode(F.sequence(F.to_date("start_date"), F.to_date("end_date")))
    dated = experiments.where("start_date <= end_date").select(
        F.when(sound, F.col("experiment_id")).otherwise(failure).alias("experiment_id"),
        "variants", upto.alias("upto"), "targeting", days.alias("assigned_at"),
    )
    groups = [F.when(F.expr(test), F.lit(name)) if test else F.lit(name) for name, test in audiences.items()]
    audience = users.select(
        "user_id", F.to_date("signup_date").alias("assigned_at"), "country", F.array_compact(F.array(*groups)).alias("groups")
    )
    met = audience.join(dated, "assigned_at").where(F.expr("array_contains(groups, targeting)"))
    digest = F.md5(F.concat_ws("|", "experiment_id", F.col("user_id").cast("string")))
    met = met.withColumn("draw", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0))
    passed = F.size(F.filter("upto", lambda c: c <= F.col("draw")))
    by_draw = F.get("variants", F.least(passed, F.size("variants") - 1))
    by_country = F.get("variants", F.when(F.col("country").isin(list(rollout_countries)), 0).otherwise(1))
    variant = F.when(F.col("targeting") == geo, by_country).otherwise(by_draw)
    return met.select("experiment_id", "user_id", variant.alias("variant"), "assigned_at")
