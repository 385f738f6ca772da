"""Difference-in-differences on a user-week panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.dates import boundaries_between, period_start
from trailmark.functions.normal import two_sided_p, z_quantile
from trailmark.functions.numeric import flag, ratio
from trailmark.functions.student import t_two_sided_p
from trailmark.plans.lineage import cut
from trailmark.plans.local import side_by_side

# The panel's outcome columns and the events they count.
PANEL_COUNTS = {"threats_resolved": "threat_resolved", "scans_completed": "scan_completed"}


def rollout_users(
    assignments: DataFrame, users: DataFrame, experiment_id: str, treatment_label: str, attributes: Sequence[str] = ("country",)
) -> DataFrame:
    """Users of a rollout with a 0/1 ``treated`` and their attributes."""
    return (
        assignments.where(F.col("experiment_id") == experiment_id)
        .select("user_id", flag(F.col("variant") == treatment_label).alias("treated"), "assigned_at")
        .join(users.select("user_id", *attributes), "user_id", "left")
    )


def rollout_groups(rollout: DataFrame, by: str = "country", majority: float = 0.5) -> DataFrame:
    """Per country: share treated, whether it is a treatment country, first assignment date overall."""
    counts = rollout.groupBy(by).agg(
        F.count("*").alias("users"), F.sum("treated").alias("treated"), F.min("assigned_at").alias("first")
    )
    start = counts.agg(F.min("first")).scalar()
    share = ratio("treated", "users")
    return counts.select(
        by,
        "users",
        F.round(share, 6).alias("treatment_rate"),
        (share > majority).alias("is_treatment"),
        start.alias("treatment_start"),
    )


def user_week_panel(
    events: DataFrame, rollout: DataFrame, counts: Mapping[str, str] = PANEL_COUNTS, keep: Sequence[str] = ("treated", "country")
) -> DataFrame:
    """Event counts per rollout user and week; weeks without any event are absent."""
    weekly = (
        events.groupBy("user_id", period_start("timestamp", "week").alias("week"))
        .agg(
            *[F.count_if(F.col("event_type") == event).alias(name) for name, event in counts.items()],
            F.count("*").alias("total_events"),
        )
    )
    return weekly.join(rollout.select("user_id", *keep), "user_id")


def densify_panel(panel: DataFrame, outcomes: Sequence[str], keep: Sequence[str] = ("treated", "country")) -> DataFrame:
    """Add the weeks without events, with 0, between the panel's first and last week."""
    first, last = panel.agg(F.min("week")).scalar(), panel.agg(F.max("week")).scalar()
    weeks = F.explode(F.sequence("lo", "hi", F.expr("interval 7 days")))
    grid = panel.groupBy("user_id").agg(*[F.first(k).alias(k) for k in keep])
    grid = grid.select("user_id", *keep, first.alias("lo"), last.alias("hi")).select("user_id", *keep, weeks.alias("week"))
    counted = panel.select("user_id", "week", *outcomes)
    return grid.join(counted, ["user_id", "week"], "left").fillna(0, subset=list(outcomes))


def panel_summary(panel: DataFrame) -> DataFrame:
    """Rows, users, weeks and week range of a panel."""
    per_user = panel.groupBy("user_id").agg(F.count("*").alias("n"))
    per_week = panel.groupBy("week").agg(F.count("*").alias("n"))
    a = per_user.agg(F.sum("n").alias("panel_rows"), F.count("*").alias("users"))
    b = per_week.agg(F.count("*").alias("weeks"), F.min("week").alias("first_week"), F.max("week").alias("last_week"))
    return side_by_side(a, b)


def _post(time_col: str, treatment_time: str) -> Column:
    return flag(F.to_date(time_col) >= F.lit(treatment_time).cast("date"))


def _inference(df: DataFrame, estimate: str, alpha: float) -> list[Column]:
    half = F.lit(z_quantile(1 - alpha / 2)) * F.col("std_error")
    return [F.col(estimate) - half, F.col(estimate) + half]


def estimate_did(
    panel: DataFrame,
    outcome: str,
    treatment_time: str,
    treated: str = "treated",
    time_col: str = "week",
    cluster: str | None = None,
    alpha: float = 0.05,
) -> DataFrame:
    """(T1 - T0) - (C1 - C0) from the four cell means, one row, normal inference.

    The error is HC1, or clustered. A row moves its cell mean by (y - mean) / n, so both need only
    counts, sums and spreads per (cluster, cell): one pass over the panel.
    """
    y = F.col(outcome).cast("double")
    group = F.col(cluster) if cluster else F.lit("all")
    parts = panel.groupBy(group.alias("g"), F.col(treated).cast("int").alias("t"), _post(time_col, treatment_time).alias("p")).agg(
        F.count("*").alias("n"), F.sum(y).alias("s"), (F.var_pop(y) * F.count(y)).alias("q")  # squares about the mean
    )
    cells = parts.groupBy("t", "p").agg(F.sum("n").alias("cell_n"), F.sum("s").alias("cell_s"))  # at most 4 rows
    joined = parts.join(F.broadcast(cells), ["t", "p"]).withColumn("mean", F.col("cell_s") / F.col("cell_n"))
    sign = F.when(F.col("t") == F.col("p"), 1.0).otherwise(-1.0)
    joined = joined.withColumn("moved", sign * (F.col("s") - F.col("n") * F.col("mean")) / F.col("cell_n")).withColumn(
        "moved2", (F.col("q") + F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("mean"), 2)) / (F.col("cell_n") * F.col("cell_n"))
    )
    per_cluster = joined.groupBy("g").agg(
        F.sum("moved").alias("moved"),
        F.sum("moved2").alias("moved2"),
        *[
            F.max(F.when((F.col("t") == t) & (F.col("p") == p), F.col("mean"))).alias(f"m{t}{p}")
            for t in (0, 1)
            for p in (0, 1)
        ],
        *[F.sum(F.when(F.col("t") == t, F.col("n"))).alias(f"n{t}") for t in (0, 1)],
    )
    whole = per_cluster.agg(
        F.count("*").alias("clusters"),
        F.sum(F.col("moved") * F.col("moved")).alias("cluster_ss"),
        F.sum("moved2").alias("row_ss"),
        *[F.max(f"m{t}{p}").alias(f"m{t}{p}") for t in (0, 1) for p in (0, 1)],
        *[F.coalesce(F.sum(f"n{t}"), F.lit(0)).alias(f"n{t}") for t in (0, 1)],
    )
    n = (F.col("n0") + F.col("n1")).cast("double")
    g = F.col("clusters").cast("double")
    if cluster:
        variance = F.try_divide(g, g - 1) * F.try_divide(n - 1, n - 4) * F.col("cluster_ss")
    else:
        variance = F.try_divide(n, n - 4) * F.col("row_ss")
    out = whole.withColumn("did_estimate", (F.col("m11") - F.col("m10")) - (F.col("m01") - F.col("m00")))
    out = out.withColumn("std_error", F.sqrt(variance))
    out = out.withColumn("t_stat", F.try_divide("did_estimate", "std_error"))
    low, high = _inference(out, "did_estimate", alpha)
    return out.select(
        F.lit(outcome).alias("outcome"),
        "did_estimate",
        "std_error",
        "t_stat",
        two_sided_p("t_stat").alias("p_value"),
        low.alias("ci_lower"),
        high.alias("ci_upper"),
        (F.col("m10") - F.col("m00")).alias("pre_difference"),
        (F.col("m11") - F.col("m01")).alias("post_difference"),
        F.col("n1").alias("n_treatment"),
        F.col("n0").alias("n_control"),
        (F.col("clusters") if cluster else F.lit(None).cast("bigint")).alias("n_clusters"),
    )


def did_with_trends(panel: DataFrame, outcome: str, treatment_time: str, **how) -> DataFrame:
    """``estimate_did`` with ``parallel_trends_pvalue``, the pre-period test, beside it; one row."""
    trends = parallel_trends_test(panel, outcome, treatment_time)
    pvalue = trends.select(F.col("interaction_pvalue").alias("parallel_trends_pvalue"))
    return side_by_side(estimate_did(panel, outcome, treatment_time, **how), pvalue)


def parallel_trends_series(
    panel: DataFrame, outcome: str, treatment_time: str, treated: str = "treated", time_col: str = "week"
) -> DataFrame:
    """Mean outcome per week and arm, with the period the week falls in."""
    return panel.groupBy(F.col(time_col), F.col(treated).cast("int").alias("treated")).agg(
        F.round(F.avg(F.col(outcome).cast("double")), 6).alias("mean_outcome"),
        F.count("*").alias("n"),
        F.max(_post(time_col, treatment_time)).alias("post"),
    )


def parallel_trends_test(
    panel: DataFrame, outcome: str, treatment_time: str, treated: str = "treated", time_col: str = "week"
) -> DataFrame:
    """Do the arms drift apart before treatment: the interaction of y ~ week * treated on pre-period rows.

    The joint regression splits into one line per arm, so slopes, residuals and the interaction's error
    follow from arm moments. Also the correlation of the arms' weekly means. One row.
    """
    week = boundaries_between("week", F.lit(treatment_time), F.col(time_col)).cast("double")
    pre = panel.where(_post(time_col, treatment_time) == 0).select(
        F.col(treated).cast("int").alias("arm"), week.alias("x"), F.col(outcome).cast("double").alias("y")
    )
    moments = pre.groupBy("arm").agg(
        F.count("*").alias("n"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.regr_sxy("y", "x").alias("sxy"),
        F.regr_syy("y", "x").alias("syy"),
    )
    slope = F.try_divide("sxy", "sxx")
    wide = moments.agg(
        *[F.max(F.when(F.col("arm") == a, slope)).alias(f"slope{a}") for a in (0, 1)],
        F.sum("n").cast("double").alias("n"),
        F.sum(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))).alias("rss"),
        F.sum(F.try_divide(F.lit(1.0), F.col("sxx"))).alias("inv"),
    )
    weekly = pre.groupBy("x").agg(
        F.avg(F.when(F.col("arm") == 0, F.col("y"))).alias("y0"), F.avg(F.when(F.col("arm") == 1, F.col("y"))).alias("y1")
    )
    corr = weekly.agg(F.corr("y0", "y1").alias("pre_trend_correlation"))
    out = wide.withColumn("slope_difference", F.col("slope1") - F.col("slope0"))
    out = out.withColumn("df", F.col("n") - 4)
    out = out.withColumn("std_error", F.sqrt(F.try_divide("rss", "df") * F.col("inv")))
    out = out.withColumn("t_stat", F.try_divide("slope_difference", "std_error"))
    out = out.withColumn("interaction_pvalue", t_two_sided_p("t_stat", "df"))
    return side_by_side(out, corr).select(
        "slope_difference",
        "std_error",
        "t_stat",
        "df",
        "interaction_pvalue",
        (F.col("interaction_pvalue") > 0.05).alias("parallel_trends_holds"),
        "pre_trend_correlation",
    )


def one_hot(
    df: DataFrame, columns: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None
) -> tuple[DataFrame, list[str]]:
    """0/1 columns per level in sorted order, the first level left out; returns the new names too.

    Each level is a column of the plan, so the driver must know them: from ``levels`` (column -> its
    values as text), or read as the distinct values of the data.
    """
    if levels is None:
        seen = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
        found = df.select(F.explode(seen).alias("s")).select("s.*").where("v IS NOT NULL").distinct().collect()
        levels = {c: [r["v"] for r in found if r["c"] == c] for c in columns}
    names, cells = [], []
    for column in columns:
        for level in sorted(levels[column])[1:]:
            names.append(f"{column}_{level}")
            cells.append(flag(F.col(column).cast("string") == level).alias(names[-1]))
    return df.select("*", *cells), names


def linear_model(df: DataFrame, y: str, terms: Mapping[str, Column], cluster: str | None = None) -> dict[str, tuple[float, float | None]]:
    """Least squares by normal equations: term -> (estimate, HC1 or clustered error).

    Rows with the same terms (and cluster) are first folded into a count, a sum and a spread (squares about
    the mean) of y, which is all the fit and its robust error need (Wong and others 2021). Spark sums the p x p
    products over the folded rows; single rows of them reach the driver, where a p x p system is solved.
    The error is None with one cluster, or with no more rows than terms.
    """
    names = list(terms)
    p = len(names)
    x = [f"x{i}" for i in range(p)]
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    design = df.select(
        *[c.cast("double").alias(x[i]) for i, c in enumerate(terms.values())],
        F.col(y).cast("double").alias("y"),
        (F.col(cluster) if cluster else F.lit("all")).alias("g"),
    )
    folded = cut(
        design.groupBy("g", *x).agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.expr("var_pop(y) * count(y)").alias("q"))
    )
    row = folded.selectExpr(
        "sum(n) AS n",
        *[f"sum(n * x{i} * x{j}) AS g{i}_{j}" for i, j in pairs],
        *[f"sum(x{i} * s) AS b{i}" for i in range(p)],
    ).first()

    def symmetric(source, prefix: str) -> np.ndarray:
        out = np.zeros((p, p))
        for i, j in pairs:
            out[i, j] = out[j, i] = source[f"{prefix}{i}_{j}"] or 0.0
        return out

    gram = symmetric(row, "g")
    inverse = np.linalg.pinv(gram, hermitian=True)
    beta = [float(b) for b in inverse @ np.array([row[f"b{i}"] or 0.0 for i in range(p)])]
    fit = " + ".join(f"CAST({beta[i]!r} AS DOUBLE) * x{i}" for i in range(p))
    fitted = folded.withColumn("fit", F.expr(fit))
    n, k = row["n"], int(np.linalg.matrix_rank(gram))
    if cluster:
        scores = fitted.groupBy("g").agg(*[F.expr(f"sum(x{i} * (s - n * fit))").alias(f"s{i}") for i in range(p)])
        sums = scores.selectExpr("count(*) AS groups", *[f"sum(s{i} * s{j}) AS m{i}_{j}" for i, j in pairs]).first()
        above, below = sums["groups"] * (n - 1), (sums["groups"] - 1) * (n - k)
    else:
        squares = fitted.withColumn("e2", F.expr("q + n * pow(try_divide(s, n) - fit, 2)"))
        sums = squares.selectExpr(*[f"sum(x{i} * x{j} * e2) AS m{i}_{j}" for i, j in pairs]).first()
        above, below = n, n - k
    if below <= 0:
        return {name: (beta[i], None) for i, name in enumerate(names)}
    errors = np.sqrt(np.clip(np.diag(inverse @ symmetric(sums, "m") @ inverse) * (above / below), 0, None))
    return {name: (beta[i], float(errors[i])) for i, name in enumerate(names)}


def estimate_did_with_covariates(
    panel: DataFrame,
    outcome: str,
    treatment_time: str,
    covariates: Sequence[str],
    treated: str = "treated",
    time_col: str = "week",
    cluster: str | None = None,
    alpha: float = 0.05,
) -> DataFrame:
    """DiD coefficient of y ~ treated + post + treated:post + covariates, one row."""
    post, arm = _post(time_col, treatment_time), F.col(treated).cast("int")
    terms = {"const": F.lit(1.0), "treated": arm, "post": post, "did": arm * post}
    terms.update({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in covariates})
    estimate, error = linear_model(panel, outcome, terms, cluster)["did"]
    out = panel.sparkSession.range(1).select(
        F.lit(outcome).alias("outcome"), F.lit(estimate).alias("did_estimate"), F.lit(error).cast("double").alias("std_error")
    )
    out = out.withColumn("t_stat", F.try_divide("did_estimate", "std_error"))
    low, high = _inference(out, "did_estimate", alpha)
    return out.select("*", two_sided_p("t_stat").alias("p_value"), low.alias("ci_lower"), high.alias("ci_upper"))


def compare_estimates(base: DataFrame, other: DataFrame, tolerance_pct: float = 20.0) -> DataFrame:
    """Change of the estimate when covariates are added (percent), and whether it stays small."""
    joined = side_by_side(
        base.select(F.col("did_estimate").alias("base")), other.select(F.col("did_estimate").alias("adjusted"))
    )
    change = F.try_divide(F.col("adjusted") - F.col("base"), F.abs("base")) * 100
    return joined.select("base", "adjusted", change.alias("change_pct"), (F.abs(change) < tolerance_pct).alias("stable"))
