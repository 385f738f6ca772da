"""Experiment, power and bootstrap queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from trailmark.functions.normal import chi2_1df_p_sql, two_sided_p_sql, z_quantile
from trailmark.operators import bootstrap as bs
from trailmark.operators import experiment as ex
from trailmark.operators import power as pw
from trailmark.plans.local import local_table
from trailmark.queries.base import Registry, pct, rnd, t_two_sided_sql
from trailmark.sources.catalog import typed

registry = Registry()

# The test tables carry two randomised experiments and one rollout by region.
BINARY = {
    "exp_001": {"name": "new_onboarding_flow", "expected_lift": 0.15, "primary_metric": "activated"},
    "exp_002": {
        "name": "premium_upsell_timing",
        "expected_lift": -0.25,
        "primary_metric": "reactivated",
        "control_label": "day_7_upsell",
        "treatment_label": "day_3_upsell",
        "desired_direction": "decrease",
    },
    "exp_004": {
        "name": "real_time_protection_default",
        "expected_lift": 0.10,
        "primary_metric": "threat_resolved",
        "analysis_method": ex.DID,
        "control_label": "control_group",
        "treatment_label": "rollout_group",
    },
}
CONTINUOUS = {
    "exp_001": {**BINARY["exp_001"], "primary_metric": "revenue"},
    "exp_002": {**BINARY["exp_002"], "primary_metric": "orders"},
}


def cfg(experiments: dict) -> str:
    rows = []
    for e, c in experiments.items():
        labels = f"'{c.get('control_label', 'control')}', '{c.get('treatment_label', 'treatment')}'"
        rows.append(
            f"('{e}', '{c['name']}', '{c['primary_metric']}', CAST({c['expected_lift']} AS DOUBLE), "
            f"'{c.get('analysis_method', 'ab_test')}', {labels}, '{c.get('desired_direction', 'increase')}')"
        )
    return f"cfg(experiment_id, name, primary_metric, expected_lift, method, cl, tl, direction) AS (VALUES {', '.join(rows)})"


def vals(experiments: dict, extra: str = "", join: str = "") -> str:
    """CTEs cfg and vals (experiment_id, user_id, arm, value)."""
    return f"""{cfg(experiments)},
    vals AS (SELECT a.experiment_id, a.user_id, {extra} CASE WHEN a.variant = cfg.cl THEN 'control' ELSE 'treatment' END AS arm,
        coalesce(m.metric_value, 0) AS value
        FROM assignments a JOIN cfg ON a.experiment_id = cfg.experiment_id {join}
        LEFT JOIN metrics m ON m.experiment_id = a.experiment_id AND m.user_id = a.user_id AND m.metric_name = cfg.primary_metric
        WHERE a.variant IN (cfg.cl, cfg.tl))"""


def totals(keys: str = "experiment_id") -> str:
    parts = []
    for arm, s in (("control", "c"), ("treatment", "t")):
        parts.append(
            f"count(*) FILTER (WHERE arm = '{arm}') AS n_{s}, sum(value) FILTER (WHERE arm = '{arm}') AS total_{s}, "
            f"avg(value) FILTER (WHERE arm = '{arm}') AS mean_{s}, var_samp(value) FILTER (WHERE arm = '{arm}') AS var_{s}"
        )
    return f"tot AS (SELECT {keys}, {', '.join(parts)} FROM vals GROUP BY {keys})"


TESTED = {k: c for k, c in BINARY.items() if c.get("analysis_method") != ex.DID}
Z = z_quantile(0.975)
PROPORTION = """pr AS (SELECT *, total_c / n_c AS p_c, total_t / n_t AS p_t, (total_c + total_t) / (n_c + n_t) AS pool FROM tot),
    zs AS (SELECT *, p_t - p_c AS lift, coalesce((p_t - p_c) / nullif(sqrt(pool * (1 - pool) * (1.0 / n_c + 1.0 / n_t)), 0), 0) AS z,
           sqrt(p_c * (1 - p_c) / n_c + p_t * (1 - p_t) / n_t) AS se FROM pr)"""


def proportion_out(stat: str, p: str, keys: str = "experiment_id") -> str:
    return f"""{keys}, n_c AS n_control, n_t AS n_treatment, {rnd('p_c')} AS control_rate, {rnd('p_t')} AS treatment_rate,
        {rnd('lift')} AS absolute_lift, {rnd('lift / p_c', 4)} AS relative_lift, {rnd(stat, 4)} AS statistic, {rnd(p)} AS p_value,
        {p} < 0.05 AS significant, {rnd(f'lift - {Z!r} * se')} AS ci_lower, {rnd(f'lift + {Z!r} * se')} AS ci_upper"""


def config(v, experiments=TESTED):
    return ex.experiment_config(v.spark, experiments)


def values(v, experiments=TESTED):
    return ex.arm_values(v.assignments, v.metrics, config(v, experiments))


@registry.add(
    "srm_check",
    f"""WITH {cfg(BINARY)}, c AS (SELECT a.experiment_id, count(*) FILTER (WHERE variant = cl) AS n_control,
            count(*) FILTER (WHERE variant = tl) AS n_treatment FROM assignments a JOIN cfg ON a.experiment_id = cfg.experiment_id
            GROUP BY a.experiment_id),
        x AS (SELECT *, (n_control + n_treatment) / 2e0 AS e FROM c),
        y AS (SELECT *, (n_control - e) * (n_control - e) / e + (n_treatment - e) * (n_treatment - e) / e AS chi2 FROM x)
    SELECT experiment_id, n_control, n_treatment, {rnd('CAST(n_control AS DOUBLE) / (n_control + n_treatment)', 4)} AS observed_ratio,
        CAST(0.5 AS DOUBLE) AS expected_ratio, {rnd('chi2', 4)} AS chi2_statistic, {rnd(chi2_1df_p_sql('chi2'))} AS srm_p_value,
        {chi2_1df_p_sql('chi2')} < 0.001 AS srm_detected FROM y""",
)
def _(v):
    return ex.variant_srm(v.assignments, config(v, BINARY))


@registry.add(
    "proportion_z",
    f"""WITH {vals(TESTED)}, {totals()}, {PROPORTION} SELECT {proportion_out('z', two_sided_p_sql('z'))},
        CAST(0.05 AS DOUBLE) AS alpha, 'z_test' AS test_type FROM zs""",
)
def _(v):
    return ex.proportion_test(ex.arm_totals(values(v)))


# Pearson's statistic from the 2x2 table itself, not from z.
CELL = "({o} - {e}) * ({o} - {e}) / {e}"
CHI2 = " + ".join(
    CELL.format(o=o, e=e)
    for o, e in (
        ("total_c", "(n_c * pool)"),
        ("(n_c - total_c)", "(n_c * (1 - pool))"),
        ("total_t", "(n_t * pool)"),
        ("(n_t - total_t)", "(n_t * (1 - pool))"),
    )
)


@registry.add(
    "proportion_chi2",
    f"""WITH {vals(TESTED)}, {totals()}, {PROPORTION}, xs AS (SELECT *, {CHI2} AS chi2 FROM zs)
    SELECT {proportion_out('chi2', chi2_1df_p_sql('chi2'))}, CAST(0.05 AS DOUBLE) AS alpha, 'chi_square' AS test_type FROM xs""",
)
def _(v):
    return ex.proportion_test(ex.arm_totals(values(v)), test_type="chi_square")


MEANS = f"""experiment_id, {rnd('mean_c')} AS control_mean, {rnd('mean_t')} AS treatment_mean, n_c AS n_control, n_t AS n_treatment,
    {rnd('mean_t - mean_c')} AS absolute_lift, {rnd('(mean_t - mean_c) / mean_c', 4)} AS relative_lift,
    {rnd('(mean_t - mean_c) / sqrt(((n_c - 1) * var_c + (n_t - 1) * var_t) / (n_c + n_t - 2))', 4)} AS cohens_d"""


@registry.add(
    "means_welch",
    f"""WITH {vals(CONTINUOUS)}, {totals()}, v AS (SELECT *, var_c / n_c AS a, var_t / n_t AS b FROM tot),
    w AS (SELECT *, (mean_t - mean_c) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n_c - 1) + b * b / (n_t - 1)) AS df FROM v),
    x AS (SELECT *, {t_two_sided_sql('w.t', 'w.df')} AS p FROM w)
    SELECT {MEANS}, {rnd('t', 4)} AS statistic, {rnd('df')} AS df, {rnd('p')} AS p_value, p < 0.05 AS significant FROM x""",
)
def _(v):
    return ex.means_test(values(v, CONTINUOUS)).drop("ci_lower", "ci_upper", "alpha", "test_type")


@registry.add(
    "means_student",
    f"""WITH {vals(CONTINUOUS)}, {totals()}, v AS (SELECT *, ((n_c - 1) * var_c + (n_t - 1) * var_t) / (n_c + n_t - 2) AS s2 FROM tot),
    w AS (SELECT *, (mean_t - mean_c) / sqrt(s2 * (1e0 / n_c + 1e0 / n_t)) AS t, CAST(n_c + n_t - 2 AS DOUBLE) AS df FROM v),
    x AS (SELECT *, {t_two_sided_sql('w.t', 'w.df')} AS p FROM w)
    SELECT {MEANS}, {rnd('t', 4)} AS statistic, df, {rnd('p')} AS p_value, p < 0.05 AS significant FROM x""",
)
def _(v):
    out = ex.means_test(values(v, CONTINUOUS), test_type="student")
    return out.drop("ci_lower", "ci_upper", "alpha", "test_type")


@registry.add("means_welch_inference")
def _(v):
    return ex.means_test(values(v, CONTINUOUS))


@registry.add(
    "mann_whitney_u",
    f"""WITH {vals(CONTINUOUS)}, {totals()},
    rk AS (SELECT *, rank() OVER (PARTITION BY experiment_id ORDER BY value) + (count(*) OVER (PARTITION BY experiment_id, value) - 1) / 2e0 AS r FROM vals),
    ti AS (SELECT experiment_id, sum(k * k * k - k) AS ties FROM (SELECT experiment_id, CAST(count(*) AS DOUBLE) AS k FROM vals GROUP BY experiment_id, value) GROUP BY 1),
    u AS (SELECT t.*, CAST(n_c AS DOUBLE) * n_t AS nn, n_c + n_t AS n, ti.ties,
          (SELECT sum(r) FROM rk WHERE rk.experiment_id = t.experiment_id AND arm = 'treatment') - n_t * (n_t + 1) / 2e0 AS u
          FROM tot t JOIN ti ON t.experiment_id = ti.experiment_id),
    zz AS (SELECT *, greatest((greatest(u, nn - u) - nn / 2 - 0.5) / sqrt(nn / 12 * (n + 1 - ties / (CAST(n AS DOUBLE) * (n - 1)))), 0) AS z FROM u)
    SELECT {MEANS}, {rnd('u', 4)} AS statistic, {rnd(f"least({two_sided_p_sql('z')}, 1)")} AS p_value, {two_sided_p_sql('z')} < 0.05 AS significant
    FROM zz""",
)
def _(v):
    out = ex.means_test(values(v, CONTINUOUS), test_type="mann_whitney")
    return out.drop("df", "ci_lower", "ci_upper", "alpha", "test_type")


SEGMENT = "JOIN customer cu ON cu.c_custkey = a.user_id"
FAMILY = "experiment_id, segment"


def segment_tests(v):
    segments = v.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    keyed = values(v).join(segments, "user_id")
    keys = ["experiment_id", "segment"]
    return ex.proportion_test(ex.arm_totals(keyed, keys), keys=keys).select(*keys, "p_value")


@registry.add(
    "multiple_testing",
    f"""WITH {vals(TESTED, 'cu.c_mktsegment AS segment,', SEGMENT)}, {totals(FAMILY)}, {PROPORTION},
    p AS (SELECT experiment_id, segment, {two_sided_p_sql('z')} AS p FROM zs),
    k AS (SELECT *, count(*) OVER (PARTITION BY experiment_id) AS m, rank() OVER (PARTITION BY experiment_id ORDER BY p) AS r,
          row_number() OVER (PARTITION BY experiment_id ORDER BY p) AS i FROM p),
    c AS (SELECT experiment_id, max(p) AS cut FROM k WHERE p <= i * 0.05 / m GROUP BY experiment_id)
    SELECT k.experiment_id, segment, {rnd('p')} AS p_value_raw, p < 0.05 AS significant_raw, {rnd('least(p * m, 1)')} AS p_value_bonferroni,
        least(p * m, 1) < 0.05 AS significant_bonferroni, {rnd('least(p * m / r, 1)')} AS p_value_bh, coalesce(p <= cut, false) AS significant_bh
    FROM k LEFT JOIN c ON k.experiment_id = c.experiment_id""",
)
def _(v):
    return ex.correct_multiple_tests(segment_tests(v), family=["experiment_id"])


SIZES = f"""p2 AS (SELECT *, p1 * (1 + mde) AS p2 FROM plan),
    sized AS (SELECT *, ({{za}} * sqrt(2 * ((p1 + p2) / 2) * (1 - (p1 + p2) / 2)) + {{zb}} * sqrt(p1 * (1 - p1) + p2 * (1 - p2))) AS root FROM p2),
    need AS (SELECT *, CAST(ceil(root * root / ((p2 - p1) * (p2 - p1))) AS BIGINT) AS n FROM sized)"""
DEFAULT = SIZES.format(za=repr(Z), zb=repr(z_quantile(0.8)))


@registry.add(
    "sample_size",
    f"""WITH plan AS (SELECT c_mktsegment AS segment, avg(CASE WHEN c_acctbal < 3000 THEN 1e0 ELSE 0e0 END) AS p1, 0.1e0 AS mde
        FROM customer GROUP BY c_mktsegment), {DEFAULT}
    SELECT segment, {rnd('p1')} AS baseline_rate, mde, n AS n_control, n AS n_treatment, 2 * n AS n_total, {rnd('p2')} AS treatment_rate,
        {rnd('p2 - p1')} AS absolute_effect, mde AS relative_effect, 0.05e0 AS alpha, 0.8e0 AS power FROM need""",
)
def _(v):
    low = F.when(F.col("c_acctbal") < 3000, 1.0).otherwise(0.0)
    plans = v.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.avg(low).alias("baseline_rate"))
    return pw.compute_sample_size(plans.withColumn("mde", F.lit(0.1)))


LEVELS = ", ".join(f"({p}e0, {z_quantile(p)!r})" for p in (0.7, 0.8, 0.9))


@registry.add(
    "power_curve",
    f"""WITH {vals(TESTED)}, {totals()}, lv(power, zb) AS (VALUES {LEVELS}),
    plan AS (SELECT t.experiment_id, t.mean_c AS p1, g.k / 100e0 AS mde, lv.power, CAST(lv.zb AS DOUBLE) AS zb FROM tot t, range(2, 31, 2) g(k), lv),
    {SIZES.format(za=repr(Z), zb='zb')}
    SELECT experiment_id, mde, power, n AS n_per_variant, 2 * n AS n_total FROM need""",
)
def _(v):
    rates = ex.arm_totals(values(v)).select("experiment_id", F.col("mean_c").alias("baseline_rate"))
    return pw.power_curve(rates).drop("baseline_rate")


@registry.add(
    "power_audit",
    f"""WITH {vals(TESTED)}, {totals()},
    plan AS (SELECT t.experiment_id, cfg.name, t.mean_c AS p1, abs(cfg.expected_lift) AS mde, t.n_c AS actual_n FROM tot t JOIN cfg ON t.experiment_id = cfg.experiment_id),
    {DEFAULT}
    SELECT experiment_id, name, {rnd('p1')} AS baseline_rate, mde, n AS required_n, actual_n, actual_n >= n AS powered FROM need""",
)
def _(v):
    return ex.power_audit(v.assignments, v.metrics, config(v, BINARY))


DECISION = """CASE WHEN srm THEN 'INVALID' WHEN p < 0.05 AND {good} THEN 'SHIP' WHEN p < 0.05 AND {bad} THEN 'DO NOT SHIP' ELSE 'INCONCLUSIVE' END"""
PLAIN_RULE = DECISION.format(good="lift > 0", bad="lift < 0")
BUSINESS_RULE = DECISION.format(
    good="(CASE WHEN direction = 'decrease' THEN lift < 0 ELSE lift > 0 END)",
    bad="(CASE WHEN direction = 'decrease' THEN lift > 0 ELSE lift < 0 END)",
)
JUDGED = f"""{PROPORTION}, sr AS (SELECT *, {CHI2} AS chi2, (n_c - (n_c + n_t) / 2e0) * (n_c - (n_c + n_t) / 2e0) / ((n_c + n_t) / 2e0) * 2 AS srm_chi2 FROM zs),
    j AS (SELECT *, {chi2_1df_p_sql('srm_chi2')} < 0.001 AS srm, {two_sided_p_sql('z')} AS p FROM sr)"""


@registry.add(
    "experiment_analysis",
    f"""WITH {vals(TESTED)}, {totals()}, {JUDGED}
    SELECT j.experiment_id, cfg.primary_metric, 'proportion' AS metric_type, {PLAIN_RULE} AS decision, {BUSINESS_RULE} AS business_decision,
        n_c AS n_control, n_t AS n_treatment, {rnd('srm_chi2', 4)} AS srm_chi2, {rnd('z', 4)} AS z, {rnd('chi2', 4)} AS chi2, {rnd('p')} AS p_value
    FROM j JOIN cfg ON j.experiment_id = cfg.experiment_id""",
)
def _(v):
    out = ex.analyze_experiments(v.assignments, v.metrics, config(v))
    return out.select(
        "experiment_id", "primary_metric", "metric_type", "decision", "business_decision",
        F.col("srm_check.n_control").alias("n_control"), F.col("srm_check.n_treatment").alias("n_treatment"),
        F.col("srm_check.chi2_statistic").alias("srm_chi2"), F.col("primary_test.statistic").alias("z"),
        F.col("chi_square_test.statistic").alias("chi2"), F.col("primary_test.p_value").alias("p_value"),
    )


@registry.add(
    "experiment_summary",
    f"""WITH {vals(BINARY)}, {totals()}, {JUDGED}
    SELECT cfg.experiment_id, cfg.name, cfg.primary_metric, cfg.expected_lift,
        CASE WHEN method = '{ex.DID}' THEN 'SKIP' ELSE {PLAIN_RULE} END AS decision,
        CASE WHEN method = '{ex.DID}' THEN 'SKIP' ELSE {BUSINESS_RULE} END AS business_decision,
        {rnd('p')} AS p_value, {rnd('lift / p_c', 4)} AS observed_lift, {rnd(f'lift - {Z!r} * se')} AS ci_lower, {rnd(f'lift + {Z!r} * se')} AS ci_upper,
        p < 0.05 AS significant, NOT srm AS srm_clean
    FROM cfg LEFT JOIN j ON cfg.experiment_id = j.experiment_id AND method <> '{ex.DID}'""",
)
def _(v):
    return ex.summarize_all_experiments(v.assignments, v.metrics, config(v, BINARY))


@registry.add(
    "assignment_balance",
    f"""SELECT experiment_id, variant, count(*) AS users, {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY experiment_id)', 4)} AS pct
    FROM assignments GROUP BY experiment_id, variant""",
)
def _(v):
    return ex.assignment_balance(v.assignments)


@registry.add("metric_names", """SELECT experiment_id, metric_name, count(*) AS "rows" FROM metrics GROUP BY experiment_id, metric_name""")
def _(v):
    return ex.metric_names(v.metrics)


@registry.add(
    "geo_confounding",
    f"""WITH g AS (SELECT u.country, count(*) AS users, avg(CASE WHEN a.variant = 'rollout_group' THEN 1e0 ELSE 0e0 END) AS rate
        FROM assignments a LEFT JOIN users_o u ON a.user_id = u.user_id WHERE a.experiment_id = 'exp_004' GROUP BY u.country)
    SELECT country, users, {rnd('rate')} AS treatment_rate, rate > 0.6 OR rate < 0.4 AS confounded FROM g""",
)
def _(v):
    return ex.geo_confounding(v.assignments, v.users_o, "exp_004", "rollout_group")


DRAW = "CAST(('0x' || substr(md5(concat('exp_003|', CAST(user_id AS VARCHAR))), 1, 8)) AS BIGINT) / 4294967296e0"


@registry.add(
    "variant_assignment",
    f"""SELECT 'exp_003' AS experiment_id, user_id, CASE WHEN {DRAW} < 0.5 THEN 'day_7_upsell' WHEN {DRAW} < 0.8 THEN 'day_3_upsell' ELSE 'day_10_upsell' END AS variant,
        CAST(signup_date AS VARCHAR) AS assigned_at FROM users_o WHERE signup_date BETWEEN DATE '1995-02-01' AND DATE '1995-12-31' AND plan_type = 'free'""",
)
def _(v):
    return ex.assign_variants(
        v.users_o, "exp_003", ["day_7_upsell", "day_3_upsell", "day_10_upsell"], [0.5, 0.3, 0.2], "1995-02-01", "1995-12-31",
        eligible=F.col("plan_type") == "free",
    )


@registry.add(
    "variant_assignment_geo",
    """SELECT 'exp_004' AS experiment_id, user_id, CASE WHEN country IN ('NATION_0', 'NATION_1') THEN 'rollout_group' ELSE 'control_group' END AS variant,
        CAST(signup_date AS VARCHAR) AS assigned_at FROM users_o WHERE signup_date BETWEEN DATE '1995-02-01' AND DATE '1995-12-31'""",
)
def _(v):
    rule = F.when(F.col("country").isin("NATION_0", "NATION_1"), F.lit("rollout_group")).otherwise(F.lit("control_group"))
    return ex.assign_variants(
        v.users_o, "exp_004", ["rollout_group", "control_group"], [0.5, 0.5], "1995-02-01", "1995-12-31", rule=rule
    )


# The experiments as a table stores them: lists as text.
EXPERIMENT_ROWS = [
    ("exp_101", "1995-01-01", "1995-06-30", "['control', 'treatment']", "[0.5, 0.5]", "all_new_users"),
    ("exp_102", "1995-03-01", "1996-12-31", "['a', 'b', 'c', 'd']", "[0.1, 0.2, 0.3, 0.4]", "all_users"),
    ("exp_103", "1995-02-01", "1995-12-31", "['day_7_upsell', 'day_3_upsell', 'day_10_upsell']", "[0.5, 0.3, 0.2]", "free_users"),
    ("exp_104", "1994-01-01", "1999-02-28", "['rollout_group', 'control_group']", "[0.5, 0.5]", "geo_based"),
]
EXPERIMENT_COLUMNS = ("experiment_id", "start_date", "end_date", "variants", "allocation", "targeting")
STORED = f"""stored({', '.join(EXPERIMENT_COLUMNS)}) AS (VALUES {
    ', '.join('(' + ', '.join("'" + x.replace("'", "''") + "'" for x in row) + ')' for row in EXPERIMENT_ROWS)
})"""


@registry.add(
    "variant_assignment_table",
    f"""WITH {STORED}, x AS (SELECT *, list_transform(string_split(trim(variants, '[]'), ', '), lambda a: trim(a, chr(39))) AS names,
        list_transform(string_split(trim(allocation, '[]'), ', '), lambda a: CAST(a AS DOUBLE)) AS shares FROM stored),
    m AS (SELECT x.*, user_id, country, signup_date,
            CAST(('0x' || substr(md5(concat(experiment_id, '|', CAST(user_id AS VARCHAR))), 1, 8)) AS BIGINT) / 4294967296e0 AS draw
          FROM users_o JOIN x ON signup_date BETWEEN CAST(start_date AS DATE) AND CAST(end_date AS DATE) AND (targeting <> 'free_users' OR plan_type = 'free'))
    SELECT experiment_id, user_id, CAST(signup_date AS VARCHAR) AS assigned_at, CASE WHEN targeting <> 'geo_based'
        THEN names[1 + len(list_filter(generate_series(1, len(shares) - 1), lambda k: list_sum(shares[1:k]) <= draw))]
        WHEN country IN ('NATION_0', 'NATION_1') THEN names[1] ELSE names[2] END AS variant FROM m""",
)
def _(v):
    rows = [dict(zip(EXPERIMENT_COLUMNS, row)) for row in EXPERIMENT_ROWS]
    stored = local_table(v.spark, rows, ", ".join(f"{c} string" for c in EXPERIMENT_COLUMNS))
    return ex.assign_from_table(v.users_o, typed(stored, "experiments"), rollout_countries=["NATION_0", "NATION_1"])


# The same 10,000 Poisson replicates of the mean in SQL, by the same hash, for one experiment each.
B = 10_000
REVENUE = {"exp_001": CONTINUOUS["exp_001"]}
ACTIVATED = {"exp_001": BINARY["exp_001"]}


def replicates_sql(experiments: dict, value: str = "value") -> str:
    """CTEs ``rep`` (experiment_id, replicate, diff) and ``obs`` (experiment_id, o) of the mean of ``value``."""
    mask, steps, source = (1 << 32) - 1, [], f"base, range({B}) n(r)"

    def step(x: str, kept: str = "") -> None:
        nonlocal source
        steps.append(f"x{len(steps)} AS (SELECT experiment_id, arm, value, second, r, {kept} {x} AS x FROM {source})")
        source = f"x{len(steps) - 1}"

    def mixed(kept: str) -> None:
        for shift, factor in bs.MIX:
            step(f"xor(x, x >> {shift})", kept)
            step(f"(x * {factor}) & {mask}", kept)

    step(f"(first + (((r + 1)::UBIGINT * {bs.STEP}) & {mask})) & {mask}")
    mixed("")
    step(f"(x + second) & {mask}", "x AS y,")
    mixed("y,")
    step(f"(x + y) & {mask}", "x AS high,")
    mixed("high,")
    words = [f"CAST('0x' || substr(m, {at}, 8) AS UBIGINT)" for at in (1, 9)]
    weight = " + ".join(f"(u >= {least})::INT" for least in bs.poisson_thresholds())
    return f"""{vals(experiments)}, hashed AS (SELECT experiment_id, arm, {value} AS value, md5(concat_ws('|', '42', experiment_id, CAST(user_id AS VARCHAR))) AS m FROM vals),
    base AS (SELECT experiment_id, arm, value, {words[0]} AS first, {words[1]} AS second FROM hashed), {', '.join(steps)},
    d AS (SELECT experiment_id, arm, value, r, (high << {bs.DRAW_BITS - 32}) | (x >> {64 - bs.DRAW_BITS}) AS u FROM {source}),
    e AS (SELECT experiment_id, arm, value, r, {weight} AS k FROM d),
    w AS (SELECT experiment_id, arm, r, sum(k) AS w, sum(k * value) AS wx FROM e GROUP BY ALL),
    rep AS (SELECT experiment_id, r AS replicate, max(wx / w) FILTER (arm = 'treatment') - max(wx / w) FILTER (arm = 'control') AS diff FROM w GROUP BY ALL),
    obs AS (SELECT experiment_id, avg(value) FILTER (WHERE arm = 'treatment') - avg(value) FILTER (WHERE arm = 'control') AS o FROM base GROUP BY ALL)"""


SPREAD = """s AS (SELECT r.experiment_id, max(o) AS o, quantile_cont(diff, 0.025) AS lo, quantile_cont(diff, 0.975) AS hi,
    avg(CASE WHEN abs(diff) >= abs(o) THEN 1e0 ELSE 0e0 END) AS p, avg(CASE WHEN abs(diff - o) >= abs(o) THEN 1e0 ELSE 0e0 END) AS pc,
    avg(diff) AS mean, stddev_pop(diff) AS std, count(*) AS n FROM rep r JOIN obs ON r.experiment_id = obs.experiment_id GROUP BY 1)"""


def interval_sql(digits: int) -> str:
    parts = {"observed_diff": "o", "ci_lower": "lo", "ci_upper": "hi", "p_value_bootstrap": "p", "p_value_centered": "pc", "bootstrap_mean": "mean", "bootstrap_std": "std"}
    told = ", ".join(f"{rnd(x, digits)} AS {name}" for name, x in parts.items())
    return f"SELECT experiment_id, {told}, n AS n_bootstrap, 0.05e0 AS alpha, lo > 0 OR hi < 0 AS significant FROM s"


@registry.add("bootstrap_poisson", f"WITH {replicates_sql(REVENUE)}, {SPREAD} {interval_sql(4)}", digits=4)
def _(v):
    return bs.bootstrap_ci(values(v, REVENUE))


@registry.add("bootstrap_ci", f"WITH {replicates_sql(ACTIVATED)}, {SPREAD} {interval_sql(6)}")
def _(v):
    return bs.bootstrap_ci(values(v, ACTIVATED))


@registry.add(
    "bootstrap_distribution",
    f"""WITH {replicates_sql(REVENUE)}, b AS (SELECT experiment_id, min(diff) AS lo, (max(diff) - min(diff)) / 50 AS width FROM rep GROUP BY experiment_id),
    x AS (SELECT rep.experiment_id, CAST(least(floor((diff - lo) / width), 49) AS INTEGER) AS bin, lo, width FROM rep JOIN b ON rep.experiment_id = b.experiment_id)
    SELECT experiment_id, bin, {rnd('lo + bin * width', 4)} AS bin_start, {rnd('lo + (bin + 1) * width', 4)} AS bin_end, count(*) AS "count"
    FROM x GROUP BY experiment_id, bin, lo, width""",
    digits=4,
)
def _(v):
    return bs.bootstrap_distribution(bs.bootstrap_replicates(values(v, REVENUE)))


# A metric of one's own: the share of users above a bound, from two running sums.
ABOVE = 500_000.0
SHARE_ABOVE = bs.Aggregate(
    start=lambda b: np.zeros((2, b)),
    add=lambda state, x, w: state + np.stack([np.ones(len(x)), x > ABOVE]) @ w,
    merge=lambda a, b: a + b,
    finish=lambda state: np.divide(state[1], state[0], out=np.full(state.shape[1], np.nan), where=state[0] > 0),
)


@registry.add(
    "bootstrap_own_metric",
    f"WITH {replicates_sql(REVENUE, f'CASE WHEN value > {ABOVE!r} THEN 1e0 ELSE 0e0 END')}, {SPREAD} {interval_sql(6)}",
)
def _(v):
    return bs.bootstrap_ci(values(v, REVENUE), metric=SHARE_ABOVE)


@registry.add("bootstrap_median")
def _(v):
    return bs.bootstrap_ci(values(v, CONTINUOUS), metric="median", method="order_statistic")


@registry.add(
    "method_agreement",
    f"""WITH {replicates_sql(TESTED)}, {totals()}, {PROPORTION}, {SPREAD},
    v AS (SELECT zs.experiment_id, {two_sided_p_sql('z')} AS zp, {chi2_1df_p_sql('z * z')} AS cp, p AS bp, lo > 0 OR hi < 0 AS bsig
          FROM zs JOIN s ON s.experiment_id = zs.experiment_id)
    SELECT experiment_id, {rnd('zp')} AS z_test_p, zp < 0.05 AS z_test_sig, {rnd('cp')} AS chi_sq_p, cp < 0.05 AS chi_sq_sig, {rnd('bp')} AS bootstrap_p,
        bsig AS bootstrap_sig, (zp < 0.05) = (cp < 0.05) AND (cp < 0.05) = bsig AS all_agree FROM v""",
)
def _(v):
    boot = bs.bootstrap_ci(values(v))
    return ex.method_agreement(ex.analyze_experiments(v.assignments, v.metrics, config(v), bootstrap=boot))
