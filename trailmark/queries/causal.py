"""Difference-in-differences, discontinuity, matching and sensitivity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmark.functions.normal import two_sided_p_sql, upper_tail_p_sql, z_quantile
from trailmark.operators import did, psm, rdd
from trailmark.queries.base import Registry, rnd, t_two_sided_sql
from trailmark.queries.engagement import ENGAGEMENT

registry = Registry()
START = "2024-01-15"
COUNTS = {"purchases": "purchase", "clicks": "click"}
FEATURE = "feature_1"
Z = z_quantile(0.975)


def rollout(v, users):
    return did.rollout_users(v.assignments, users, "exp_004", "rollout_group", ("country", "device_os", "acquisition_channel"))


def panel(v):
    return did.user_week_panel(v.events_e, rollout(v, v.users_e), COUNTS)


ROLLOUT = """ro AS (SELECT a.user_id, CASE WHEN a.variant = 'rollout_group' THEN 1 ELSE 0 END AS treated, u.country, a.assigned_at
    FROM assignments a LEFT JOIN users_e u ON a.user_id = u.user_id WHERE a.experiment_id = 'exp_004')"""
PANEL = f"""{ROLLOUT}, dated AS (SELECT *, CAST(timestamp AS DATE) - CAST(isodow(timestamp) - 1 AS INTEGER) AS week FROM events_e),
    pa AS (SELECT ro.user_id, dated.week, ro.treated, ro.country, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
        count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) AS total_events
        FROM ro JOIN dated USING (user_id) GROUP BY ALL)"""


@registry.add(
    "rollout_groups",
    f"""WITH {ROLLOUT.replace('users_e', 'users_o')}, g AS (SELECT country, count(*) AS users, avg(CAST(treated AS DOUBLE)) AS rate FROM ro GROUP BY country)
    SELECT country, users, {rnd('rate')} AS treatment_rate, rate > 0.5 AS is_treatment, CAST((SELECT min(assigned_at) FROM ro) AS VARCHAR) AS treatment_start FROM g""",
)
def _(v):
    return did.rollout_groups(did.rollout_users(v.assignments, v.users_o, "exp_004", "rollout_group"))


@registry.add(
    "did_panel",
    f"WITH {PANEL} SELECT user_id, CAST(week AS VARCHAR) AS week, purchases, clicks, total_events, CAST(treated AS BIGINT) AS treated, country FROM pa",
)
def _(v):
    return panel(v)


@registry.add(
    "did_panel_dense",
    f"""WITH {PANEL}, wk AS (SELECT unnest(generate_series((SELECT min(week) FROM pa), (SELECT max(week) FROM pa), INTERVAL 7 DAY)) AS week),
    us AS (SELECT DISTINCT user_id, treated, country FROM pa)
    SELECT us.user_id, CAST(CAST(wk.week AS DATE) AS VARCHAR) AS week, CAST(us.treated AS BIGINT) AS treated, us.country,
        coalesce(pa.purchases, 0) AS purchases, coalesce(pa.clicks, 0) AS clicks
    FROM us CROSS JOIN wk LEFT JOIN pa ON pa.user_id = us.user_id AND pa.week = CAST(wk.week AS DATE)""",
)
def _(v):
    return did.densify_panel(panel(v), list(COUNTS))


@registry.add(
    "panel_summary",
    f"""WITH {PANEL} SELECT count(*) AS panel_rows, count(DISTINCT user_id) AS users, count(DISTINCT week) AS weeks,
        CAST(min(week) AS VARCHAR) AS first_week, CAST(max(week) AS VARCHAR) AS last_week FROM pa""",
)
def _(v):
    return did.panel_summary(panel(v))


def did_sql(outcome: str, clustered: bool, start: str = START) -> str:
    """Errors from per-row influence values, row by row."""
    variance = (
        "(SELECT count(*) / (count(*) - 1e0) * ((SELECT n FROM tt) - 1) / ((SELECT n FROM tt) - 4) * sum(s * s) FROM (SELECT country, sum(inf) AS s FROM iv GROUP BY country))"
        if clustered
        else "(SELECT count(*) / (count(*) - 4e0) * sum(inf * inf) FROM iv)"
    )
    groups = "(SELECT count(DISTINCT coalesce(country, '')) FROM iv)" if clustered else "CAST(NULL AS BIGINT)"
    return f"""WITH {PANEL}, ce AS (SELECT treated AS t, week >= DATE '{start}' AS p, CAST(count(*) AS DOUBLE) AS n, avg(CAST({outcome} AS DOUBLE)) AS m FROM pa GROUP BY 1, 2),
    iv AS (SELECT pa.country, (CASE WHEN (ce.t = 1) = ce.p THEN 1 ELSE -1 END) * ({outcome} - ce.m) / ce.n AS inf
           FROM pa JOIN ce ON pa.treated = ce.t AND (pa.week >= DATE '{start}') = ce.p),
    tt AS (SELECT sum(n) AS n, CAST(sum(n) FILTER (WHERE t = 1) AS BIGINT) AS n1, CAST(sum(n) FILTER (WHERE t = 0) AS BIGINT) AS n0,
           max(CASE WHEN t = 1 AND p THEN m END) AS m11, max(CASE WHEN t = 1 AND NOT p THEN m END) AS m10,
           max(CASE WHEN t = 0 AND p THEN m END) AS m01, max(CASE WHEN t = 0 AND NOT p THEN m END) AS m00 FROM ce),
    es AS (SELECT *, (m11 - m10) - (m01 - m00) AS e, sqrt({variance}) AS se, {groups} AS g FROM tt), zz AS (SELECT *, e / se AS z FROM es)
    SELECT '{outcome}' AS outcome, {rnd('e')} AS did_estimate, {rnd('se')} AS std_error, {rnd('z')} AS t_stat, {rnd(two_sided_p_sql('z'))} AS p_value,
        {rnd(f'e - {Z!r} * se')} AS ci_lower, {rnd(f'e + {Z!r} * se')} AS ci_upper, {rnd('m10 - m00')} AS pre_difference,
        {rnd('m11 - m01')} AS post_difference, n1 AS n_treatment, n0 AS n_control, g AS n_clusters FROM zz"""


@registry.add("did_2x2", did_sql("purchases", False))
def _(v):
    return did.estimate_did(panel(v), "purchases", START)


@registry.add("did_alternative_outcome", did_sql("clicks", False))
def _(v):
    return did.estimate_did(panel(v), "clicks", START)


@registry.add("did_cluster_se", did_sql("purchases", True))
def _(v):
    return did.estimate_did(panel(v), "purchases", START, cluster="country")


@registry.add(
    "parallel_trends_series",
    f"""WITH {PANEL} SELECT CAST(week AS VARCHAR) AS week, CAST(treated AS BIGINT) AS treated, {rnd('avg(purchases)')} AS mean_outcome, count(*) AS n,
        CAST(max(CASE WHEN week >= DATE '{START}' THEN 1 ELSE 0 END) AS BIGINT) AS post FROM pa GROUP BY week, treated""",
)
def _(v):
    return did.parallel_trends_series(panel(v), "purchases", START)


# Weekly trends need at least three weeks before treatment, so this one starts later.
TREND_START = "2024-01-29"


def trends_sql(start: str) -> str:
    return f"""WITH {PANEL}, pre AS (SELECT treated AS arm, CAST(date_diff('week', DATE '{start}', week) AS DOUBLE) AS x, CAST(purchases AS DOUBLE) AS y
        FROM pa WHERE week < DATE '{start}'),
    l AS (SELECT arm, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx FROM pre GROUP BY arm),
    r AS (SELECT sum((y - a - b * x) * (y - a - b * x)) AS rss, count(*) AS n FROM pre JOIN l ON pre.arm = l.arm),
    s AS (SELECT (SELECT b FROM l WHERE arm = 1) - (SELECT b FROM l WHERE arm = 0) AS d, sqrt(rss / (n - 4) * (SELECT sum(1 / sxx) FROM l)) AS se, n - 4 AS df FROM r),
    c AS (SELECT corr(y0, y1) AS c FROM (SELECT x, avg(y) FILTER (WHERE arm = 0) AS y0, avg(y) FILTER (WHERE arm = 1) AS y1 FROM pre GROUP BY x)),
    tp AS (SELECT s.*, c.c, d / se AS t, {t_two_sided_sql('(s.d / s.se)', 's.df')} AS p FROM s, c)
    SELECT {rnd('d')} AS slope_difference, {rnd('se')} AS std_error, {rnd('t')} AS t_stat, CAST(df AS DOUBLE) AS df, {rnd('p')} AS interaction_pvalue,
        p > 0.05 AS parallel_trends_holds, {rnd('c')} AS pre_trend_correlation FROM tp"""


@registry.add("parallel_trends_test", trends_sql(TREND_START))
def _(v):
    return did.parallel_trends_test(panel(v), "purchases", TREND_START)


@registry.add(
    "did_with_trends",
    f"""SELECT d.*, t.interaction_pvalue AS parallel_trends_pvalue
    FROM ({did_sql('purchases', True, TREND_START)}) d, ({trends_sql(TREND_START)}) t""",
)
def _(v):
    return did.did_with_trends(panel(v), "purchases", TREND_START, cluster="country")


def covariate_panel(v):
    coded, names = did.one_hot(rollout(v, v.users_e), ["device_os", "acquisition_channel"])
    return did.user_week_panel(v.events_e, coded, COUNTS, ("treated", "country", *names)), names


@registry.add("did_covariates")
def _(v):
    frame, names = covariate_panel(v)
    return did.estimate_did_with_covariates(frame, "purchases", START, names, cluster="country")


@registry.add("did_covariates_change")
def _(v):
    frame, names = covariate_panel(v)
    adjusted = did.estimate_did_with_covariates(frame, "purchases", START, names, cluster="country")
    return did.compare_estimates(did.estimate_did(frame, "purchases", START, cluster="country"), adjusted)


# Running variable: clicks in the first week of January. Outcome: a purchase in the last days.
def discontinuity(v):
    clicks = (
        v.events_e.where((F.col("event_type") == "click") & (F.col("timestamp") < F.lit("2024-01-08").cast("timestamp_ntz")))
        .groupBy("user_id")
        .agg(F.count("*").alias("clicks"))
    )
    late = v.events_e.where((F.col("event_type") == "purchase") & (F.col("timestamp") >= F.lit("2024-01-27").cast("timestamp_ntz")))
    return rdd.rdd_data(v.users_e, clicks, late, "clicks", 3)


RDD = """rd AS (SELECT u.user_id, coalesce(k.n, 0) AS running, coalesce(k.n, 0) - 3 AS centered, CASE WHEN coalesce(k.n, 0) >= 3 THEN 1 ELSE 0 END AS above,
    CASE WHEN u.user_id IN (SELECT user_id FROM events_e WHERE event_type = 'purchase' AND timestamp >= TIMESTAMP '2024-01-27') THEN 1 ELSE 0 END AS outcome
    FROM users_e u LEFT JOIN (SELECT user_id, count(*) AS n FROM events_e WHERE event_type = 'click' AND timestamp < TIMESTAMP '2024-01-08' GROUP BY user_id) k
    ON u.user_id = k.user_id)"""


@registry.add("rdd_data", f"WITH {RDD} SELECT user_id, running, centered, CAST(above AS BIGINT) AS above, CAST(outcome AS BIGINT) AS outcome FROM rd")
def _(v):
    return discontinuity(v)


@registry.add(
    "rdd_bins",
    f"""WITH {RDD} SELECT running, CAST(above AS BIGINT) AS above, {rnd('avg(outcome)')} AS mean_outcome, count(*) AS users FROM rd
    GROUP BY running, above HAVING count(*) >= 10""",
)
def _(v):
    return rdd.rdd_bins(discontinuity(v), 10)


@registry.add(
    "rdd_estimate",
    f"""WITH {RDD}, lo AS (SELECT above AS s, CAST(centered AS DOUBLE) AS x, CAST(outcome AS DOUBLE) AS y FROM rd WHERE centered BETWEEN -3 AND 3),
    li AS (SELECT s, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, avg(x) AS mx, regr_sxx(y, x) AS sxx, count(*) AS n FROM lo GROUP BY s),
    hv AS (SELECT power((1e0 / n - mx * (x - mx) / sxx) * (y - a - b * x), 2) AS h2 FROM lo JOIN li ON lo.s = li.s),
    es AS (SELECT (SELECT a FROM li WHERE s = 1) AS a1, (SELECT a FROM li WHERE s = 0) AS a0, (SELECT b FROM li WHERE s = 1) AS b1, (SELECT b FROM li WHERE s = 0) AS b0,
           sqrt(count(*) / (count(*) - 4e0) * sum(h2)) AS se, count(*) AS n FROM hv), zz AS (SELECT *, a1 - a0 AS e, (a1 - a0) / se AS z FROM es)
    SELECT {rnd('e')} AS effect, {rnd('se')} AS std_error, {rnd('z')} AS z_stat, {rnd(two_sided_p_sql('z'))} AS p_value, {rnd(f'e - {Z!r} * se')} AS ci_lower,
        {rnd(f'e + {Z!r} * se')} AS ci_upper, {rnd('a0')} AS left_intercept, {rnd('b0')} AS left_slope, {rnd('b1')} AS right_slope, n AS n_obs FROM zz""",
)
def _(v):
    return rdd.rdd_estimate(discontinuity(v))


def matching_data(v):
    return psm.psm_dataset(v.users_o, v.events_o, v.feature_usage_o, v.subscriptions_o, FEATURE, "F", "O")


DATASET = f"""{ENGAGEMENT}, ps AS (SELECT user_id,
    CASE WHEN user_id IN (SELECT user_id FROM feature_usage_o WHERE feature_name = '{FEATURE}') THEN 1 ELSE 0 END AS adopted,
    CASE WHEN user_id IN (SELECT user_id FROM subscriptions_o WHERE status = 'cancelled') THEN 1 ELSE 0 END AS churned,
    CASE WHEN plan_type <> 'free' THEN 1 ELSE 0 END AS plan_premium, n_features, total_events, total_scans, total_opens, active_days, total_usage FROM eng)"""


@registry.add(
    "psm_dataset",
    f"""WITH {DATASET} SELECT user_id, CAST(adopted AS BIGINT) AS adopted, CAST(churned AS BIGINT) AS churned, CAST(plan_premium AS BIGINT) AS plan_premium,
        n_features, total_events, total_scans, total_opens, active_days, total_usage FROM ps""",
)
def _(v):
    return matching_data(v)


@registry.add(
    "psm_arm_outcomes",
    f"WITH {DATASET} SELECT CAST(adopted AS BIGINT) AS adopted, count(*) AS users, {rnd('avg(churned)')} AS outcome_rate FROM ps GROUP BY adopted",
)
def _(v):
    return psm.arm_outcomes(matching_data(v), "adopted", "churned")


def balance_sql(source: str) -> str:
    parts = []
    for c in psm.MATCH_COVARIATES:
        parts.append(
            f"""SELECT '{c}' AS covariate, avg({c}) FILTER (WHERE adopted = 1) AS m1, avg({c}) FILTER (WHERE adopted = 0) AS m0,
            sqrt((var_samp({c}) FILTER (WHERE adopted = 1) + var_samp({c}) FILTER (WHERE adopted = 0)) / 2) AS sd FROM {source}"""
        )
    smd = "CASE WHEN sd > 0 THEN (m1 - m0) / sd ELSE 0 END"
    return f"""SELECT covariate, {rnd('m1')} AS mean_treated, {rnd('m0')} AS mean_control, {rnd(smd)} AS smd, abs({smd}) < 0.1 AS balanced
        FROM ({' UNION ALL '.join(parts)})"""


@registry.add("balance_smd", f"WITH {DATASET} {balance_sql('ps')}")
def _(v):
    return psm.balance(matching_data(v), "adopted", psm.MATCH_COVARIATES)


# Exact matching on one covariate: pairs are users of equal score and equal md5 order within it.
PAIRS = f"""{DATASET}, rk AS (SELECT *, row_number() OVER (PARTITION BY total_opens, adopted ORDER BY md5(CAST(user_id AS VARCHAR)), user_id) AS rn FROM ps),
    pairs AS (SELECT t.user_id AS treated_id, c.user_id AS control_id, t.churned AS y_t, c.churned AS y_c
              FROM rk t JOIN rk c ON t.total_opens = c.total_opens AND t.rn = c.rn WHERE t.adopted = 1 AND c.adopted = 0)"""


def exact_pairs(v):
    data = matching_data(v)
    return data, psm.match_pairs(data, "adopted", 0.0, score="total_opens")


@registry.add("psm_match_exact", f"WITH {PAIRS} SELECT treated_id, control_id, 0e0 AS distance FROM pairs")
def _(v):
    return exact_pairs(v)[1]


EFFECT = """ef AS (SELECT avg(y_t - y_c) AS att, stddev_samp(y_t - y_c) / sqrt(count(*)) AS se, count(*) AS n,
    (SELECT avg(churned) FILTER (WHERE adopted = 1) - avg(churned) FILTER (WHERE adopted = 0) FROM ps) AS naive,
    (SELECT count(*) FROM ps WHERE adopted = 1) AS treated FROM pairs), ez AS (SELECT *, att / se AS z FROM ef)"""


@registry.add(
    "psm_effect_exact",
    f"""WITH {PAIRS}, {EFFECT} SELECT {rnd('att')} AS att, {rnd('se')} AS std_error, {rnd('z')} AS t_stat, {rnd(two_sided_p_sql('z'))} AS p_value,
        {rnd(f'att - {Z!r} * se')} AS ci_lower, {rnd(f'att + {Z!r} * se')} AS ci_upper, n AS n_matched_pairs, treated - n AS n_unmatched_treated,
        {rnd('naive')} AS naive_difference, {rnd('naive - att')} AS bias_removed FROM ez""",
)
def _(v):
    data, pairs = exact_pairs(v)
    return psm.estimate_effect(pairs, data, "adopted", "churned")


BOUNDS = """dc AS (SELECT CAST(count(*) FILTER (WHERE y_t <> y_c) AS DOUBLE) AS d,
        CAST(greatest(count(*) FILTER (WHERE y_t > y_c), count(*) FILTER (WHERE y_t < y_c)) AS DOUBLE) AS f FROM pairs),
    ga AS (SELECT d, f, 1 + i / 10e0 AS gamma, (1 + i / 10e0) / (2 + i / 10e0) AS p FROM dc, range(21) g(i)),
    bz AS (SELECT *, (f - d * p) / sqrt(d * p * (1 - p)) AS z FROM ga)"""


@registry.add(
    "sensitivity_bounds",
    f"""WITH {PAIRS}, {BOUNDS} SELECT {rnd('gamma')} AS gamma, d AS discordant, f AS favour, {rnd(upper_tail_p_sql('z'))} AS p_value_upper,
        {upper_tail_p_sql('z')} < 0.05 AS significant_at_005 FROM bz""",
)
def _(v):
    data, pairs = exact_pairs(v)
    return psm.sensitivity_analysis(psm.estimate_effect(pairs, data, "adopted", "churned"))


@registry.add(
    "critical_gamma",
    f"WITH {PAIRS}, {BOUNDS} SELECT {rnd('min(gamma)')} AS critical_gamma FROM bz WHERE NOT {upper_tail_p_sql('z')} < 0.05",
)
def _(v):
    data, pairs = exact_pairs(v)
    return psm.critical_gamma(psm.sensitivity_analysis(psm.estimate_effect(pairs, data, "adopted", "churned")))


# Whole scores and a caliper of 1: after equal scores, neighbours match from the lowest score up.
FLOWS = f"""WITH {DATASET}, cell AS (SELECT total_opens AS s, count(*) FILTER (WHERE adopted = 1) AS t,
        count(*) FILTER (WHERE adopted = 0) AS c FROM ps GROUP BY total_opens)
    SELECT * FROM (WITH RECURSIVE chain AS (SELECT min(s) AS s, arg_min(t - c, s) AS open, CAST(0 AS BIGINT) AS flow, false AS below_treated FROM cell
        UNION ALL SELECT chain.s + 1, coalesce(t - c, 0) - sign(coalesce(t - c, 0)) * moved, moved, open > 0
        FROM chain LEFT JOIN cell ON cell.s = chain.s + 1,
             LATERAL (SELECT CASE WHEN open * coalesce(t - c, 0) < 0 THEN least(abs(open), abs(t - c)) ELSE 0 END AS moved) m
        WHERE chain.s < (SELECT max(s) FROM cell))
    SELECT s AS score_t, s AS score_c, least(t, c) AS pairs FROM cell WHERE least(t, c) > 0
    UNION ALL SELECT CASE WHEN below_treated THEN s - 1 ELSE s END, CASE WHEN below_treated THEN s ELSE s - 1 END, flow FROM chain WHERE flow > 0)"""


@registry.add("psm_match_caliper", FLOWS)
def _(v):
    data = matching_data(v)
    pairs = psm.match_pairs(data, "adopted", 1.0, score="total_opens")
    treated = data.select(F.col("user_id").alias("treated_id"), F.col("total_opens").alias("score_t"))
    control = data.select(F.col("user_id").alias("control_id"), F.col("total_opens").alias("score_c"))
    return pairs.join(treated, "treated_id").join(control, "control_id").groupBy("score_t", "score_c").agg(F.count("*").alias("pairs"))


def scored(v):
    # Small tables have kinds of users who all adopted, so the likelihood alone has no maximum there.
    return psm.propensity_scores(matching_data(v), "adopted", psm.MATCH_COVARIATES, penalty="firth")


@registry.add(
    "propensity_score_equations",
    " UNION ALL ".join(f"SELECT '{c}' AS coefficient, 0e0 AS excess" for c in ("constant", *psm.MATCH_COVARIATES)),
)
def _(v):
    data = matching_data(v)
    return psm.score_equations(data, "adopted", psm.fit_propensity(data, "adopted", psm.MATCH_COVARIATES, "firth"), "firth")


@registry.add("propensity_scores")
def _(v):
    return scored(v).select("user_id", "adopted", "propensity", "logit")


@registry.add("propensity_summary")
def _(v):
    return psm.score_summary(scored(v), "adopted")


@registry.add("propensity_overlap")
def _(v):
    from trailmark.operators.profile import histogram

    return histogram(scored(v), "propensity", 20, ["adopted"])


def matched(v):
    data = scored(v)
    return data, psm.match_pairs(data, "adopted", psm.caliper_width(data))


@registry.add("psm_match")
def _(v):
    return matched(v)[1]


@registry.add("psm_att")
def _(v):
    data, pairs = matched(v)
    return psm.estimate_effect(pairs, data, "adopted", "churned")


@registry.add("psm_balance_after")
def _(v):
    data, pairs = matched(v)
    return psm.balance(psm.matched_units(pairs, data), "adopted", psm.MATCH_COVARIATES)


# Matching on a score that both engines can compute: the account balance, told apart by the id, within 0.002 of its
# standard deviation. The check takes the nearest open pair, one a step.
CALIPER = 0.002
NEAREST = f"""{DATASET}, sc AS (SELECT ps.*, balance + ps.user_id / 1e9 AS score FROM ps JOIN users_o ON users_o.user_id = ps.user_id),
    cand AS (SELECT t.user_id AS t, c.user_id AS c, abs(t.score - c.score) AS d, least(t.score, c.score) AS low FROM sc t JOIN sc c
             ON t.adopted = 1 AND c.adopted = 0 AND abs(t.score - c.score) <= (SELECT {CALIPER!r} * stddev_samp(score) FROM sc)),
    pairs AS (SELECT k.t AS treated_id, k.c AS control_id, k.d AS distance, a.churned AS y_t, b.churned AS y_c FROM (
        WITH RECURSIVE pick AS (SELECT CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS t, CAST(NULL AS BIGINT) AS c, CAST(NULL AS DOUBLE) AS d
            UNION ALL SELECT list_concat(used, [x.t, x.c]), x.t, x.c, x.d FROM pick,
                LATERAL (SELECT t, c, d FROM cand WHERE NOT list_contains(used, t) AND NOT list_contains(used, c) ORDER BY d, low LIMIT 1) x)
        SELECT t, c, d FROM pick WHERE t IS NOT NULL) k JOIN ps a ON a.user_id = k.t JOIN ps b ON b.user_id = k.c)"""


def nearest(v):
    data = matching_data(v).join(v.users_o.select("user_id", "balance"), "user_id")
    data = data.withColumn("score", F.col("balance") + F.col("user_id") / F.lit(1e9))
    return data, psm.match_pairs(data, "adopted", psm.caliper_width(data, CALIPER, "score"), score="score")


@registry.add("psm_match_nearest", f"WITH {NEAREST} SELECT treated_id, control_id, {rnd('distance')} AS distance FROM pairs")
def _(v):
    return nearest(v)[1]


@registry.add(
    "psm_att_nearest",
    f"""WITH {NEAREST}, {EFFECT} SELECT {rnd('att')} AS att, {rnd('se')} AS std_error, {rnd('z')} AS t_stat, {rnd(two_sided_p_sql('z'))} AS p_value,
        {rnd(f'att - {Z!r} * se')} AS ci_lower, {rnd(f'att + {Z!r} * se')} AS ci_upper, n AS n_matched_pairs, treated - n AS n_unmatched_treated,
        {rnd('naive')} AS naive_difference, {rnd('naive - att')} AS bias_removed FROM ez""",
)
def _(v):
    data, pairs = nearest(v)
    return psm.estimate_effect(pairs, data, "adopted", "churned")


MATCHED = "matched AS (SELECT * FROM ps WHERE user_id IN (SELECT treated_id FROM pairs UNION ALL SELECT control_id FROM pairs))"


@registry.add("psm_balance_nearest", f"WITH {NEAREST}, {MATCHED} {balance_sql('matched')}")
def _(v):
    data, pairs = nearest(v)
    return psm.balance(psm.matched_units(pairs, data), "adopted", psm.MATCH_COVARIATES)
