"""Causal estimators against direct linear algebra and brute-force matching."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import did, psm, rdd
from trailmark.plans import nearest


def ols(x, y, groups=None):
    inv = np.linalg.inv(x.T @ x)
    b = inv @ x.T @ y
    e = y - x @ b
    n, k = x.shape
    if groups is None:
        meat, factor = (x * (e**2)[:, None]).T @ x, n / (n - k)
    else:
        s = np.array([(x[groups == g] * e[groups == g][:, None]).sum(0) for g in np.unique(groups)])
        meat, factor = s.T @ s, len(s) / (len(s) - 1) * (n - 1) / (n - k)
    return b, np.sqrt(np.diag(inv @ meat @ inv) * factor)


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    rows = []
    for u in range(120):
        country, t = f"c{u % 9}", int(u % 9 < 4)
        for w in range(6):
            y = 2 + 0.5 * t + 0.3 * w + (1.5 if t and w >= 3 else 0) + rng.normal()
            rows.append((u, f"2024-01-{1 + 7 * w:02d}" if w < 5 else "2024-02-05", t, country, float(y), float(rng.integers(0, 3))))
    return spark.createDataFrame(rows, "user_id int, week string, treated int, country string, y double, z double").withColumn("week", F.to_date("week")), rows


START = "2024-01-22"


def design(rows, extra=False):
    t = np.array([r[2] for r in rows], float)
    p = np.array([r[1] >= START for r in rows], float)
    cols = [np.ones(len(rows)), t, p, t * p] + ([np.array([r[5] for r in rows])] if extra else [])
    return np.column_stack(cols), np.array([r[4] for r in rows]), np.array([r[3] for r in rows])


@pytest.mark.parametrize("cluster", [None, "country"])
def test_did_equals_regression(panel, cluster):
    df, rows = panel
    x, y, g = design(rows)
    b, se = ols(x, y, g if cluster else None)
    r = did.estimate_did(df, "y", START, cluster=cluster).first()
    assert r["did_estimate"] == pytest.approx(b[3]) and r["std_error"] == pytest.approx(se[3])
    assert r["p_value"] == pytest.approx(math.erfc(abs(b[3] / se[3]) / math.sqrt(2)), rel=1e-6)
    assert r["pre_difference"] == pytest.approx(b[1]) and r["n_clusters"] == (9 if cluster else None)
    assert r["ci_lower"] < r["did_estimate"] < r["ci_upper"] and r["n_treatment"] + r["n_control"] == len(rows)


@pytest.mark.parametrize("cluster", [None, "country"])
def test_did_with_covariates_equals_regression(panel, cluster):
    df, rows = panel
    x, y, g = design(rows, True)
    b, se = ols(x, y, g if cluster else None)
    r = did.estimate_did_with_covariates(df, "y", START, ["z"], cluster=cluster).first()
    assert r["did_estimate"] == pytest.approx(b[3]) and r["std_error"] == pytest.approx(se[3])
    change = did.compare_estimates(did.estimate_did(df, "y", START), did.estimate_did_with_covariates(df, "y", START, ["z"])).first()
    assert change["stable"]


def test_parallel_trends_equals_regression(panel):
    df, rows = panel
    pre = [r for r in rows if r[1] < START]
    t = np.array([r[2] for r in pre], float)
    w = np.array([(np.datetime64(r[1]) - np.datetime64(START)).astype(int) / 7 for r in pre])
    x = np.column_stack([np.ones(len(pre)), w, t, w * t])
    y = np.array([r[4] for r in pre])
    inv = np.linalg.inv(x.T @ x)
    b = inv @ x.T @ y
    s2 = ((y - x @ b) ** 2).sum() / (len(pre) - 4)
    r = did.parallel_trends_test(df, "y", START).first()
    assert r["slope_difference"] == pytest.approx(b[3]) and r["std_error"] == pytest.approx(math.sqrt(s2 * inv[3, 3]))
    assert r["df"] == len(pre) - 4 and 0 <= r["interaction_pvalue"] <= 1


def test_one_hot_drops_the_first_level(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 1), (None, 3)], "os string, k int")
    coded, names = did.one_hot(df, ["os", "k"])
    assert names == ["os_b", "os_c", "k_2", "k_3"]
    assert sorted(tuple(r) for r in coded.select("os_b", "os_c").collect()) == [(0, 0), (0, 0), (0, 1), (1, 0)]
    given, names = did.one_hot(df, ["os"], {"os": ["b", "a", "z"]})
    assert names == ["os_b", "os_z"] and given.agg(F.sum("os_b"), F.sum("os_z")).first()[:] == (1, 0)


def test_errors_survive_a_far_outcome_and_few_clusters(panel):
    df, rows = panel
    x, y, g = design(rows)
    _, se = ols(x, y)
    far = df.withColumn("y", F.col("y") + 1e9)
    assert did.estimate_did(far, "y", START).first()["std_error"] == pytest.approx(se[3], rel=1e-5)
    one = df.withColumn("k", F.lit(1))
    lone = did.estimate_did_with_covariates(one, "y", START, ["z"], cluster="k").first()
    assert lone["did_estimate"] is not None and lone["std_error"] is None and lone["p_value"] is None
    both = did.did_with_trends(df, "y", START).first()
    assert both["parallel_trends_pvalue"] == did.parallel_trends_test(df, "y", START).first()["interaction_pvalue"]


def test_dense_panel_fills_quiet_weeks(spark):
    rows = [("u1", "2024-01-01", 1, "x", 4), ("u2", "2024-01-15", 0, "y", 2)]
    df = spark.createDataFrame(rows, "user_id string, week string, treated int, country string, n int").withColumn("week", F.to_date("week"))
    out = did.densify_panel(df, ["n"])
    assert out.count() == 6 and out.agg(F.sum("n")).first()[0] == 6


def test_rollout_groups(spark):
    a = spark.createDataFrame([("e", f"u{i}", "t" if i < 3 else "c", f"2024-01-{10 - i:02d}") for i in range(5)], "experiment_id string, user_id string, variant string, assigned_at string")
    u = spark.createDataFrame([(f"u{i}", "US" if i < 4 else "CA") for i in range(5)], "user_id string, country string")
    got = {r["country"]: (r["treatment_rate"], r["is_treatment"], r["treatment_start"]) for r in did.rollout_groups(did.rollout_users(a, u, "e", "t")).collect()}
    assert got == {"US": (0.75, True, "2024-01-06"), "CA": (0.0, False, "2024-01-06")}


def test_rdd_equals_regression(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, 800)
    y = (rng.random(800) < np.where(x >= 3, 0.35, 0.6) + 0.01 * x).astype(int)
    users = spark.createDataFrame([(i,) for i in range(800)], "user_id int")
    running = spark.createDataFrame([(i, int(v)) for i, v in enumerate(x) if v > 0], "user_id int, n int")
    hits = spark.createDataFrame([(i,) for i, v in enumerate(y) if v], "user_id int")
    data = rdd.rdd_data(users, running, hits, "n", 3)
    keep = np.abs(x - 3) <= 3
    c, above = (x - 3)[keep].astype(float), (x >= 3)[keep].astype(float)
    b, se = ols(np.column_stack([np.ones(keep.sum()), above, c, above * c]), y[keep].astype(float))
    r = rdd.rdd_estimate(data, 3).first()
    assert r["effect"] == pytest.approx(b[1]) and r["std_error"] == pytest.approx(se[1]) and r["n_obs"] == keep.sum()
    bins = rdd.rdd_bins(data, 50).collect()
    assert {b["running"] for b in bins} == {v for v in range(9) if (x == v).sum() >= 50}


def greedy(scores, arms, width):
    """Globally nearest pairs first; equal distances go to the lower scores."""
    cells = {}
    for s, a in zip(scores, arms):
        cells.setdefault(s, [0, 0])[a] += 1
    keys = sorted(cells)
    edges = sorted((abs(t - c), min(t, c), t, c) for t in keys for c in keys if abs(t - c) <= width)
    flows = {}
    for d, _, t, c in edges:
        n = min(cells[t][1], cells[c][0])
        if n:
            flows[(t, c)] = n
            cells[t][1] -= n
            cells[c][0] -= n
    return flows


def sample(kind, n, seed):
    rng = np.random.default_rng(seed)
    arms = (rng.random(n) < 0.4).astype(int)
    scores = {
        "spread": rng.normal(0, 1, n).round(6),
        "tied": rng.integers(0, 12, n) / 8.0,
        "grid": np.arange(n) / 16.0,  # every gap the same
        "hot": np.where(rng.random(n) < 0.4, 0.5, rng.normal(0, 1, n).round(3)),
        "widening": np.cumsum(1 + np.arange(n) / 50) / 32,
    }[kind]
    if kind == "widening":
        arms = np.arange(n) % 2
    return scores, arms


@pytest.mark.parametrize("kind", ["spread", "tied", "grid", "hot", "widening"])
@pytest.mark.parametrize("cells_per_task", [7, 10_000])
def test_matching_equals_global_greedy(spark, kind, cells_per_task):
    scores, arms = sample(kind, 150, 3)
    width = 0.3 if kind != "widening" else 5.0
    df = spark.createDataFrame([(i, float(s), int(a)) for i, (s, a) in enumerate(zip(scores, arms))], "user_id int, logit double, t int")
    pairs = psm.match_pairs(df, "t", width, cells_per_task=cells_per_task).collect()
    if cells_per_task == 7:  # ranges that know little of their neighbours need more rounds, with the same end
        cells = df.groupBy(F.col("logit").alias("score")).agg(F.count_if(F.col("t") == 1).alias("n_t"), F.count_if(F.col("t") == 0).alias("n_c"))
        wide, thin = (nearest.match_cells(cells, width, 7, halo) for halo in (64, 1))
        assert wide.exceptAll(thin).count() == thin.exceptAll(wide).count() == 0
    got = {}
    for p in pairs:
        assert arms[p["treated_id"]] == 1 and arms[p["control_id"]] == 0
        assert p["distance"] == pytest.approx(abs(scores[p["treated_id"]] - scores[p["control_id"]])) and p["distance"] <= width
        key = (float(scores[p["treated_id"]]), float(scores[p["control_id"]]))
        got[key] = got.get(key, 0) + 1
    ids = [p["treated_id"] for p in pairs] + [p["control_id"] for p in pairs]
    assert len(ids) == len(set(ids))
    want = {(float(t), float(c)): n for (t, c), n in greedy(scores.tolist(), arms.tolist(), width).items()}
    assert got == want


def test_two_treated_share_a_nearest_control(spark):
    df = spark.createDataFrame([("t1", 0.0, 1), ("t2", 0.3, 1), ("c1", 0.2, 0), ("c2", 0.9, 0), ("t3", 5.0, 1)], "user_id string, logit double, t int")
    got = {(p["treated_id"], p["control_id"]) for p in psm.match_pairs(df, "t", 1.0).collect()}
    assert got == {("t2", "c1"), ("t1", "c2")}
    close = {(p["treated_id"], p["control_id"]) for p in psm.match_pairs(df, "t", 0.2).collect()}
    assert close == {("t2", "c1")}  # t1 loses c1, c2 is out of reach
    assert psm.match_pairs(df.where("t = 1"), "t", 1.0).count() == 0


def test_large_cells_keep_every_pair(spark):
    df = spark.range(6000).select(F.col("id").alias("user_id"), F.lit(0.25).alias("logit"), (F.col("id") % 3 == 0).cast("int").alias("t"))
    df = df.unionByName(spark.range(10_000, 10_300).select(F.col("id").alias("user_id"), (0.25 + F.col("id") / 1e6).alias("logit"), F.lit(1).alias("t")))
    pairs = psm.match_pairs(df, "t", 1.0)
    r = pairs.agg(F.count("*").alias("n"), F.countDistinct("treated_id").alias("t"), F.countDistinct("control_id").alias("c")).first()
    assert (r["n"], r["t"], r["c"]) == (2300, 2300, 2300)


def test_propensity_matches_newton(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, [1, 30], (400, 2))
    t = (rng.random(400) < 1 / (1 + np.exp(-(0.4 + 0.8 * x[:, 0] - 0.02 * x[:, 1])))).astype(int)
    df = spark.createDataFrame([(i, int(t[i]), float(x[i, 0]), float(x[i, 1])) for i in range(400)], "user_id int, t int, a double, b double")
    d, w = np.column_stack([np.ones(400), x]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        w = w + np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d, d.T @ (t - p))
    scored = psm.propensity_scores(df, "t", ["a", "b"])
    got = np.array([r["logit"] for r in scored.orderBy("user_id").collect()])
    assert np.allclose(got, d @ w, atol=1e-3)
    assert psm.caliper_width(scored) == pytest.approx(0.2 * np.std(got, ddof=1))


def firth(d, t):
    """Coefficients of the likelihood with the Jeffreys prior, by its own score."""
    w = np.zeros(d.shape[1])
    for _ in range(500):
        p = 1 / (1 + np.exp(-d @ w))
        spread = np.linalg.inv((d * (p * (1 - p))[:, None]).T @ d)
        h = np.einsum("ij,jk,ik->i", d, spread, d) * p * (1 - p)
        w = w + spread @ (d.T @ (t - p + h * (0.5 - p)))
    return w


def test_separated_arms_raise_or_take_the_penalised_fit(spark):
    rng = np.random.default_rng(8)
    x, rare = rng.normal(0, 1, 600), np.arange(600) % 50 == 0
    t = ((rng.random(600) < 1 / (1 + np.exp(-x))) | rare).astype(int)  # the rare group is always treated
    df = spark.createDataFrame([(i, int(t[i]), float(x[i]), float(rare[i])) for i in range(600)], "user_id int, t int, a double, b double")
    with pytest.raises(psm.SeparationError, match="separate"):
        psm.propensity_scores(df, "t", ["a", "b"])
    runs = []
    for k in (1, 7, 200):
        scored = psm.propensity_scores(df.repartition(k), "t", ["a", "b"], penalty="firth")
        runs.append([(r["user_id"], r["logit"]) for r in scored.orderBy("user_id").collect()])
    assert runs[0] == runs[1] == runs[2]  # to the last bit
    d = np.column_stack([np.ones(600), x, rare])
    assert np.allclose([v for _, v in runs[0]], d @ firth(d, t), atol=1e-7)
    fit = psm.fit_propensity(df, "t", ["a", "b"], "firth")
    assert all(abs(r["excess"]) < 1e-8 for r in psm.score_equations(df, "t", fit, "firth").collect())
    pairs = [psm.match_pairs(psm.propensity_scores(df.repartition(k), "t", ["a", "b"], penalty="firth"), "t", 0.2) for k in (2, 5)]
    assert pairs[0].exceptAll(pairs[1]).count() == 0 and pairs[0].count() == pairs[1].count() > 0


def test_fits_with_useless_covariates_nulls_and_missing_arms(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, 300)
    t = (rng.random(300) < 1 / (1 + np.exp(-x))).astype(int)
    rows = [(i, int(t[i]), float(x[i]), 2 * float(x[i]) + 1, 7.0) for i in range(300)]
    df = spark.createDataFrame(rows + [(900, 1, None, 1.0, 7.0), (901, None, 1.0, 3.0, 7.0), (902, 0, float("nan"), 1.0, 7.0)], "id int, t int, a double, twice double, same double")
    alone = psm.fit_propensity(df, "t", ["a"])
    fit = psm.fit_propensity(df, "t", ["same", "a", "twice"])
    assert fit.weights[1] == fit.weights[3] == 0.0 and fit.weights[2] == pytest.approx(alone.weights[1], rel=1e-9)
    scored = {r["id"]: r["logit"] for r in psm.propensity_scores(df, "t", ["a"]).collect()}
    assert scored[900] is None and scored[901] is not None and math.isnan(scored[902])
    assert psm.match_pairs(psm.propensity_scores(df, "t", ["a"]), "t", 5.0, id_column="id").where("treated_id in (900, 902) or control_id in (900, 902)").count() == 0
    for one_arm in (df.where("t = 1"), df.limit(0)):
        with pytest.raises(ValueError, match="both arms"):
            psm.propensity_scores(one_arm, "t", ["a"])


def test_settle_takes_only_what_no_unknown_cell_can_spoil():
    score, arm, one = [0.0, 1.0, 3.0], [1, 0, 1], [1, 1, 1]
    assert nearest.settle(score, arm, one, 5.0)[0] == [(0, 1, 1)]
    assert nearest.settle(score, arm, one, 5.0, low=(-0.5, -math.inf))[0] == []  # a control nearer to the first
    assert nearest.settle(score, arm, one, 5.0, low=(-1.0, -math.inf))[0] == []  # as near, and lower: it goes first
    assert nearest.settle(score, arm, one, 5.0, high=(3.5, math.inf))[0] == [(0, 1, 1)]
    chain = np.cumsum(np.linspace(2, 1, 20_000))  # gaps shrink to the right: one pair settles after the other
    flows, _ = nearest.settle(chain.tolist(), [i % 2 for i in range(20_000)], [1] * 20_000, 3.0)
    assert len(flows) == 10_000


def test_effect_balance_and_bounds(spark):
    rows = [(f"t{i}", 1, float(i < 6), float(i)) for i in range(20)] + [(f"c{i}", 0, float(i < 14), float(i) + 1) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id string, t int, y double, x double")
    pairs = spark.createDataFrame([(f"t{i}", f"c{i}", 0.0) for i in range(20)], "treated_id string, control_id string, distance double")
    diff = np.array([float(i < 6) - float(i < 14) for i in range(20)])
    r = psm.estimate_effect(pairs, df, "t", "y").first()
    assert r["att"] == pytest.approx(diff.mean()) and r["std_error"] == pytest.approx(diff.std(ddof=1) / math.sqrt(20))
    assert r["naive_difference"] == pytest.approx(-0.4) and r["n_unmatched_treated"] == 0
    b = psm.balance(df, "t", ["x"]).first()
    sd = math.sqrt(np.var(range(20), ddof=1))
    assert b["smd"] == pytest.approx(-1 / sd, abs=1e-6) and not b["balanced"]
    bounds = psm.sensitivity_analysis(psm.estimate_effect(pairs, df, "t", "y")).orderBy("gamma").collect()
    assert (bounds[0]["gamma"], bounds[0]["discordant"], bounds[0]["favour"]) == (1.0, 8.0, 8.0)
    z = (8 - 4) / math.sqrt(8 * 0.25)
    assert bounds[0]["p_value_upper"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-6)
    ps = [x["p_value_upper"] for x in bounds]
    assert ps == sorted(ps)
    critical = psm.critical_gamma(psm.sensitivity_analysis(psm.estimate_effect(pairs, df, "t", "y"))).first()[0]
    assert critical == min((x["gamma"] for x in bounds if not x["significant_at_005"]), default=None)
