"""Distribution functions and experiment statistics against independent computations."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailmark.functions import normal, ranksum, student
from trailmark.operators import bootstrap as bs
from trailmark.operators import experiment as ex
from trailmark.operators import power as pw


def test_normal_tail_matches_erfc(spark):
    zs = [0.0, 0.3, -1.0, 1.96, 3.5, 7.07, 7.08, 9.0, 12.0, 30.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    rows = df.select("z", normal.two_sided_p("z").alias("p"), normal.upper_tail_p("z").alias("q")).collect()
    for r in rows:
        assert r["p"] == pytest.approx(math.erfc(abs(r["z"]) / math.sqrt(2)), rel=1e-7)
        assert r["q"] == pytest.approx(0.5 * math.erfc(r["z"] / math.sqrt(2)), rel=1e-7)
    assert spark.range(1).select(normal.two_sided_p("CAST(NULL AS DOUBLE)")).first()[0] is None


@settings(max_examples=60, deadline=None)
@given(st.floats(0.01, 8), st.floats(1, 300))
def test_t_quantile_inverts_tail(t, df):
    p = student.t_two_sided(t, df)
    assert student.t_quantile(p, df) == pytest.approx(t, rel=1e-5)


def test_t_tail_known_values():
    assert student.t_two_sided(1.0, 1) == pytest.approx(0.5, abs=1e-12)  # Cauchy
    assert student.t_two_sided(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6), abs=1e-12)
    assert student.t_two_sided(1.96, 1e7) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-5)


@pytest.mark.parametrize("df", [1e4, 1e7, 1e11, 1e13, 1e15])
@pytest.mark.parametrize("t", [0.0, 0.5, 1.96, 6.0])
def test_t_tail_keeps_its_digits_at_many_degrees_of_freedom(t, df):
    # Fisher's expansion around the normal tail, to the second order in 1 / df.
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    first, second = t * (t**2 + 1) / 4, t * (3 * t**6 - 7 * t**4 - 5 * t**2 - 3) / 96
    want = math.erfc(t / math.sqrt(2)) + 2 * density * (first / df + second / df**2)
    assert student.t_two_sided(t, df) == pytest.approx(want, rel=1e-6 if t > 5 else 1e-9)
    assert student.t_two_sided(t, 9_999.0) == pytest.approx(student.t_two_sided(t, 10_000.0), rel=1e-3)


def test_u_distribution_equals_enumeration_and_keeps_large_tails():
    import itertools

    for m, n in ((1, 4), (3, 5), (4, 4)):
        us = [sum(b - i for i, b in enumerate(c)) for c in itertools.combinations(range(m + n), m)]
        want = np.bincount(us, minlength=m * n + 1) / len(us)
        assert ranksum.u_distribution(m, n).tolist() == pytest.approx(want.tolist())
    assert ranksum.exact_two_sided(0, 8, 20_000) == pytest.approx(2 / math.comb(20_008, 8))
    assert ranksum.exact_two_sided(80_000, 8, 20_000) == 1.0  # the middle of the range
    assert ranksum.u_distribution(8, 500).sum() == pytest.approx(1.0, abs=1e-9)


def arms(spark, control, treatment, experiment="e"):
    rows = [(experiment, f"c{i}", "control", float(x)) for i, x in enumerate(control)]
    rows += [(experiment, f"t{i}", "treatment", float(x)) for i, x in enumerate(treatment)]
    return spark.createDataFrame(rows, "experiment_id string, user_id string, arm string, value double")


def totals(spark, cc, nc, ct, nt):
    return spark.createDataFrame(
        [("e", nc, float(cc), nt, float(ct))], "experiment_id string, n_c bigint, total_c double, n_t bigint, total_t double"
    )


def test_proportion_test_by_hand(spark):
    df = totals(spark, 45, 100, 60, 100)
    r = ex.proportion_test(df).first()
    pooled, lift = 105 / 200, 0.15
    z = lift / math.sqrt(pooled * (1 - pooled) * 2 / 100)
    half = 1.959963984540054 * math.sqrt(0.45 * 0.55 / 100 + 0.6 * 0.4 / 100)
    assert r["statistic"] == round(z, 4) and r["relative_lift"] == 0.3333
    assert r["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-7)
    assert (r["ci_lower"], r["ci_upper"]) == (round(lift - half, 6), round(lift + half, 6))
    chi = ex.proportion_test(df, test_type="chi_square").first()
    assert chi["statistic"] == pytest.approx(z * z, abs=1e-4) and chi["p_value"] == pytest.approx(r["p_value"], rel=1e-9)


def test_proportion_edges(spark):
    same = ex.proportion_test(totals(spark, 0, 10, 0, 20)).first()
    assert same["statistic"] == 0 and same["p_value"] == 1.0 and same["relative_lift"] == math.inf
    empty = ex.proportion_test(totals(spark, 3, 10, 0, 0)).first()
    assert empty["p_value"] is None and empty["significant"] is None
    tiny = ex.proportion_test(totals(spark, 0, 100000, 50000, 100000)).first()
    assert 0 <= tiny["p_value"] < 1e-100
    with pytest.raises(ValueError):
        ex.proportion_test(totals(spark, 1, 2, 1, 2), test_type="exact")


def test_srm(spark):
    df = spark.createDataFrame([("a", 5000, 5000), ("b", 5300, 4700), ("c", 10, 0)], "e string, n_control bigint, n_treatment bigint")
    rows = {r["e"]: r for r in ex.check_srm(df).collect()}
    assert not rows["a"]["srm_detected"] and rows["a"]["srm_p_value"] == 1.0
    assert rows["b"]["srm_detected"] and rows["b"]["chi2_statistic"] == 36.0
    assert rows["c"]["srm_detected"] is None


def test_means_tests_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(10, 2, 40), rng.normal(11, 4, 55)
    df = arms(spark, a, b)
    va, vb = a.var(ddof=1) / 40, b.var(ddof=1) / 55
    dof = (va + vb) ** 2 / (va**2 / 39 + vb**2 / 54)
    t = (b.mean() - a.mean()) / math.sqrt(va + vb)
    r = ex.means_test(df).first()
    assert r["statistic"] == round(t, 4) and r["df"] == pytest.approx(dof)
    assert r["p_value"] == pytest.approx(student.t_two_sided(t, dof))
    half = student.t_quantile(0.05, dof) * math.sqrt(va + vb)
    assert r["ci_lower"] == pytest.approx(b.mean() - a.mean() - half, abs=1e-6)
    s = ex.means_test(df, test_type="student").first()
    assert s["df"] == 93 and s["ci_lower"] == r["ci_lower"]
    with pytest.raises(ValueError):
        ex.means_test(df, test_type="sign")


@pytest.mark.parametrize("kind", ["welch", "student", "mann_whitney"])
def test_means_tests_keep_experiments_with_small_arms(spark, kind):
    df = arms(spark, [1.0, 2.0, 4.0], [2.0, 5.0]).unionByName(arms(spark, [1.0, 2.0], [], "empty"))
    rows = {r["experiment_id"]: r for r in ex.means_test(df, test_type=kind).collect()}
    assert rows["e"]["p_value"] is not None and rows["empty"]["n_treatment"] == 0
    assert rows["empty"]["p_value"] is None and rows["empty"]["significant"] is None and rows["empty"]["df"] is None


def test_metrics_are_not_averaged_together(spark):
    a = spark.createDataFrame([("e", "u", "control")], ASSIGN)
    m = spark.createDataFrame([("e", "u", "x", 1.0), ("e", "u", "y", 100.0)], METRIC)
    assert {r["metric_name"]: r["rate"] for r in ex.metric_rates(a, m).collect()} == {"x": 1.0, "y": 100.0}


def brute_u(control, treatment):
    return sum((t > c) + 0.5 * (t == c) for t in treatment for c in control)


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_rank_sum_with_heavy_ties(spark, buckets):
    rnd = random.Random(buckets)
    c, t = [rnd.randint(0, 6) for _ in range(80)], [rnd.randint(1, 8) for _ in range(60)]
    r = ex.rank_sum(arms(spark, c, t), buckets=buckets).first()
    u, n = brute_u(c, t), 140
    ties = sum(k**3 - k for k in np.unique(c + t, return_counts=True)[1])
    z = (max(u, 4800 - u) - 2400 - 0.5) / math.sqrt(4800 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert r["u_statistic"] == u
    assert r["p_value"] == pytest.approx(math.erfc(max(z, 0) / math.sqrt(2)), rel=1e-6)


def test_rank_sum_small_arms_are_exact(spark):
    r = ex.rank_sum(arms(spark, [1.0, 2.0, 3.0], [4.0, 5.0, 6.0, 7.0])).first()
    assert r["u_statistic"] == 12 and r["p_value"] == pytest.approx(2 / 35)
    one = ex.rank_sum(arms(spark, [5.0], list(range(10, 19)))).first()
    assert one["p_value"] == pytest.approx(0.2)
    assert ranksum.u_distribution(2, 2).tolist() == pytest.approx([1 / 6, 1 / 6, 2 / 6, 1 / 6, 1 / 6])


def test_multiple_testing_with_ties(spark):
    ps = [0.01, 0.02, 0.02, 0.04, 0.5]
    df = spark.createDataFrame([(f"m{i}", p) for i, p in enumerate(ps)], "metric string, p_value double")
    rows = {r["metric"]: r for r in ex.correct_multiple_tests(df).collect()}
    assert [round(rows[f"m{i}"]["p_value_bh"], 10) for i in range(5)] == [0.05, 0.05, 0.05, 0.05, 0.5]
    assert [rows[f"m{i}"]["significant_bh"] for i in range(5)] == [True, True, True, True, False]
    assert [round(rows[f"m{i}"]["p_value_bonferroni"], 10) for i in range(5)] == [0.05, 0.1, 0.1, 0.2, 1.0]
    assert not any(rows[f"m{i}"]["significant_bonferroni"] for i in range(5))
    only = ex.correct_multiple_tests(df, method="bonferroni")
    assert "p_value_bh" not in only.columns
    with pytest.raises(ValueError):
        ex.correct_multiple_tests(df, method="holm")


def test_sample_size_by_hand(spark):
    df = spark.createDataFrame([(0.30, 0.10)], "baseline_rate double, mde double")
    r = pw.compute_sample_size(df).first()
    za, zb, p1, p2 = 1.959963984540054, 0.8416212335729143, 0.30, 0.33
    pool = (p1 + p2) / 2
    n = math.ceil((za * math.sqrt(2 * pool * (1 - pool)) + zb * math.sqrt(p1 * (1 - p1) + p2 * (1 - p2))) ** 2 / 0.03**2)
    assert (r["n_control"], r["n_treatment"], r["n_total"]) == (n, n, 2 * n)
    double = pw.compute_sample_size(df, ratio=2.0).first()
    assert double["n_treatment"] == 2 * double["n_control"] and double["n_control"] < n
    assert pw.compute_sample_size(df, two_sided=False).first()["n_control"] < n


def test_power_curve_grid(spark):
    rows = pw.power_curve(pw.one_baseline(spark, 0.3)).collect()
    assert len(rows) == 45 and {r["mde"] for r in rows} == {k / 100 for k in range(2, 31, 2)}
    at10 = {r["power"]: r["n_per_variant"] for r in rows if r["mde"] == 0.10}
    assert at10[0.7] < at10[0.8] < at10[0.9]


ASSIGN = "experiment_id string, user_id string, variant string"
METRIC = "experiment_id string, user_id string, metric_name string, metric_value double"


def labelled(spark):
    assignments = [("exp_001", f"u{i}", "control" if i % 2 else "treatment") for i in range(40)]
    assignments += [("exp_003", f"u{i}", "day_7_upsell" if i % 2 else "day_3_upsell") for i in range(40)]
    metrics = [("exp_001", f"u{i}", "activated", 1.0) for i in range(0, 40, 2)]
    metrics += [("exp_003", "u1", "converted_to_premium", 1.0)] * 2
    return spark.createDataFrame(assignments, ASSIGN), spark.createDataFrame(metrics, METRIC)


def test_labels_missing_data_and_unknown_metric(spark):
    a, m = labelled(spark)
    known = {k: ex.EXPERIMENTS[k] for k in ("exp_001", "exp_003", "exp_004")}
    config = ex.experiment_config(spark, known)
    rows = {r["experiment_id"]: r for r in ex.summarize_all_experiments(a, m, config).collect()}
    assert rows["exp_001"]["decision"] == "SHIP" and rows["exp_004"]["decision"] == "SKIP"
    assert rows["exp_004"]["p_value"] is None
    values = ex.arm_values(a, m, config).where("experiment_id = 'exp_003' and user_id = 'u1'").collect()
    assert len(values) == 1 and values[0]["value"] == 2.0  # two metric rows are summed, not joined twice
    wrong = ex.experiment_config(spark, {"exp_001": {**ex.EXPERIMENTS["exp_001"], "primary_metric": "help_viewed"}})
    for query in (ex.summarize_all_experiments, ex.power_audit, ex.analyze_experiments, ex.arm_values):
        with pytest.raises(Exception, match="help_viewed"):
            query(a, m, wrong).collect()
    assert ex.arm_values(a, m, wrong, validate=False).count() == 40
    unlabelled = ex.experiment_config(spark, {"exp_003": {**ex.EXPERIMENTS["exp_003"], "control_label": "control", "treatment_label": "treatment"}})
    assert ex.summarize_all_experiments(a, m, unlabelled).first()["decision"] == "NO DATA"
    for kind in ("proportion", "continuous"):
        lone = ex.analyze_experiments(a.where("variant != 'treatment'"), m, config.where("experiment_id = 'exp_001'"), kind).collect()
        assert [r["decision"] for r in lone] == ["NO DATA"]


def test_direction_override(spark):
    srm, sig = F.lit(False), F.lit(True)
    out = spark.range(1).select(
        ex.decide(srm, sig, F.lit(-0.2)).alias("plain"), ex.decide(srm, sig, F.lit(-0.2), F.lit("decrease")).alias("business"),
        ex.decide(F.lit(True), sig, F.lit(0.2)).alias("srm"),
    ).first()
    assert (out["plain"], out["business"], out["srm"]) == ("DO NOT SHIP", "SHIP", "INVALID")


def test_analysis_carries_nested_results(spark):
    a, m = labelled(spark)
    config = ex.experiment_config(spark, {"exp_001": ex.EXPERIMENTS["exp_001"]})
    boot = bs.bootstrap_ci(ex.arm_values(a, m, config), n_bootstrap=200)
    r = ex.analyze_experiments(a, m, config, bootstrap=boot).first()
    assert r["srm_check"]["n_control"] == 20 and r["primary_test"]["treatment_rate"] == 1.0 and r["bootstrap"]["n_bootstrap"] == 200
    agreement = ex.method_agreement(ex.analyze_experiments(a, m, config, bootstrap=boot)).first()
    assert agreement["all_agree"]
    c = ex.analyze_experiments(a, m, config, metric_type="continuous").first()
    assert c["primary_test"]["test_type"] == "welch"


def test_histogram_bootstrap_is_seeded_and_right(spark):
    df = arms(spark, [1] * 400 + [0] * 600, [1] * 500 + [0] * 500)
    first = bs.bootstrap_ci(df, n_bootstrap=4000, method="histogram").first()
    assert first == bs.bootstrap_ci(df.repartition(7), n_bootstrap=4000, method="histogram", chunks=3).first()
    assert first != bs.bootstrap_ci(df, n_bootstrap=4000, method="histogram", seed=7).first()
    sd = math.sqrt(0.24 / 1000 + 0.25 / 1000)
    assert first["observed_diff"] == 0.1 and first["n_bootstrap"] == 4000
    assert first["bootstrap_std"] == pytest.approx(sd, rel=0.05) and first["significant"]
    assert 0.4 < first["p_value_bootstrap"] < 0.6 and first["p_value_centered"] < 0.01


def test_poisson_bootstrap_spread_and_partitioning(spark):
    rng = np.random.default_rng(3)
    df = arms(spark, rng.exponential(5, 800), rng.exponential(6, 700))
    r = bs.bootstrap_ci(df, n_bootstrap=400, method="poisson").first()
    x = bs.bootstrap_ci(df.repartition(5), n_bootstrap=400, method="poisson").first()
    assert r["ci_lower"] == pytest.approx(x["ci_lower"], abs=1e-9) and r["n_bootstrap"] == 400
    var = df.groupBy("arm").agg(F.var_pop("value").alias("v"), F.count("*").alias("n")).collect()
    assert r["bootstrap_std"] == pytest.approx(math.sqrt(sum(v["v"] / v["n"] for v in var)), rel=0.15)


@pytest.mark.parametrize("sizes", [(301, 250), (300, 251)])
def test_order_statistic_bootstrap_matches_resampling(spark, sizes):
    rng = np.random.default_rng(5)
    c, t = rng.normal(0, 1, sizes[0]), rng.normal(0.5, 1, sizes[1])
    r = bs.bootstrap_ci(arms(spark, c, t), metric="median", n_bootstrap=4000, method="order_statistic").first()
    plain = [np.median(rng.choice(t, len(t))) - np.median(rng.choice(c, len(c))) for _ in range(4000)]
    assert r["observed_diff"] == pytest.approx(np.median(t) - np.median(c), abs=1e-6)
    assert r["bootstrap_std"] == pytest.approx(np.std(plain), rel=0.1)
    assert r["ci_lower"] == pytest.approx(np.percentile(plain, 2.5), abs=0.05)


def test_bootstrap_metrics_and_choice(spark):
    df = arms(spark, [1, 2, 3, 4], [2, 3, 5, 9])
    assert [bs.default_method(m) for m in ("mean", "median", 0.9, np.max)] == ["poisson", "order_statistic", "order_statistic", "histogram"]
    two = df.unionByName(arms(spark, [1, 2, 3, 4], [2, 3, 5, 9], "other"))
    draws = bs.bootstrap_replicates(two, n_bootstrap=20).groupBy("replicate").agg(F.countDistinct("diff").alias("n")).collect()
    assert max(r["n"] for r in draws) == 2  # experiments draw their own weights
    callable_diff = bs.bootstrap_ci(df, metric=lambda x: float(np.max(x)), n_bootstrap=50).first()
    assert callable_diff["observed_diff"] == 5.0
    median = bs.bootstrap_ci(df, metric="median", n_bootstrap=50).first()
    assert median["observed_diff"] == 1.5
    with pytest.raises(ValueError):
        bs.bootstrap_ci(df, metric="median", method="poisson")
    lonely = arms(spark, [1, 2], []).where("arm = 'control'")
    for method, metric in (("histogram", "mean"), ("poisson", "mean"), ("order_statistic", "median")):
        assert bs.bootstrap_ci(lonely, metric=metric, method=method, n_bootstrap=20).count() == 0


def brute_weights(seed, key, user, b):
    """The weights of one user, one draw after the other in whole numbers."""
    digest, out, limits = hashlib.md5(f"{seed}|{key}|{user}".encode()).hexdigest(), [], bs.poisson_thresholds()
    first, second = int(digest[:8], 16), int(digest[8:16], 16)

    def mix(x):
        for shift, factor in bs.MIX:
            x = ((x ^ x >> shift) * factor) % 2**32
        return x

    for r in range(b):
        y = mix((first + (r + 1) * bs.STEP) % 2**32)
        high = mix((y + second) % 2**32)
        draw = high << 21 | mix((high + y) % 2**32) >> 11
        out.append(sum(draw >= t for t in limits))
    return out


def test_poisson_weights_are_those_of_the_distribution():
    limits = np.array(bs.poisson_thresholds(), dtype=np.uint64)
    assert len(limits) > 16 and limits[0] / 2**53 == pytest.approx(math.exp(-1), abs=1e-15)
    draw, rng = bs._weights(limits), np.random.default_rng(0)
    first, second = (rng.integers(0, 2**32, 2_000, dtype=np.uint32) for _ in range(2))
    w = draw(first, second, np.arange(5_000))
    share = np.bincount(w.ravel(), minlength=8)[:8] / w.size
    assert np.allclose(share, [math.exp(-1) / math.factorial(k) for k in range(8)], atol=5e-4)
    mean = w.mean(axis=0)  # neither replicates nor users lean on each other
    assert mean.var() * 2_000 == pytest.approx(1, abs=0.1) and abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.1
    assert w.mean(axis=1).var() * 5_000 == pytest.approx(1, abs=0.15)
    near = draw(first[:1].repeat(200), np.arange(200, dtype=np.uint32), np.arange(500))  # users whose words differ by little
    assert np.abs(np.corrcoef(near) - np.eye(200)).max() < 0.3


def test_an_aggregate_of_ones_own_equals_rebuilt_samples(spark):
    rng = np.random.default_rng(12)
    c, t, b = rng.exponential(2, 130), rng.exponential(3, 90), 2_300
    df = arms(spark, c, t).repartition(6)
    product = bs.Aggregate(  # the geometric mean of 1 + x, with a dict as state
        start=lambda n: {"n": np.zeros(n), "log": np.zeros(n)},
        add=lambda s, x, w: {"n": s["n"] + w.sum(axis=0), "log": s["log"] + np.log1p(x) @ w},
        merge=lambda p, q: {k: p[k] + q[k] for k in p},
        finish=lambda s: np.exp(s["log"] / np.where(s["n"] > 0, s["n"], np.nan)),
    )
    got = {r["replicate"]: r["diff"] for r in bs.bootstrap_replicates(df, metric=product, n_bootstrap=b).collect()}
    assert len(got) == b + 1
    rows = df.collect()
    key = rows[0]["experiment_id"]
    weights = {(r["arm"], r["user_id"]): (r["value"], brute_weights(42, key, r["user_id"], 40)) for r in rows}
    for r in (0, 7, 39):
        sample = {a: np.concatenate([np.full(w[r], v) for (arm, _), (v, w) in weights.items() if arm == a]) for a in ("control", "treatment")}
        want = [np.exp(np.log1p(sample[a]).mean()) for a in ("treatment", "control")]
        assert got[r] == pytest.approx(want[0] - want[1], rel=1e-9)
    assert got[-1] == pytest.approx(np.exp(np.log1p(t).mean()) - np.exp(np.log1p(c).mean()), rel=1e-9)
    with pytest.raises(ValueError, match="aggregate"):
        bs.bootstrap_ci(df, metric=product, method="histogram")


def test_what_a_partition_passes_on_does_not_grow_with_its_users(spark):
    few, many = (arms(spark, np.arange(n) % 7, np.arange(n) % 5).coalesce(1) for n in (10, 3_000))
    counted = []
    for df in (few, many):
        plan = bs.bootstrap_replicates(df, n_bootstrap=1_500)
        plan.collect()
        counted.append(plan.count())
    assert counted == [1_501, 1_501]


def test_many_experiments_in_one_partition(spark):
    rows = [(f"e{i}", f"u{j}", "control" if j % 2 else "treatment", float(i * j % 11)) for i in range(150) for j in range(6)]
    df = spark.createDataFrame(rows, "experiment_id string, user_id string, arm string, value double").coalesce(1)
    out = bs.bootstrap_replicates(df, n_bootstrap=10)
    spread = bs.bootstrap_replicates(df.repartition(9), n_bootstrap=10)
    one, other = ({(r["experiment_id"], r["replicate"]): r["diff"] for r in x.collect()} for x in (out, spread))
    assert one.keys() == other.keys() and all(one[k] == pytest.approx(other[k], abs=1e-12) for k in one)
    assert sum(k[1] == -1 for k in one) == 150


def test_bootstrap_distribution_counts_every_replicate(spark):
    df = arms(spark, [0, 1] * 50, [0, 1, 1] * 30)
    replicates = bs.bootstrap_replicates(df, n_bootstrap=500)
    assert bs.bootstrap_distribution(replicates).agg(F.sum("count")).first()[0] == 500


def test_variant_assignment_is_stable_and_proportional(spark):
    users = spark.range(20000).select(F.col("id").alias("user_id"), F.lit("2024-03-05").alias("signup_date"))
    out = ex.assign_variants(users, "e", ["a", "b", "c"], [0.2, 0.3, 0.5], "2024-03-01", "2024-03-31")
    counts = {r["variant"]: r["count"] for r in out.groupBy("variant").count().collect()}
    assert counts["a"] == pytest.approx(4000, rel=0.06) and counts["b"] == pytest.approx(6000, rel=0.06)
    again = ex.assign_variants(users.repartition(9), "e", ["a", "b", "c"], [0.2, 0.3, 0.5], "2024-03-01", "2024-03-31")
    assert out.exceptAll(again).count() == 0
    assert ex.assign_variants(users, "e", ["a", "b"], [0.5, 0.5], "2024-04-01", "2024-05-01").count() == 0
