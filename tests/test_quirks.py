"""Hand-made cases, one per decision about edge semantics."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from trailmark.operators import cohort as co
from trailmark.operators import engagement as en
from trailmark.operators import experiment as ex
from trailmark.operators import funnel as fn
from trailmark.operators import profile as pf
from trailmark.operators import revenue as rv
from trailmark.sources.catalog import filter_events

STEPS = [("One", "a"), ("Two", "b"), ("Three", "c")]
EVENTS = "event_id bigint, user_id string, timestamp timestamp_ntz, event_type string, session_id string"


def ts(text):
    return datetime.fromisoformat(text)


def events(spark, rows):
    """rows: (user, time, type[, session])"""
    return spark.createDataFrame(
        [(i, r[0], ts(r[1]), r[2], r[3] if len(r) > 3 else "s") for i, r in enumerate(rows)], EVENTS
    )


def users(spark, rows, columns="user_id string, country string, acquisition_channel string"):
    return spark.createDataFrame(rows, columns)


def as_rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


FUNNEL = [
    ("u1", "2024-01-01 10:00:00", "a"), ("u1", "2024-01-01 09:00:00", "b"), ("u1", "2024-01-01 11:00:00", "c"),
    ("u2", "2024-01-01 10:00:00", "a"), ("u2", "2024-01-01 10:30:00", "c"),
    ("u3", "2024-01-01 10:00:00", "b"),
    ("u4", "2024-01-01 10:00:00", "a"), ("u4", "2024-01-01 10:05:00", "b"), ("u4", "2024-01-01 10:06:00", "c"),
    (None, "2024-01-01 10:00:00", "a"),
]


def test_funnel_steps_are_sets_relative_to_the_first(spark):
    df, names = fn.calculate_funnel(events(spark, FUNNEL), STEPS)
    r = df.first()
    assert (r["step_0_users"], r["step_1_users"], r["step_2_users"]) == (3, 2, 3)  # u3 never did step 0
    assert r["step_1_to_2_incremental"] == 150.0 and r["step_0_to_1_rate"] == 66.67
    assert names == {"step_0_users": "One", "step_1_users": "Two", "step_2_users": "Three"}
    checks = {c["stage"]: c for c in fn.funnel_validity(df, STEPS).collect()}
    assert checks["step_0_to_1"]["not_rising"] and not checks["step_1_to_2"]["incremental_ok"]


def test_funnel_unknown_users_form_a_null_segment(spark):
    u = users(spark, [("u1", "US", "x"), ("u2", "US", "x")])
    df, _ = fn.calculate_funnel(events(spark, FUNNEL), STEPS, u, "country")
    got = {r["country"]: r["step_0_users"] for r in df.collect()}
    assert got == {"US": 2, None: 1}


def test_empty_funnel_has_one_row_without_rates(spark):
    df, _ = fn.calculate_funnel(events(spark, FUNNEL), STEPS, date_range=("2030-01-01", "2030-01-02"))
    assert [tuple(r) for r in df.collect()] == [(0, 0, 0, None, None, None, None)]
    by, _ = fn.calculate_funnel(
        events(spark, FUNNEL), STEPS, users(spark, [("u1", "US", "x")]), "country", ("2030-01-01", "2030-01-02")
    )
    assert by.count() == 0


def test_ordered_funnel_needs_order_and_session(spark):
    rows = FUNNEL + [
        ("u5", "2024-01-01 10:00:00", "a", "s1"), ("u5", "2024-01-01 10:01:00", "b", "s2"), ("u5", "2024-01-01 10:02:00", "c", "s1"),
        ("u6", "2024-01-01 10:00:00", "a"), ("u6", "2024-01-01 10:00:00", "b"),  # same instant is not after
    ]
    free = fn.calculate_funnel(events(spark, rows), STEPS, mode="ordered")[0].first()
    assert (free["step_0_users"], free["step_1_users"], free["step_2_users"]) == (5, 2, 2)  # u4 and u5
    session = fn.calculate_funnel(events(spark, rows), STEPS, mode="ordered", within="session_id")[0].first()
    assert (session["step_0_users"], session["step_1_users"], session["step_2_users"]) == (5, 1, 1)  # u4
    for spans in ((1,), (60, 3600, 86400), (1_000_000,)):
        done = fn.ordered_flags(events(spark, rows), STEPS, spans=spans).where("did_2").select("user_id")
        assert sorted(r[0] for r in done.collect()) == ["u4", "u5"]
    with pytest.raises(ValueError):
        fn.calculate_funnel(events(spark, rows), STEPS, mode="strict")


def test_date_range_is_typed_and_inclusive(spark):
    e = events(spark, [("u", "2024-03-31 00:00:00", "a"), ("u", "2024-03-31 10:00:00", "a"), ("u", "2024-03-01 00:00:00", "a")])
    got = filter_events(e, ["a"], date_range=("2024-03-01", "2024-03-31"))
    assert sorted(r["event_id"] for r in got.collect()) == [0, 2]
    assert filter_events(e).count() == 3 and filter_events(e, ["z"]).count() == 0
    assert filter_events(e, user_ids=["u"], limit=2).count() == 2


def test_percent_rounds_half_away_from_zero(spark):
    rows = [(f"u{i}", "2024-01-01 10:00:00", "a") for i in range(800)] + [("u0", "2024-01-01 10:00:00", "b")]
    r = fn.calculate_funnel(events(spark, rows), STEPS[:2])[0].first()
    assert r["step_0_to_1_rate"] == 0.13  # 0.125


def test_drop_off_ignores_null_ids_and_breaks_ties(spark):
    rows = [(f"u{i:02d}", "2024-01-01 10:00:00", "a") for i in range(12)] + [(None, "2024-01-01 10:00:00", "b")]
    rows += [("x", "2024-01-01 10:00:00", "a"), ("y", "2024-01-01 10:00:00", "a"), ("y", "2024-01-01 10:00:00", "b")]
    u = users(spark, [(f"u{i:02d}", f"C{i:02d}", "ch") for i in range(12)])
    out = fn.calculate_drop_off_reasons(events(spark, rows), u, STEPS[:2]).collect()
    assert len(out) == 10
    null = [r for r in out if r["country"] is None][0]  # x dropped, y did not
    assert (null["dropped_users"], null["users_in_segment"], null["drop_off_rate"]) == (1, 2, 50.0)
    assert sorted(r["country"] for r in out if r["country"]) == [f"C{i:02d}" for i in range(9)]


def test_time_to_convert_needs_a_later_end(spark):
    rows = [("u1", "2024-01-01 00:00:00", "a"), ("u1", "2024-01-02 12:00:00", "b"),
            ("u2", "2024-01-03 00:00:00", "a"), ("u2", "2024-01-01 00:00:00", "b"), ("u2", "2024-01-09 00:00:00", "b")]
    r = fn.calculate_time_to_convert(events(spark, rows), "a", "b").first()
    assert (r["converted_users"], r["median_days"]) == (1, 1.5)  # u2's first end comes before its start
    none = fn.calculate_time_to_convert(events(spark, rows), "a", "z").first()
    assert (none["converted_users"], none["median_days"]) == (0, None)
    by = fn.calculate_time_to_convert(events(spark, rows), "a", "b", users(spark, [("u9", "US", "x")]), "country")
    assert [tuple(x) for x in by.collect()] == [(None, 1, 1.5, 1.5, 1.5, 1.5)]


def test_experiment_funnel_lift_with_zero_control(spark):
    rows = [("c1", "2024-01-01 10:00:00", "a"), ("t1", "2024-01-01 10:00:00", "a"), ("t1", "2024-01-01 10:00:00", "b"),
            ("t2", "2024-01-01 10:00:00", "a"), ("c1", "2024-01-01 10:00:00", "c"), ("t1", "2024-01-01 10:00:00", "c")]
    a = spark.createDataFrame([("e", "c1", "control"), ("e", "t1", "treatment"), ("e", "t2", "treatment")],
                              "experiment_id string, user_id string, variant string")
    stages = [("opens", "a"), ("clicks", "b"), ("buys", "c")]
    out = fn.experiment_funnel_lift(fn.experiment_funnel(events(spark, rows), a, "e", stages), stages)
    got = {r["stage"]: (r["control_rate"], r["treatment_rate"], r["lift_pct"]) for r in out.collect()}
    assert got == {"clicks": (0.0, 50.0, 0.0), "buys": (100.0, 50.0, -50.0)}


SUBS = "subscription_id string, user_id string, plan string, start_date date, end_date date, status string, mrr double, cancellation_reason string"


def subs(spark, rows):
    full = [(f"s{i}", u, p, date.fromisoformat(a), date.fromisoformat(b) if b else None, st, 1.0, None) for i, (u, p, a, b, st) in enumerate(rows)]
    return spark.createDataFrame(full, SUBS)


def test_month_boundaries_prices_and_open_end(spark):
    s = subs(spark, [
        ("u1", "premium_monthly", "2024-01-31", "2024-02-01", "renewed"),   # one boundary
        ("u2", "premium_monthly", "2024-01-01", "2024-01-31", "renewed"),   # none: at least one is charged
        ("u3", "premium_annual", "2024-01-15", None, "active"),             # open until as_of: three
        ("u4", "gold", "2024-01-01", "2024-06-01", "active"), ("u5", "free", "2024-01-01", "2024-06-01", "active"),
    ])
    got = {r["user_id"]: float(r["total_revenue"]) for r in rv.subscription_revenue(s, "2024-04-01").collect()}
    assert got == {"u1": 9.99, "u2": 9.99, "u3": 299.97, "u4": 0.0, "u5": 0.0}
    loose = {r["user_id"]: float(r["total_revenue"]) for r in rv.subscription_revenue(s, "2024-04-01", min_months=None, unknown_price=None).collect()}
    assert loose["u2"] == 0.0 and loose["u4"] == 0.0
    dear = rv.subscription_revenue(s, "2024-04-01", {"premium_annual": "7.99"}).where("user_id = 'u3'").first()
    assert float(dear["total_revenue"]) == 23.97


def test_ltv_medians_over_all_and_paying(spark):
    s = subs(spark, [("u1", "premium_monthly", "2024-01-01", "2024-03-01", "active"), ("u2", "free", "2024-01-01", "2024-03-01", "active")])
    u = users(spark, [("u1", "2024-01-05", "a"), ("u2", "2024-01-20", "a"), ("u3", "2024-01-31", "b")], "user_id string, signup_date string, acquisition_channel string")
    r = rv.calculate_ltv_by_cohort(u, s, "2024-04-01").first()
    assert (r["cohort_size"], r["paying_users"], r["avg_ltv"], r["median_ltv_all"], r["median_ltv_paying"], r["total_revenue"]) == (3, 1, 6.66, 0.0, 19.98, 19.98)
    simple = rv.simple_ltv(u, s).first()
    assert (simple["users_with_subs"], simple["active_mrr"], simple["avg_sub_value"]) == (2, 0.0, 5.0)
    none = rv.simple_ltv(u.where("user_id = 'u3'"), s).first()
    assert none["avg_sub_value"] is None
    cover = rv.subscription_coverage(u, s).first()
    assert (cover["total_users"], cover["users_with_subs"], cover["pct_with_subs"]) == (3, 2, 66.67)


def test_last_status_has_an_explicit_order(spark):
    s = subs(spark, [("u1", "p", "2024-02-01", "2024-03-01", "cancelled"), ("u1", "p", "2024-01-01", "2024-02-01", "renewed"), ("u2", "p", "2024-01-01", None, "active")])
    got = {r["user_id"]: r["last_status"] for r in rv.last_status(s).collect()}
    assert got == {"u1": "cancelled", "u2": "active"}
    assert rv.churn_rate_by_last_status(s).first()["churn_pct"] == 50.0 and rv.churn_rate(s).first()["churn_pct"] == 33.33


def test_retention_keeps_activity_before_signup(spark):
    u = users(spark, [("u1", "2024-01-10"), ("u2", "2024-01-12")], "user_id string, signup_date string")
    e = events(spark, [("u1", "2024-01-03 05:00:00", "a"), ("u1", "2024-01-11 05:00:00", "a"), ("u2", "2024-01-29 05:00:00", "a"),
                       ("u2", "2024-01-29 06:00:00", "a"), ("u9", "2024-01-11 05:00:00", "a")])
    out = co.calculate_retention_cohorts(u, e, "week", "a", 8)
    assert as_rows(out.select("periods_out", "cohort_size", "active_users", "retention_pct"), "periods_out") == [(-1, 2, 1, 50.0), (0, 2, 1, 50.0), (3, 2, 1, 50.0)]
    assert co.calculate_retention_cohorts(u, e, "week", "a", 8, min_periods=0).count() == 2
    assert co.calculate_retention_cohorts(u, e, "week", "a", 2).count() == 2
    wide = co.pivot_retention_table(out, -1, 3).first()
    assert (wide["week_minus_1"], wide["week_0"], wide["week_1"], wide["week_3"]) == (50.0, 50.0, None, 50.0)


def test_feature_cohorts_split_adopters(spark):
    u = users(spark, [("u1", "2024-01-10"), ("u2", "2024-01-12"), ("u3", "2024-01-12")], "user_id string, signup_date string")
    e = events(spark, [("u1", "2024-01-11 05:00:00", "scan_completed"), ("u2", "2024-01-11 05:00:00", "scan_completed")])
    f = spark.createDataFrame([("u1", "rtp"), ("u1", "rtp"), ("u2", "vpn")], "user_id string, feature_name string")
    got = {r["adoption_status"]: (r["cohort_size"], r["retention_pct"]) for r in co.compare_feature_adoption_retention(u, e, f, "rtp").collect()}
    assert got == {"Adopted": (1, 100.0), "Not Adopted": (2, 50.0)}


def test_first_week_ends_at_midnight_inclusive(spark):
    u = users(spark, [("u", "2024-01-01")], "user_id string, signup_date string")
    e = events(spark, [("u", "2023-12-20 00:00:00", "s"), ("u", "2024-01-08 00:00:00", "s"), ("u", "2024-01-08 00:00:01", "s"), ("u", "2024-01-05 07:00:00", "s")])
    assert en.first_week_activity(e, u, "s").first()["week1_scans"] == 3
    assert en.first_week_activity(e, u, "s", from_signup=True).first()["week1_scans"] == 2


def test_churn_ratio_guards(spark):
    o = spark.createDataFrame([("u1", True, True), ("u2", True, False)], "user_id string, onboarded boolean, churned boolean")
    r = en.churn_by_onboarding(o).first()
    assert (r["churn_pct_not_onboarded"], r["churn_pct_onboarded"], r["churn_ratio"]) == (0.0, 50.0, 0.02)


@pytest.mark.parametrize("chunk", ["minute", "hour", "day"])
def test_counter_never_goes_below_zero(spark, chunk):
    signs = "-++---+"
    rows = [("u", f"2024-01-01 {8 + i // 2:02d}:{(i % 2) * 30:02d}:00", {"+": "open", "-": "close"}[s]) for i, s in enumerate(signs)]
    rows.append(("v", "2024-01-01 08:00:00", "other"))
    out = en.unresolved_counter(events(spark, rows), "open", "close", chunk)
    got = [r["unresolved"] for r in out.where("user_id = 'u'").orderBy("timestamp").collect()]
    assert got == [0, 1, 2, 1, 0, 0, 1]


def test_version_lookup_bounds_and_default(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-31",), ("2024-04-01",)], "d string")
    out = df.select(en.version_on("d", [("2024-01-01", "2024-03-31", "3.0.0")], "4.2.0").alias("v"))
    assert [r["v"] for r in out.collect()] == ["3.0.0", "3.0.0", "4.2.0"]


def test_moving_average_waits_for_seven_days(spark):
    rows = [("u", f"2024-01-{d:02d} 10:00:00", "a") for d in range(1, 9) for _ in range(d)]
    out = [r["ma7"] for r in pf.daily_volume(events(spark, rows)).orderBy("event_date").collect()]
    assert out == [None] * 6 + [4.0, 5.0]


def test_histogram_last_bin_is_closed_and_constant_column(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    assert [r["count"] for r in pf.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [tuple(r) for r in pf.histogram(same, "x", 5).collect()] == [(0, 3.0, 3.0, 2)]


def test_tables_of_counts_add_up(spark):
    df = spark.createDataFrame([("r", "p"), ("r", "q"), ("r", None), ("s", "p")], "a string, b string")
    wide = {r["a"]: (r["p"], r["Other"]) for r in pf.pivot_counts(df, "a", "b", ["p"]).collect()}
    assert wide == {"r": (1, 2), "s": (1, 0)}
    cross = {r["a"]: (r["p"], r["Other"], r["All"]) for r in pf.crosstab(df, "a", "b", ["p"]).collect()}
    assert cross == {"r": (1, 1, 2), "s": (1, 0, 1), "All": (2, 1, 3)}


def test_profile_counts_nulls_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, v int")
    got = {r["column"]: (r["dtype"], r["non_null"], r["null_count"], r["null_pct"], r["unique"]) for r in pf.check_data_quality(df, "t").collect()}
    assert got == {"k": ("string", 2, 1, 33.3333, 1), "v": ("int", 2, 1, 33.3333, 2)}
    assert pf.duplicate_keys(df, "k", "t").first()["duplicates"] == 2  # COUNT(*) - COUNT(DISTINCT k)
    assert pf.check_data_quality(df.limit(0), "t").first()["non_null"] == 0
    odd = spark.createDataFrame([(0.0, ["a, b"], bytearray(b"x")), (-0.0, ["a", "b"], bytearray(b"x")), (None, None, None)], "d double, l array<string>, b binary")
    assert {r["column"]: (r["unique"], r["null_count"]) for r in pf.check_data_quality(odd, "o").collect()} == {"d": (1, 1), "l": (2, 1), "b": (1, 1)}


def test_funnel_invariants_hold_for_ordered_mode(spark):
    import random

    rnd = random.Random(4)
    rows = [(f"u{rnd.randint(0, 30)}", f"2024-01-01 {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00", rnd.choice("abc")) for _ in range(400)]
    e = events(spark, rows)
    df, _ = fn.calculate_funnel(e, STEPS, mode="ordered")
    assert all(c["not_rising"] and c["incremental_ok"] for c in fn.funnel_validity(df, STEPS).collect())
    expect = {}
    for u in {r[0] for r in rows}:
        mine, at, done = [(t, k) for v, t, k in rows if v == u], "", 0
        for k in "abc":
            later = [t for t, kk in mine if kk == k and t > at]
            if not later:
                break
            at, done = min(later), done + 1
        expect[u] = done
    got = df.first()
    assert [got[f"step_{i}_users"] for i in range(3)] == [sum(d > i for d in expect.values()) for i in range(3)]


def test_versions_from_a_table_of_releases(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-10"), (3, "2024-03-31"), (4, "2024-04-01"), (5, None), (6, "2023-12-31")], "i int, d string")
    rows = [("2024-01-01", "2024-02-10", "3.0"), ("2024-02-01", "2024-03-31", "3.1"), ("2024-02-01", "2024-02-20", "3.0.9"), ("2024-05-01", "2024-04-01", "never")]
    releases = spark.createDataFrame(rows, "start_date string, end_date string, version string")
    releases = releases.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    got = {r["i"]: r["app_version"] for r in en.with_version(df, "d", releases, "4.2.0").collect()}
    assert got == {1: "3.0", 2: "3.0", 3: "3.1", 4: "4.2.0", 5: "4.2.0", 6: "4.2.0"}
    later = en.with_version(df, "d", releases, out="v", order="version")  # another order: the least version wins
    assert {r["i"]: r["v"] for r in later.collect()}[2] == "3.0" and later.where("i = 4").first()["v"] is None
    still = releases.withColumn("end_date", F.when(F.col("version") != "3.1", F.col("end_date")))
    assert en.with_version(df, "d", still, "4.2.0").where("i = 4").first()["app_version"] == "3.1"
    assert {r["app_version"] for r in en.with_version(df, "d", releases.limit(0), "x").collect()} == {"x"}
    assert en.with_version(df.limit(0), "d", still, "x").count() == 0
    plan = en.with_version(df, "d", releases)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_properties_of_sound_broken_and_missing_text(spark):
    texts = ['{"k": 3, "s": "x", "deep": {"a": 1.5}}', '{"k": "7"}', '{"k": "many"}', '{"k": null}', "{}", '{"k": 3', "", None, "[1]", '{"k": 99999999999999999999}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, properties string")
    got = {r["i"]: r for r in en.with_property(df, {"k": "bigint", "s": "string"}).collect()}
    assert [got[i]["k"] for i in range(len(texts))] == [3, 7, None, None, None, None, None, None, None, None]
    assert [got[i]["malformed"] for i in range(len(texts))] == [False, False, False, False, False, True, True, False, False, False]
    assert got[0]["s"] == "x"
    back = en.property_text(df.select("i", F.lit(None).cast("string").alias("none"), F.lit("é\n").alias("s")), ["i", "none", "s"])
    assert back.first()["properties"] == '{"i":0,"s":"é\\n"}'


def test_assignment_from_a_table_of_experiments(spark):
    users = spark.createDataFrame(
        [(f"u{i}", f"2024-03-{1 + i % 31:02d}", "free" if i % 2 else "premium", "US" if i % 3 else "DE") for i in range(600)],
        "user_id string, signup_date string, plan_type string, country string",
    )
    ddl = "experiment_id string, start_date date, end_date date, variants array<string>, allocation array<double>, targeting string"
    day = date.fromisoformat
    rows = [
        ("e1", day("2024-03-05"), day("2024-03-10"), ["a", "b"], [0.25, 0.75], "all_users"),
        ("e2", day("2024-03-01"), day("2024-03-31"), ["x", "y", "z"], [0.0, 1.0, 0.0], "free_users"),
        ("e3", day("2024-03-31"), day("2024-03-31"), ["roll", "hold"], [0.5, 0.5], "geo_based"),
        ("e4", day("2024-03-02"), day("2024-03-01"), ["a"], [1.0], "all_users"),
    ]
    out = ex.assign_from_table(users, spark.createDataFrame(rows, ddl), rollout_countries=["DE"])
    got = out.join(users, "user_id").collect()
    by = {e: [r for r in got if r["experiment_id"] == e] for e in ("e1", "e2", "e3", "e4")}
    days = [1 + i % 31 for i in range(600)]
    assert [len(by[e]) for e in by] == [sum(5 <= d <= 10 for d in days), 300, sum(d == 31 for d in days), 0]
    assert {r["variant"] for r in by["e2"]} == {"y"} and {r["plan_type"] for r in by["e2"]} == {"free"}
    assert all(r["variant"] == ("roll" if r["country"] == "DE" else "hold") for r in by["e3"])
    alone = ex.assign_variants(users, "e1", ["a", "b"], [0.25, 0.75], "2024-03-05", "2024-03-10")
    assert {(r["user_id"], r["variant"]) for r in by["e1"]} == {(r["user_id"], r["variant"]) for r in alone.collect()}
    for broken in ({"allocation": [0.5, 0.4]}, {"allocation": [1.0]}, {"targeting": "left_handed"}, {"allocation": [1.5, -0.5]}):
        row = dict(zip([c.split()[0] for c in ddl.split(", ")], rows[0])) | broken
        with pytest.raises(Exception, match="Unusable experiment: e1"):
            ex.assign_from_table(users, spark.createDataFrame([tuple(row.values())], ddl)).collect()
