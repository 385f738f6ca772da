"""Plan helpers: exact results whatever the skew, and plans that stay bounded."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trailmark.operators import funnel, profile
from trailmark.plans import lineage, local, quantiles, skew, steps

SF = "/root/testdata/sf0.001"


def frame(spark, groups):
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    return spark.createDataFrame(rows, "g string, v double")


PS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def check_percentiles(spark, groups):
    got = {r["g"]: r for r in quantiles.exact_percentiles(frame(spark, groups), ["g"], "v", PS).collect()}
    assert set(got) == {g for g, xs in groups.items() if len(xs)}
    for g, r in got.items():
        for name, p in PS.items():
            assert r[name] == pytest.approx(float(np.percentile(groups[g], p * 100)), rel=1e-12, abs=1e-12), (g, name)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "b", None]), st.lists(st.integers(-5, 5), min_size=1, max_size=12), min_size=1))
def test_percentiles_of_tiny_tied_groups(spark, groups):
    check_percentiles(spark, groups)


def test_percentiles_of_a_hot_group(spark):
    rng = np.random.default_rng(0)
    hot = np.concatenate([rng.exponential(3, 60_000), np.full(20_000, 2.5)])
    check_percentiles(spark, {"hot": hot, "cold": rng.normal(0, 1, 7), "one": [4.0]})


def test_percentiles_without_groups_or_rows(spark):
    df = frame(spark, {"a": [1, 2, 3, 10]})
    assert quantiles.exact_percentiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.5
    assert quantiles.exact_percentiles(df.where("v > 99"), [], "v", {"m": 0.5}).first()["m"] is None
    assert quantiles.exact_percentiles(df.where("v > 99"), ["g"], "v", {"m": 0.5}).count() == 0


def test_changed_brackets_are_an_error_not_a_wrong_answer(spark, monkeypatch):
    real = quantiles.attach_group_values

    def shaken(rows, groups, keys, spread_by, salts=64):
        # Some rows see brackets from a failed attempt.
        out = real(rows, groups, keys, spread_by, salts)
        moved = F.transform("__b", lambda b: b + F.when(F.col("__v") % 2 == 0, 40).otherwise(0))
        return out.withColumn("__b", moved)

    monkeypatch.setattr(quantiles, "attach_group_values", shaken)
    with pytest.raises(Exception, match="brackets changed"):
        quantiles.exact_percentiles(frame(spark, {"a": range(200)}), ["g"], "v", {"m": 0.5}).collect()


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_values_at_positions(spark, buckets):
    rng = np.random.default_rng(2)
    xs = rng.integers(0, 50, 500).astype(float)
    hist = frame(spark, {"a": xs}).groupBy("g", "v").agg(F.count("*").alias("cnt"))
    ask = [0, 1, 250, 250, 499]
    points = spark.createDataFrame([("a", p) for p in ask], "g string, position bigint")
    got = {r["position"]: r["value_at"] for r in quantiles.values_at_positions(hist, ["g"], points, buckets).collect()}
    assert got == {p: float(np.sort(xs)[p]) for p in ask}


def test_ranks_in_a_hot_group_are_a_permutation(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").when(F.col("id") < 4990, F.col("id").cast("string")).alias("g"), "id")
    out = skew.rank_in_groups(df, ["g"], "id")
    per = out.groupBy("g").agg(F.count("*").alias("n"), F.max("rank").alias("hi"), F.countDistinct("rank").alias("d")).collect()
    assert len(per) == 992 and all(r["n"] == r["hi"] == r["d"] for r in per)
    assert out.exceptAll(skew.rank_in_groups(df.repartition(11), ["g"], "id")).count() == 0


def test_salted_joins_equal_plain_joins(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k"), "id")
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    want = big.join(small, "k").select("k", "id", "x")
    hot = skew.hot_keys(big, ["k"], 500)
    assert [r["k"] for r in hot.collect()] == [0]
    salted = skew.join_salting_hot_keys(big, small, ["k"], hot, ["id"], 16).select("k", "id", "x")
    spread = skew.attach_group_values(big, small, ["k"], ["id"], 8).select("k", "id", "x")
    for got in (salted, spread):
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_checkpoints_go_where_the_session_says(spark):
    lineage.cut(spark.range(3))
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_local_tables_are_local_relations(spark):
    df = local.local_table(spark, [{"a": "x", "b": 1.5}, {"a": "y", "b": None}], "a string, b double")
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in df.collect()] == [("x", 1.5), ("y", None)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_has_a_cartesian_product(spark):
    for name, query in entry.queries().items():
        text = plan_of(query(spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_funnel_reads_events_once_and_pushes_the_filter(spark):
    text = plan_of(entry.queries()["funnel_overall"](spark, SF))
    assert text.count("FileScan") == 1 and "In(event_type" in text
    one_day = plan_of(entry.queries()["funnel_one_day"](spark, SF))
    assert one_day.count("FileScan") == 1 and "In(event_type" in one_day and "GreaterThanOrEqual(ts" in one_day
    read = [line for line in text.splitlines() if "ReadSchema" in line][0]
    assert "props" not in read.split("ReadSchema")[1]


def done_in_order(rows, wanted):
    """How many of ``wanted`` follow each other in (time, kind) rows, each strictly later."""
    at, done = None, 0
    for kind in wanted:
        later = [t for t, k in rows if k == kind and (at is None or t > at)]
        if not later:
            break
        at, done = min(later), done + 1
    return done


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("wanted", ["abc", "a", "aab", "abab"])
def test_steps_equal_a_reading_in_order(spark, kind, wanted):
    rng = np.random.default_rng(len(wanted))
    rows = []
    for user in range(60):
        for _ in range(rng.integers(1, 14)):
            micros = int(rng.integers(-3, 4)) * 1_800_000_000 + int(rng.integers(0, 3)) * 500_000
            rows.append((user, micros, "abcz"[rng.integers(0, 4)]))
    df = spark.createDataFrame(rows, "u int, m bigint, e string").withColumn("t", F.timestamp_micros("m").cast(kind))
    want = {u: done_in_order([(m, e) for v, m, e in rows if v == u], wanted) for u in {r[0] for r in rows}}
    for spans in ((1, 3600), (1,), (10, 60, 600)):
        got = {r["u"]: r["done"] for r in steps.steps_done(df, ["u"], "t", [F.col("e") == k for k in wanted], spans).collect()}
        assert {u: got.get(u, 0) for u in want} == want, spans


def test_steps_of_one_hot_user_are_spread(spark):
    df = spark.range(200_000).select(F.lit(1).alias("u"), F.timestamp_seconds(F.col("id") * 5).alias("t"), F.when(F.col("id") == 150_000, "a").when(F.col("id") < 150_000, "b").otherwise("c").alias("e"))
    assert steps.steps_done(df, ["u"], "t", [F.col("e") == k for k in "acb"]).first()["done"] == 2
    with pytest.raises(ValueError, match="1 to 31"):
        steps.steps_done(df, ["u"], "t", [])
    nothing = steps.steps_done(df.withColumn("t", F.lit(None).cast("timestamp")), ["u"], "t", [F.col("e") == "a"])
    assert nothing.count() == 0


def test_ordered_funnel_reads_events_once_without_a_join(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("ts", "timestamp")
    text = plan_of(funnel.ordered_flags(events, [("a", "view"), ("b", "click"), ("c", "purchase")], within="session_id" if "session_id" in events.columns else None))
    assert text.count("FileScan") == 1 and "Join" not in text and "In(event_type" in text


def test_profile_and_rank_sum_read_their_tables_once(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert plan_of(profile.check_data_quality(events, "events")).count("FileScan") == 1
    # The value counts are written once; what follows reads only them.
    assert plan_of(entry.queries()["mann_whitney_u"](spark, SF)).count("FileScan") == 0
