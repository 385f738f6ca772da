"""Users listed more than once, and date ranges not written with leading zeros."""

from __future__ import annotations

import datetime as dt

from trailmark.operators import cohort, funnel, revenue
from trailmark.sources.catalog import Catalog


def users_of(spark):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(1, day, "a"), (1, day, "a"), (2, day, "a")], "user_id long, signup_date date, acquisition_channel string")


def events_of(spark):
    at = dt.datetime(2024, 1, 2)
    return spark.createDataFrame([(1, "view", at), (2, "view", at), (1, "click", at)], "user_id long, event_type string, timestamp timestamp_ntz")


def test_a_user_listed_twice_counts_once(spark):
    users, events = users_of(spark), events_of(spark)
    steps = [("v", "view"), ("c", "click")]
    got = funnel.calculate_funnel(events, steps, users, "acquisition_channel")[0].first()
    assert (got["step_0_users"], got["step_1_users"]) == (2, 1)
    kept = cohort.calculate_retention_cohorts(users, events, activity_event="view").first()
    assert (kept["cohort_size"], kept["active_users"]) == (2, 2)
    subs = spark.createDataFrame([(1, "premium", dt.date(2024, 1, 1), None)], "user_id long, plan string, start_date date, end_date date")
    assert revenue.calculate_ltv_by_cohort(users, subs, "2024-03-01").first()["cohort_size"] == 2
    assert revenue.calculate_ltv_by_channel(users, subs, "2024-03-01").first()["total_users"] == 2


def test_a_range_without_leading_zeros_keeps_its_rows(spark, tmp_path):
    rows = [("e1", "u", "2024-01-05 10:00:00", "open"), ("e2", "u", "2024-01-07 00:00:00", "open"), ("e3", "u", "2024-01-08 00:00:00", "open")]
    spark.createDataFrame(rows, "event_id string, user_id string, timestamp string, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    found = Catalog(spark, str(tmp_path)).query_events
    for days in (("2024-01-05", "2024-01-07"), ("2024-1-5", "2024-1-7")):
        assert sorted(r.event_id for r in found(date_range=days).collect()) == ["e1", "e2"]
