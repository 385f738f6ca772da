"""Loading, auditing and writing tables stored the way the generator stores them (dates as text)."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from trailmark.sources.catalog import Catalog
from trailmark.sources.schemas import DDL, schema


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw"))
    spark.createDataFrame(
        [("u1", "2024-01-05", "free", "US", "ios", "direct", "x.com"), ("u2", "2024-02-05", "free", "CA", "ios", "direct", "x.com")],
        "user_id string, signup_date string, plan_type string, country string, device_os string, acquisition_channel string, email_domain string",
    ).coalesce(1).write.parquet(f"{base}/users.parquet")
    spark.createDataFrame(
        [("e1", "u1", "2024-03-30 23:59:59", "app_open", "{}", "s", "ios", "1"), ("e2", "u1", "2024-03-31 00:00:00", "app_open", "{}", "s", "ios", "1"),
         ("e3", "u2", "2024-03-31 00:00:01", "app_open", "{}", "s", "ios", "1"), ("e4", "u2", "2024-03-01 00:00:00", "scan_completed", "{}", "s", "ios", "1")],
        "event_id string, user_id string, timestamp string, event_type string, properties string, session_id string, device_os string, app_version string",
    ).write.parquet(f"{base}/events.parquet")
    spark.createDataFrame(
        [("exp_001", "n", "2024-03-01", "2024-05-31", "completed", "['control', 'treatment']", "[0.5, 0.5]", "m", "all")],
        "experiment_id string, experiment_name string, start_date string, end_date string, status string, variants string, allocation string, primary_metric string, targeting string",
    ).write.parquet(f"{base}/experiments.parquet")
    return base


def test_types_are_cast_at_load(spark, root):
    c = Catalog(spark, root)
    users = c.load_table("users")
    assert users.schema["signup_date"].dataType == T.DateType() and users.first()["signup_date"] in (date(2024, 1, 5), date(2024, 2, 5))
    events = c.load_table("events")
    assert events.schema["timestamp"].dataType == T.TimestampNTZType()
    e = c.load_table("experiments").first()
    assert e["variants"] == ["control", "treatment"] and e["allocation"] == [0.5, 0.5] and e["end_date"] == date(2024, 5, 31)


def test_unknown_and_missing_tables(spark, root):
    c = Catalog(spark, root)
    with pytest.raises(ValueError):
        c.load_table("nope")
    with pytest.raises(FileNotFoundError):
        c.load_table("subscriptions")
    assert set(c.load_all_tables()) == {"users", "experiments"}
    assert set(c.load_all_tables(exclude_events=False)) == {"users", "experiments", "events"}


def test_event_filters_push_text_bounds(spark, root):
    c = Catalog(spark, root)
    df = c.query_events(date_range=("2024-03-02", "2024-03-31"), padded_text=True)
    assert sorted(r["event_id"] for r in df.collect()) == ["e1", "e2"]
    assert "GreaterThanOrEqual(timestamp" in df._jdf.queryExecution().executedPlan().toString()
    exact = c.query_events(["app_open"], ["u2"], ("2024-03-31", datetime(2024, 3, 31, 12)))
    assert [r["event_id"] for r in exact.collect()] == ["e3"]
    assert c.query_events(limit=2).count() == 2 and c.query_events().count() == 4


def test_a_range_keeps_text_that_is_not_padded(spark, tmp_path):
    rows = [("e1", "u", "2024-1-5 10:00:00", "a"), ("e2", "u", "2024-01-06 10:00:00", "a"), ("e3", "u", "2024-1-8", "a"), ("e4", "u", " 2024-01-07", "a")]
    spark.createDataFrame(rows, "event_id string, user_id string, timestamp string, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    df = Catalog(spark, str(tmp_path)).query_events(date_range=("2024-01-05", "2024-01-07"))
    assert sorted(r["event_id"] for r in df.collect()) == ["e1", "e2", "e4"]


def test_sql_templates_views_and_frames(spark, root):
    c = Catalog(spark, root)
    assert c.query_raw_table("users", "SELECT count(*) AS n FROM {table}").first()["n"] == 2
    assert c.query_raw_table("events", limit=1).count() == 1
    assert set(c.register_views()) == {"users", "events", "experiments"}
    assert c.execute_query("SELECT count(*) AS n FROM events JOIN users USING (user_id)").first()["n"] == 4
    c.register_frame("one", spark.range(1))
    assert c.execute_query("SELECT * FROM one").count() == 1
    assert c.execute_query("SELECT count(*) AS n FROM {x}", x=spark.range(7)).first()["n"] == 7


def test_table_info_and_audit(spark, root):
    c = Catalog(spark, root)
    info = {r["table"]: (r["rows"], r["size_mb"]) for r in c.get_table_info().collect()}
    assert info == {"users": (2, 0.0), "events": (4, 0.0), "experiments": (1, 0.0)}
    audit = {r["table"]: r["present"] for r in c.validate_paths().collect()}
    assert audit == {"users": True, "events": True, "subscriptions": False}


def test_written_events_are_dated_and_read_back(spark, root, tmp_path):
    source, target = Catalog(spark, root), Catalog(spark, str(tmp_path / "out"))
    target.write_table("events", source.load_table("events"))
    target.write_table("users", source.load_table("users"))
    back = target.load_table("events")
    assert back.columns == source.load_table("events").columns
    assert back.exceptAll(source.load_table("events")).count() == 0 and back.count() == 4
    assert (tmp_path / "out" / "events.parquet" / "event_date=2024-03-31").is_dir()
    ranged = target.query_events(date_range=("2024-03-31", "2024-04-01"))
    assert ranged.count() == 2
    scan = [line for line in ranged._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line][0]
    assert "event_date" in scan.split("PartitionFilters")[1].split("]")[0]
    assert {r["table"]: r["rows"] for r in target.get_table_info().collect()} == {"users": 2, "events": 4}


def test_schemas_cover_all_tables():
    assert len(DDL) == 8 and all(schema(t).fields for t in DDL)
