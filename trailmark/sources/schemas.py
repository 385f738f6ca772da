"""The eight telemetry tables: names, columns and the types used after loading."""

from __future__ import annotations

from pyspark.sql import types as T

# Table names, column names and types of the telemetry data model.
DDL = {
    "users": "user_id string, signup_date date, plan_type string, country string, device_os string, "
    "acquisition_channel string, email_domain string",
    "subscriptions": "subscription_id string, user_id string, plan string, start_date date, end_date date, "
    "status string, mrr double, cancellation_reason string",
    "events": "event_id string, user_id string, timestamp timestamp_ntz, event_type string, "
    "properties string, session_id string, device_os string, app_version string",
    "experiments": "experiment_id string, experiment_name string, start_date date, end_date date, "
    "status string, variants array<string>, allocation array<double>, primary_metric string, "
    "targeting string",
    "experiment_assignments": "experiment_id string, user_id string, variant string, assigned_at date",
    "experiment_metrics": "experiment_id string, user_id string, metric_name string, metric_value double, "
    "recorded_at date",
    "feature_usage": "user_id string, feature_name string, first_used_at date, usage_count bigint, "
    "last_used_at date",
    "support_tickets": "ticket_id string, user_id string, created_at date, category string, "
    "priority string, resolution_hours bigint, csat_score bigint",
}
REQUIRED = ("users", "events", "subscriptions")


def schema(table: str) -> T.StructType:
    if table not in DDL:
        raise ValueError(f"Unknown table: {table}")
    return T.StructType.fromDDL(DDL[table])
