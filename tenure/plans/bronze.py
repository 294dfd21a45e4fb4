"""Landing rows to bronze rows: stamp the load, flatten event payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.operators.updates import stamp_load

# The source label each bronze table carries.
SOURCE_LABELS = {
    "customers": "customer_file",
    "plans": "plans_file",
    "subscriptions": "subscriptions_file",
    "invoices": "invoices_file",
    "events": "events_file",
}


def bronze(df: DataFrame, table: str, as_of: str | datetime) -> DataFrame:
    """A landed batch table with its load stamp."""
    return stamp_load(df, SOURCE_LABELS[table], as_of)


def flatten_events(events: DataFrame) -> DataFrame:
    """Lift the payload fields to columns and drop the payload."""
    return events.withColumns({
        "customer_id": F.col("payload.customer_id"),
        "amount": F.col("payload.amount"),
        "failure_reason": F.col("payload.failure_reason"),
    }).drop("payload")


def bronze_events(events: DataFrame, as_of: str | datetime) -> DataFrame:
    return bronze(flatten_events(events), "events", as_of)
