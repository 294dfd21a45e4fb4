"""Time helpers: as-of literals and event timestamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: event timestamps look like 2025-08-24T02:00:00Z.
EVENT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"


def as_date(value: str | date) -> Column:
    """A date literal from ``YYYY-MM-DD`` or a ``date``."""
    return F.lit(value if isinstance(value, str) else value.isoformat()[:10]).cast("date")


def as_timestamp(value: str | datetime) -> Column:
    """A timestamp literal, read in the session time zone."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def parse_event_ts(text: Column) -> Column:
    """UTC instant of an event timestamp, whatever the session zone; null when malformed."""
    return F.when(text.endswith("Z"), F.try_to_timestamp(text, F.lit(EVENT_TS_FORMAT)))
