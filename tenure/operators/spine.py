"""From versioned rows to days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.functions.times import as_date

HALF_OPEN = "half_open"
INCLUSIVE = "inclusive"


def _last_day(valid_to: str, as_of: str | date, end_rule: str) -> Column:
    closed = F.col(valid_to).cast("date")
    if end_rule == HALF_OPEN:
        closed = F.date_sub(closed, 1)
    elif end_rule != INCLUSIVE:
        raise ValueError(f"end_rule must be {HALF_OPEN!r} or {INCLUSIVE!r}, got {end_rule!r}")
    return F.coalesce(closed, as_date(as_of))


def version_windows(
    versions: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
) -> DataFrame:
    """Add ``first_day`` and ``last_day``, the days each version covers, and drop empty windows.

    A half-open version ends the day before ``valid_to``, so a successor that starts on
    ``valid_to`` never shares a day with it. Under the inclusive rule both rows exist on the
    day of change. A version without an end runs through ``as_of``.
    """
    return (
        versions.withColumns({
            "first_day": F.col(valid_from).cast("date"),
            "last_day": _last_day(valid_to, as_of, end_rule),
        })
        .filter(F.col("first_day") <= F.col("last_day"))
    )


def rejected_windows(
    versions: DataFrame, valid_from: str = "start_date", valid_to: str = "end_date"
) -> DataFrame:
    """Versions that end before they start, or have no start: they cover no day."""
    start, end = F.col(valid_from).cast("date"), F.col(valid_to).cast("date")
    return versions.filter(start.isNull() | F.coalesce(end < start, F.lit(False)))


def clip_windows(
    windows: DataFrame,
    from_dt: str | date | None = None,
    to_dt: str | date | None = None,
    keep_previous: bool = False,
    key: str = "subscription_id",
    order: str = "version_no",
) -> DataFrame:
    """Cut windows to ``[from_dt, to_dt]``.

    With ``keep_previous`` every key also keeps its last day before ``from_dt``, from the version
    that comes last by ``order`` on that day. That is what a LAG needs to see at the left edge,
    even for a subscription that paused long ago, and costs at most one row per key.
    """
    clipped = windows
    if from_dt is not None:
        start = as_date(from_dt)
        if keep_previous:
            before = F.least(F.date_sub(start, 1), F.col("last_day"))
            earlier = F.when(F.col("first_day") < start, F.struct(before.alias("day"), F.col(order).alias("nth")))
            last = F.max(earlier).over(Window.partitionBy(key))
            is_last = F.coalesce((F.col("first_day") < start) & (F.col("__last.day") == before) & (F.col("__last.nth") == F.col(order)), F.lit(False))
            clipped = clipped.withColumn("__last", last)
            start = F.when(is_last, before).otherwise(start)
        clipped = clipped.withColumn("first_day", F.greatest(F.col("first_day"), start)).drop("__last")
    if to_dt is not None:
        clipped = clipped.withColumn("last_day", F.least(F.col("last_day"), as_date(to_dt)))
    return clipped.filter(F.col("first_day") <= F.col("last_day"))


def explode_days(windows: DataFrame, day: str = "dt") -> DataFrame:
    """One row per covered day; drops the window columns."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    others = [c for c in windows.columns if c not in ("first_day", "last_day")]
    return windows.select(*others, F.explode(days).alias(day))
