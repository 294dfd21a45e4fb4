"""The daily subscription fact: one row per subscription and day, with the plan of that day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.contracts import FACT_DAILY
from tenure.functions.rules import ACTIVE, CANCELED, TRIALING
from tenure.functions.money import cents
from tenure.functions.times import as_date
from tenure.operators.ranges import (
    FIRST_DAY,
    LAST_DAY,
    MAX_BROADCAST_BYTES,
    fits_broadcast,
    left_range_join,
)
from tenure.operators.spine import HALF_OPEN, clip_windows, explode_days, version_windows


#: Daily rows one task should produce at most: about 1 GB of them.
ROWS_PER_TASK = 8_000_000


def subscription_windows(
    subscriptions: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
) -> DataFrame:
    """Subscription versions as (ids, status, version_no, first_day, last_day).

    Pass ``start_date``/``end_date`` for load time, ``sub_start_date``/``sub_end_date`` for
    business time. ``version_no`` counts the versions of a subscription from its first.
    """
    in_order = Window.partitionBy("subscription_id").orderBy(
        valid_from, "first_day", "last_day", "status", "plan_id"
    )
    return version_windows(subscriptions, as_of, valid_from, valid_to, end_rule).select(
        "subscription_id", "customer_id", "plan_id", "status",
        F.row_number().over(in_order).alias("version_no"), "first_day", "last_day",
    )


def _clipped_windows(
    subscriptions: DataFrame,
    as_of: str | date,
    valid_from: str,
    valid_to: str,
    end_rule: str,
    from_dt: str | date | None,
    to_dt: str | date | None,
    keep_previous: bool,
    partitions: int | None,
) -> DataFrame:
    if partitions is not None:
        subscriptions = subscriptions.repartition(partitions, "subscription_id")
    return clip_windows(
        subscription_windows(subscriptions, as_of, valid_from, valid_to, end_rule),
        from_dt, to_dt, keep_previous,
    )


def daily_partitions(
    subscriptions: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
    from_dt: str | date | None = None,
    to_dt: str | date | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> int | None:
    """How many partitions the daily rows of these versions need, from their summed lengths.

    Spark sizes tasks by the versions it reads, and cannot know how many days each becomes.
    None means that one task could hold them all, so Spark's own choice will do; otherwise
    the answer keeps all cores busy.
    """
    windows = clip_windows(
        version_windows(subscriptions, as_of, valid_from, valid_to, end_rule), from_dt, to_dt
    )
    days = windows.agg(F.sum(F.datediff("last_day", "first_day") + 1)).first()[0] or 0
    needed = -(-days // rows_per_task)
    cores = subscriptions.sparkSession.sparkContext.defaultParallelism
    return max(needed, cores) if needed > 1 else None


#: Daily rows that a task sorts by month and writes, about.
ROWS_PER_WRITE = 2_000_000


def cut_by_month(windows: DataFrame, rows_per_task: int = ROWS_PER_WRITE) -> DataFrame:
    """Windows cut where months end, with their month as ``dt_month``, in tasks of neighbouring months and about ``rows_per_task`` days.

    Rows of a daily table partitioned by month are so placed before they are multiplied into days, and each task writes few months.
    """
    months = F.sequence(F.trunc("first_day", "MM"), F.col("last_day"), F.expr("interval 1 month"))
    others = [c for c in windows.columns if c not in ("first_day", "last_day")]
    cut = windows.select("*", F.explode(months).alias("__month")).select(
        *others, F.greatest("first_day", "__month").alias("first_day"), F.least("last_day", F.last_day("__month")).alias("last_day"),
        F.date_format("__month", "yyyy-MM").alias("dt_month"),
    )
    days = windows.agg(F.sum(F.datediff("last_day", "first_day") + 1)).first()[0] or 0
    tasks = max(1, -(-days // rows_per_task))
    return cut.repartitionByRange(tasks, "dt_month", F.xxhash64("subscription_id"))


def date_spine(
    subscriptions: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
    from_dt: str | date | None = None,
    to_dt: str | date | None = None,
    keep_previous: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """One row per version and covered day.

    ``version_no`` is computed before versions are multiplied into days, which partitions
    the few versions by subscription, so a later window per subscription needs no shuffle of
    the many daily rows. A caller that drops ``version_no`` does not pay for it. Set
    ``partitions`` (see ``daily_partitions``) when versions cover very many days each.
    """
    windows = _clipped_windows(
        subscriptions, as_of, valid_from, valid_to, end_rule, from_dt, to_dt, keep_previous, partitions
    )
    return explode_days(windows).withColumnRenamed("status", "status_at_day")


def plan_ranges(plans: DataFrame, active_only: bool = False) -> DataFrame:
    """Plan attributes with closed effective ranges.

    Ranges of one plan must not overlap; take the open versions of a plan dimension with
    ``active_only``, or look for offenders with ``operators.ranges.overlapping_ranges``.
    """
    used = plans.filter(F.col("active_status") == "Y") if active_only else plans
    return used.select(
        "plan_id", "plan_name", "tier", "monthly_price",
        F.col("effective_from").cast("date").alias("plan_from"),
        F.coalesce(F.col("effective_to").cast("date"), as_date(LAST_DAY)).alias("plan_to"),
    )


def attach_plan(
    daily: DataFrame,
    plans: DataFrame,
    active_only: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left join the plan version whose effective range holds the day to rows that have a ``dt``."""
    ranges = plan_ranges(plans, active_only)
    return left_range_join(
        daily, ranges, "plan_id",
        F.col("dt").between(F.col("plan_from"), F.col("plan_to")),
        spread_by=["subscription_id", "dt"],
        is_small=fits_broadcast(ranges, max_broadcast_bytes),
    ).drop("plan_from", "plan_to")


def plan_timeline(plans: DataFrame, active_only: bool = False) -> DataFrame:
    """Every plan over all time: its effective ranges, and the gaps with null attributes."""
    by_plan = Window.partitionBy("plan_id").orderBy("plan_from", "plan_to")
    so_far = by_plan.rowsBetween(Window.unboundedPreceding, 0)
    first, last = as_date(FIRST_DAY), as_date(LAST_DAY)
    ranges = plan_ranges(plans, active_only).withColumns({
        "is_first": F.lag("plan_from").over(by_plan).isNull(),
        "covered_to": F.max("plan_to").over(so_far),
        "next_from": F.lead("plan_from").over(by_plan),
    })

    def piece(start: Column, end: Column, known: bool) -> Column:
        attributes = [
            (F.col(c) if known else F.lit(None).cast(ranges.schema[c].dataType)).alias(c)
            for c in ("plan_name", "tier", "monthly_price")
        ]
        return F.struct(*attributes, start.alias("plan_from"), end.alias("plan_to"))

    # No day arithmetic beyond either end of the calendar.
    gap_from = F.when(F.col("covered_to") < last, F.date_add("covered_to", 1))
    gap_to = F.coalesce(F.date_sub("next_from", 1), last)
    pieces = F.array_compact(F.array(
        F.when(F.col("is_first") & (F.col("plan_from") > first),
               piece(first, F.date_sub("plan_from", 1), known=False)),
        piece(F.col("plan_from"), F.col("plan_to"), known=True),
        F.when(gap_from <= gap_to, piece(gap_from, gap_to, known=False)),
    ))
    return ranges.select("plan_id", F.explode(pieces).alias("piece")).select("plan_id", "piece.*")


def priced_windows(
    windows: DataFrame,
    plans: DataFrame,
    active_only: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Cut windows where their plan changes, so that each piece has one set of plan attributes.

    Days and attributes come out the same as with ``attach_plan`` on every day, but a plan
    with many prices is matched once per version instead of once per day.
    """
    # A range has at most two gaps beside it, so the timeline is at most three times as large.
    is_small = fits_broadcast(plan_ranges(plans, active_only), max_broadcast_bytes // 3)
    cut = left_range_join(
        windows, plan_timeline(plans, active_only), "plan_id",
        (F.col("plan_from") <= F.col("last_day")) & (F.col("plan_to") >= F.col("first_day")),
        spread_by=["subscription_id", "first_day"],
        is_small=is_small,
    )
    others = [c for c in windows.columns if c not in ("first_day", "last_day")]
    return cut.select(
        *others, "plan_name", "tier", "monthly_price",
        F.greatest("first_day", "plan_from").alias("first_day"),
        F.least("last_day", "plan_to").alias("last_day"),
    )


def priced_days(windows: DataFrame, plans: DataFrame, active_only: bool = False) -> DataFrame:
    """One row per window and day with the plan of that day: plans are matched per window, not per day."""
    return explode_days(priced_windows(windows, plans, active_only))


def price_ranges(plans: DataFrame) -> DataFrame:
    """Open plan versions whose ranges end, at the latest, the day before the next range of their plan begins."""
    following = F.lead("effective_from").over(Window.partitionBy("plan_id").orderBy("effective_from"))
    used = plans.filter(F.col("active_status") == "Y") if "active_status" in plans.columns else plans
    return used.withColumn("effective_to", F.least(F.col("effective_to").cast("date"), F.date_sub(following, 1)))


def one_at_a_time(versions: DataFrame, valid_from: str = "start_date", valid_to: str = "end_date") -> DataFrame:
    """Subscription versions of which at most one holds at any time.

    A version ends, at the latest, when the next one of its subscription begins. Of versions that begin together the one of
    the latest business start counts, and a row of an earlier business start that arrives late changes nothing. For
    business time, give open versions only: those that a load replaced say what was once believed.
    """
    order = Window.partitionBy("subscription_id").orderBy(valid_from, "sub_start_date")
    latest = F.max("sub_start_date").over(order.rowsBetween(Window.unboundedPreceding, 0))
    used = versions.withColumn("__latest", latest).filter(F.col("sub_start_date") >= F.col("__latest")).drop("__latest")
    following = F.lead(valid_from).over(order).cast(versions.schema[valid_to].dataType)
    return used.withColumn(valid_to, F.least(F.col(valid_to), following))


def _flag(status: str) -> Column:
    return F.coalesce((F.col("status") == status).cast("int"), F.lit(0))


def fact_daily(
    subscriptions: DataFrame,
    plans: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
    from_dt: str | date | None = None,
    to_dt: str | date | None = None,
    active_plans_only: bool = False,
    for_kpi: bool = False,
    partitions: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    by_month: bool = False,
) -> DataFrame:
    """The daily fact in its contract.

    ``for_kpi`` keeps what the KPI job needs beyond the contract: ``version_no`` to order two
    versions that share a day, ``price_cents``, and the last row of each version before
    ``from_dt`` so that the first day has its previous rows. ``by_month`` adds ``dt_month`` and places the rows by it, ready to be
    written (see ``cut_by_month``).
    """
    windows = _clipped_windows(
        subscriptions, as_of, valid_from, valid_to, end_rule, from_dt, to_dt, for_kpi, partitions
    )
    pieces = priced_windows(windows, plans, active_plans_only, max_broadcast_bytes)
    if for_kpi:
        pieces = pieces.withColumn("price_cents", cents(F.col("monthly_price")))
    if by_month:
        pieces = cut_by_month(pieces)
    daily = explode_days(pieces)
    values = {
        "status_at_day": F.col("status"),
        "tier_at_day": F.col("tier"),
        "monthly_price_at_day": F.col("monthly_price"),
        "is_active": _flag(ACTIVE),
        "is_trialing": _flag(TRIALING),
        "is_canceled": _flag(CANCELED),
    }
    columns = [
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FACT_DAILY.schema
    ]
    return daily.select(*columns, *(["version_no", "price_cents"] if for_kpi else []), *(["dt_month"] if by_month else []))
