"""Cohorts and retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.contracts import RETENTION, conform
from tenure.functions.rules import ACTIVE
from tenure.functions.times import as_date
from tenure.operators.spine import HALF_OPEN, version_windows

# Period name, period number, length in months of thirty days.
RETENTION_PERIODS = [
    ("W1", 1, 0.25),
    ("M1", 2, 1),
    ("M3", 3, 3),
    ("M6", 4, 6),
    ("M12", 5, 12),
]

#: An engaged customer has an event on one of this many days from the period date on.
ENGAGEMENT_DAYS = 7


def _offset_days(months: float) -> int:
    return int(months * 30)


def cohort_start(day: Column, grain: str = "month") -> Column:
    """First day of the cohort: of the month, or the Monday of the week."""
    if grain not in ("month", "week"):
        raise ValueError(f"grain must be 'month' or 'week', got {grain!r}")
    return F.trunc(day.cast("date"), "MM" if grain == "month" else "week")


def customer_cohorts(customers: DataFrame, grain: str = "month", active_only: bool = True) -> DataFrame:
    """Customer, cohort and signup day, from the open versions when the table is versioned."""
    used = customers.filter(F.col("created_at").isNotNull())
    if active_only and "active_status" in customers.columns:
        used = used.filter(F.col("active_status") == "Y")
    return used.select(
        "customer_id",
        cohort_start(F.col("created_at"), grain).alias("cohort_month"),
        F.col("created_at").cast("date").alias("signup_date"),
    ).distinct()


def cohort_sizes(cohorts: DataFrame) -> DataFrame:
    """Distinct customers per cohort."""
    return cohorts.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"))


def _periods(as_of: str | date) -> Column:
    """The periods of a cohort row that were reached by ``as_of``."""
    due = [
        F.struct(
            F.lit(name).alias("period_name"),
            F.lit(number).alias("period_number"),
            F.date_add("cohort_month", _offset_days(months)).alias("period_date"),
        )
        for name, number, months in RETENTION_PERIODS
    ]
    return F.array_compact(F.array(*[F.when(p["period_date"] <= as_date(as_of), p) for p in due]))


def cohort_period_matrix(cohorts: DataFrame, as_of: str | date) -> DataFrame:
    """One row per customer and reached period, with the size of the cohort.

    Periods come from an array per row, so no cross join is planned. The sizes hold one row
    per calendar month or week at most, which bounds the broadcast.
    """
    return (
        cohorts.join(F.broadcast(cohort_sizes(cohorts)), "cohort_month")
        .withColumn("period", F.explode(_periods(as_of)))
        .select("cohort_month", "cohort_size", "period.*", "customer_id")
    )


def _with_rates(cells: DataFrame, cohort_type: str) -> DataFrame:
    size, kept = (F.col(c).cast("decimal(20,0)") for c in ("cohort_size", "retained_users"))
    return conform(
        cells.withColumns({
            "retention_rate": F.when(F.col("cohort_size") > 0, kept / size).otherwise(F.lit(0)),
            "cohort_type": F.lit(cohort_type),
        }),
        RETENTION.schema,
    )


def _retention(cohorts: DataFrame, days: DataFrame, first: str, last: str, reach: int, as_of: str | date, cohort_type: str) -> DataFrame:
    """Cells from ``days`` (customer_id and a day range each), in one pass per customer.

    A customer is retained in a period when a range touches [period_date, period_date + reach].
    The five answers are five columns, so neither periods nor days are multiplied out, and
    the aggregation per customer reuses the partitioning of the join.
    """
    members = cohorts.select("customer_id", "cohort_month").distinct()
    flags = {}
    for name, _, months in RETENTION_PERIODS:
        due = F.date_add("cohort_month", _offset_days(months))
        hit = (F.col(first) <= F.date_add(due, reach)) & (F.col(last) >= due)
        flags[name] = F.max(F.coalesce(hit.cast("int"), F.lit(0)))
    per_customer = (
        members.join(days, "customer_id", "left")
        .groupBy("customer_id", "cohort_month").agg(*[v.alias(k) for k, v in flags.items()])
    )
    per_cohort = per_customer.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"), *[F.sum(name).alias(name) for name in flags]
    )
    retained = F.element_at(
        F.create_map(*[x for name in flags for x in (F.lit(name), F.col(name))]), F.col("period_name")
    )
    cells = (
        per_cohort.withColumn("period", F.explode(_periods(as_of)))
        .select("*", "period.*").withColumn("retained_users", retained)
    )
    return _with_rates(cells, cohort_type)


def retention_cohorts(
    customers: DataFrame,
    subscriptions: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    end_rule: str = HALF_OPEN,
    grain: str = "month",
) -> DataFrame:
    """Subscription retention from versions: retained means active on the period date.

    Versions are first reduced to the longest active window per customer and start day.
    That loses no coverage, and leaves a customer at most one row per calendar day however
    many subscriptions it has.
    """
    active = (
        version_windows(
            subscriptions.filter(F.col("status") == ACTIVE), as_of, valid_from, valid_to, end_rule
        )
        .groupBy("customer_id", "first_day").agg(F.max("last_day").alias("last_day"))
    )
    cohorts = customer_cohorts(customers, grain)
    return _retention(cohorts, active, "first_day", "last_day", 0, as_of, "subscription")


def retention_from_fact(customers: DataFrame, fact: DataFrame, as_of: str | date, grain: str = "month") -> DataFrame:
    """Subscription retention by looking the period date up in the daily fact.

    Only days that are some cohort's period date are looked at: a few per calendar month, which bounds
    what is broadcast. A fact by ``dt_month`` is read in those months only.
    """
    matrix = cohort_period_matrix(customer_cohorts(customers, grain), as_of)
    dates = matrix.select(F.col("period_date").alias("dt")).distinct()
    used = fact.filter(F.col("status_at_day") == ACTIVE)
    if "dt_month" in fact.columns:
        used = used.join(F.broadcast(dates.select(F.date_format("dt", "yyyy-MM").alias("dt_month")).distinct()), "dt_month", "left_semi")
    active_days = used.join(F.broadcast(dates), "dt", "left_semi").select("customer_id", F.col("dt").alias("period_date")).distinct()
    # The matrix has a customer once per period, and the days are distinct: a count of matches is a count of customers.
    cells = (
        matrix.join(active_days.withColumn("is_retained", F.lit(1)), ["customer_id", "period_date"], "left")
        .groupBy("cohort_month", "cohort_size", "period_name", "period_number", "period_date")
        .agg(F.count("is_retained").alias("retained_users"))
    )
    return _with_rates(cells, "subscription")


def period_dates(cohorts: DataFrame) -> DataFrame:
    """cohort_month, period_number and period_date of every cohort: five rows each."""
    due = [F.struct(F.lit(number).alias("period_number"), F.date_add("cohort_month", _offset_days(months)).alias("period_date")) for _, number, months in RETENTION_PERIODS]
    return cohorts.select("cohort_month", F.explode(F.array(*due)).alias("p")).select("cohort_month", "p.*")


def retention_cells(sizes: DataFrame, retained: DataFrame, as_of: str | date, cohort_type: str) -> DataFrame:
    """Cells from cohort sizes (cohort_month, cohort_size) and counts (cohort_month, period_number, retained_users); no count is none."""
    reached = sizes.withColumn("period", F.explode(_periods(as_of))).select("cohort_month", "cohort_size", "period.*")
    cells = reached.join(retained, ["cohort_month", "period_number"], "left").withColumn("retained_users", F.coalesce("retained_users", F.lit(0)))
    return _with_rates(cells, cohort_type)


def retention_engagement(
    customers: DataFrame, events: DataFrame, as_of: str | date, grain: str = "month"
) -> DataFrame:
    """Engagement retention: retained means an event within a week from the period date on.

    Events are first reduced to the distinct days of each customer.
    """
    days = (
        events.select("customer_id", F.col("event_ts").cast("date").alias("event_day"))
        .filter(F.col("event_day").isNotNull()).distinct()
    )
    cohorts = customer_cohorts(customers, grain)
    return _retention(cohorts, days, "event_day", "event_day", ENGAGEMENT_DAYS - 1, as_of, "engagement")
