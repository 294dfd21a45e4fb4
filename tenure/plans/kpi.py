"""Daily revenue KPIs, from the daily fact or straight from version boundaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tenure.contracts import KPI_DAILY, MONEY
from tenure.functions.money import cents, from_cents
from tenure.functions.rules import ACTIVE
from tenure.functions.times import as_date
from tenure.operators.ranges import LAST_DAY, MAX_BROADCAST_BYTES
from tenure.operators.spine import HALF_OPEN
from tenure.plans.fact import priced_windows, subscription_windows


def _movements(
    status: Column, price: Column, before: Column, price_before: Column, zero: Column
) -> dict[str, Column]:
    """What a row means for revenue, given the previous row of the same subscription.

    Prices may be decimals or cents; ``zero`` is of the same type. A null price stays null
    in ``mrr_today`` and ``new_mrr`` (a sum skips it) and counts as nothing in a comparison;
    a null previous price counts as zero.
    """
    was = F.coalesce(price_before, zero)
    is_active = F.coalesce(status == ACTIVE, F.lit(False))
    was_active = F.coalesce(before == ACTIVE, F.lit(False))
    stayed = was_active & is_active
    left = was_active & (status != ACTIVE)
    return {
        "is_active_today": is_active.cast("int"),
        "new_mrr": F.when(is_active & ~was_active, price).otherwise(zero),
        "churn_mrr": F.when(left, was).otherwise(zero),
        "expansion_mrr": F.when(stayed & (price > was), price - was).otherwise(zero),
        "contraction_mrr": F.when(stayed & (price < was), was - price).otherwise(zero),
        "mrr_today": F.when(is_active, price).otherwise(zero),
    }


MONEY_COLUMNS = ["mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr"]


def _finish(totals: DataFrame) -> DataFrame:
    """Totals in cents to the contract types, with ARR and ARPU."""
    active, mrr = F.col("active_customers"), from_cents(F.col("mrr"))
    values = {c: from_cents(F.col(c)) for c in MONEY_COLUMNS} | {
        "arr": mrr * 12,
        "arpu": F.when(active > 0, mrr / active).otherwise(F.lit(0)),
    }
    return totals.select([
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in KPI_DAILY.schema
    ])


def _within(df: DataFrame, from_dt: str | date | None, to_dt: str | date | None) -> DataFrame:
    if from_dt is not None:
        df = df.filter(F.col("dt") >= as_date(from_dt))
    if to_dt is not None:
        df = df.filter(F.col("dt") <= as_date(to_dt))
    return df


def _history(fact: DataFrame) -> WindowSpec:
    """Rows of one subscription in order; ``version_no`` orders rows that share a day."""
    order = ["dt", "version_no"] if "version_no" in fact.columns else ["dt"]
    return Window.partitionBy("subscription_id").orderBy(*order)


def kpi_snapshot(fact: DataFrame) -> DataFrame:
    """The fact with status and price of the previous row of the same subscription."""
    history = _history(fact)
    return fact.select(
        "dt", "subscription_id", "customer_id", "plan_id", "status_at_day", "monthly_price_at_day",
        F.lag("status_at_day").over(history).alias("prev_status"),
        F.lag("monthly_price_at_day").over(history).alias("prev_price"),
    )


def kpi_deltas(snapshot: DataFrame) -> DataFrame:
    """Revenue movement per subscription and day."""
    moves = _movements(
        F.col("status_at_day"), F.col("monthly_price_at_day"),
        F.col("prev_status"), F.col("prev_price"), F.lit(0).cast(MONEY),
    )
    types = {f.name: f.dataType for f in snapshot.schema}
    money = types["monthly_price_at_day"]
    return snapshot.select("dt", "subscription_id", *[
        (v if k == "is_active_today" else v.cast(money)).alias(k) for k, v in moves.items()
    ])


def kpi_daily(
    fact: DataFrame, from_dt: str | date | None = None, to_dt: str | date | None = None
) -> DataFrame:
    """One row per day that has fact rows: the deltas of ``kpi_deltas`` summed, in cents.

    Give ``from_dt`` when the fact was built with ``for_kpi`` for a window: the rows before
    it only serve as previous rows.
    """
    history = _history(fact)
    price = F.col("price_cents") if "price_cents" in fact.columns else cents(F.col("monthly_price_at_day"))
    rows = fact.select(
        "dt", F.col("status_at_day").alias("status"), price.alias("price"),
        F.lag("status_at_day").over(history).alias("before"),
        F.lag(price).over(history).alias("price_before"),
    )
    moves = _movements(
        F.col("status"), F.col("price"), F.col("before"), F.col("price_before"), F.lit(0).cast("long")
    )
    return _finish(
        _within(rows, from_dt, to_dt).groupBy("dt").agg(
            F.sum(moves["mrr_today"]).alias("mrr"),
            F.sum(moves["new_mrr"]).alias("new_mrr"),
            F.sum(moves["expansion_mrr"]).alias("expansion_mrr"),
            F.sum(moves["contraction_mrr"]).alias("contraction_mrr"),
            F.sum(moves["churn_mrr"]).alias("churn_mrr"),
            F.sum(moves["is_active_today"]).alias("active_customers"),
        )
    )


def kpi_daily_changepoints(
    subscriptions: DataFrame,
    plans: DataFrame,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    from_dt: str | date | None = None,
    to_dt: str | date | None = None,
    active_plans_only: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The same KPIs as ``kpi_daily`` over half-open versions, without expanding days.

    Versions of one subscription must not overlap (see ``one_at_a_time``; ``overlapping_ranges`` finds
    offenders), since a running total can't tell which of two rows of a day comes first.

    Revenue only moves where a version or a plan price begins or ends. Versions are cut at
    plan price changes, each piece states what it adds on its first day and removes after
    its last, and a running sum over the days turns that into daily totals. Work follows
    the number of versions, not the number of days; the running sum sees one row per day.
    """
    changes = kpi_changes(subscriptions, plans, as_of, valid_from, valid_to, active_plans_only, max_broadcast_bytes)
    return _within(_from_levels(changes), from_dt, to_dt)


#: What a piece of a version adds from its first day to its last, and what it adds on its first day only.
LEVELS = ["rows", "unpriced", "active", "mrr"]
ONCE = ["new_unpriced", "new_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr"]


def kpi_changes(
    subscriptions: DataFrame,
    plans: DataFrame,
    as_of: str | date = LAST_DAY,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    active_plans_only: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Per day, by how much the levels change and what is added once: a sum over subscriptions, so changes of disjoint sets of them add up.

    With the last day of the calendar as ``as_of``, open versions have no end, and the changes hold for every as-of day.
    """
    windows = subscription_windows(subscriptions, as_of, valid_from, valid_to, HALF_OPEN)
    pieces = priced_windows(windows, plans, active_plans_only, max_broadcast_bytes).select(
        "subscription_id", "version_no", "status", cents(F.col("monthly_price")).alias("price"),
        F.col("first_day").alias("starts"), F.col("last_day").alias("ends"),
    )
    history = Window.partitionBy("subscription_id").orderBy("starts", "version_no")
    zero = F.lit(0).cast("long")
    moves = _movements(F.col("status"), F.col("price"), F.col("before"), F.col("price_before"), zero)
    moved = pieces.withColumns({
        "before": F.lag("status").over(history),
        "price_before": F.lag("price").over(history),
    }).select("starts", "ends", *[v.alias(k) for k, v in moves.items()])

    # Rows without a price are counted, because a sum over nothing but nulls is null.
    levels = dict(zip(LEVELS, [F.lit(1), F.col("mrr_today").isNull().cast("int"), F.col("is_active_today"), F.coalesce("mrr_today", zero)], strict=True))
    once = dict(zip(ONCE, [
        F.col("new_mrr").isNull().cast("long"), F.coalesce("new_mrr", zero), F.col("expansion_mrr"), F.col("contraction_mrr"), F.col("churn_mrr"),
    ], strict=True))
    begin = F.struct(
        F.col("starts").alias("dt"),
        *[v.alias(k) for k, v in {**levels, **once}.items()],
    )
    end = F.struct(
        F.date_add("ends", 1).alias("dt"),
        *[(-v).alias(k) for k, v in levels.items()], *[zero.alias(k) for k in once],
    )
    both = F.array_compact(F.array(begin, F.when(F.col("ends") < as_date(LAST_DAY), end)))
    return (
        moved.select(F.explode(both).alias("c")).select("c.*")
        .groupBy("dt").agg(*[F.sum(c).alias(c) for c in [*LEVELS, *ONCE]])
    )


def kpi_from_changes(changes: DataFrame, as_of: str | date) -> DataFrame:
    """The KPIs of every day up to ``as_of`` from ``kpi_changes`` that hold for every as-of day."""
    return _from_levels(changes.filter(F.col("dt") <= as_date(as_of)), as_of)


def _from_levels(changes: DataFrame, as_of: str | date | None = None) -> DataFrame:
    # From here on there is one row per calendar day at most.
    zero = F.lit(0).cast("long")
    to_date = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    next_change = F.lead("dt").over(Window.orderBy("dt"))
    if as_of is not None:
        next_change = F.coalesce(next_change, F.date_add(as_date(as_of), 1))
    level = changes.withColumns({
        **{c: F.sum(c).over(to_date) for c in LEVELS},
        "next_dt": next_change,
    }).filter("rows > 0")
    daily = level.withColumn(
        "day", F.explode(F.sequence(F.col("dt"), F.date_sub("next_dt", 1), F.expr("interval 1 day")))
    )
    moved_today = F.col("day") == F.col("dt")

    def today(name: str) -> Column:
        return F.when(moved_today, F.col(name)).otherwise(zero)

    totals = daily.select(
        F.col("day").alias("dt"),
        F.when(F.col("rows") > F.col("unpriced"), F.col("mrr")).alias("mrr"),
        F.when(F.col("rows") > today("new_unpriced"), today("new_mrr")).alias("new_mrr"),
        today("expansion_mrr").alias("expansion_mrr"),
        today("contraction_mrr").alias("contraction_mrr"),
        today("churn_mrr").alias("churn_mrr"),
        F.col("active").alias("active_customers"),
    )
    return _finish(totals)
