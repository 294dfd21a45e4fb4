import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenure.contracts import RETENTION
from tenure.plans.cohorts import (
    cohort_period_matrix,
    cohort_sizes,
    customer_cohorts,
    retention_cohorts,
    retention_engagement,
    retention_from_fact,
)
from tenure.plans.fact import fact_daily
from tests import brute
from tests.conftest import plan_text, rows, ts

CUSTOMER = "customer_id string, created_at timestamp"
VERSION = "subscription_id string, customer_id string, plan_id string, status string, start_date date, end_date date"


def customers(frame, *pairs):
    return frame([(c, ts(t)) for c, t in pairs], CUSTOMER)


def test_membership(frame):
    df = customers(frame, ("a", "2025-03-31 23:59:59"), ("a", "2025-03-31 10:00:00"), ("b", None), ("c", "2025-04-06"))
    assert rows(customer_cohorts(df)) == [
        ("a", date(2025, 3, 1), date(2025, 3, 31)), ("c", date(2025, 4, 1), date(2025, 4, 6)),
    ]
    # 2025-03-31 is a Monday, 2025-04-06 the Sunday after it.
    assert [r.cohort_month for r in customer_cohorts(df, "week").collect()] == [date(2025, 3, 31)] * 2
    with pytest.raises(ValueError):
        customer_cohorts(df, "year")


def test_membership_uses_open_versions(frame):
    df = frame(
        [("a", ts("2025-01-10"), "N"), ("a", ts("2025-03-10"), "Y")], CUSTOMER + ", active_status string"
    )
    assert rows(customer_cohorts(df)) == [("a", date(2025, 3, 1), date(2025, 3, 10))]
    assert customer_cohorts(df, active_only=False).count() == 2


def test_sizes_count_customers_once(frame):
    df = customers(frame, ("a", "2025-03-01"), ("a", "2025-03-02"), ("b", "2025-03-03"))
    assert rows(cohort_sizes(customer_cohorts(df))) == [(date(2025, 3, 1), 2)]


def test_matrix_counts_from_the_first_of_the_month_up_to_as_of(frame):
    df = customer_cohorts(customers(frame, ("a", "2025-03-20"), ("b", "2025-04-20")))
    got = [(r.customer_id, r.period_name, str(r.period_date), r.cohort_size) for r in
           cohort_period_matrix(df, "2025-03-31").orderBy("customer_id", "period_number").collect()]
    assert got == [("a", "W1", "2025-03-08", 1), ("a", "M1", "2025-03-31", 1)]
    out = cohort_period_matrix(df, "2026-12-31")
    assert sorted({str(r.period_date) for r in out.filter("customer_id = 'a'").collect()}) == [
        "2025-03-08", "2025-03-31", "2025-05-30", "2025-08-28", "2026-02-24",
    ]
    plan = plan_text(out)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def cells(df):
    return {
        (r.cohort_month, r.period_name): (r.cohort_size, r.period_number, r.period_date, r.retained_users, r.retention_rate)
        for r in df.collect()
    }


def expected_cells(signups, is_retained, as_of):
    cohorts = {}
    for customer, day in signups.items():
        cohorts.setdefault(day.replace(day=1), []).append(customer)
    out = {}
    for cohort, members in cohorts.items():
        for name, number, due in brute.reached_periods(cohort, as_of):
            kept = sum(is_retained(c, due) for c in members)
            rate = (Decimal(kept) / len(members)).quantize(Decimal("0.0001"), "ROUND_HALF_UP")
            out[cohort, name] = (len(members), number, due, kept, rate)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_subscription_retention_against_brute_force(frame, seed):
    """Several overlapping subscriptions per customer, customers without any, several cohorts."""
    rng = random.Random(seed)
    as_of = date(2025, 6, 30)
    signups = {f"c{i}": date(2025, 1, 1) + timedelta(rng.randrange(150)) for i in range(25)}
    held = []
    for c in list(signups)[:-3]:
        for n in range(rng.randint(1, 3)):
            at = date(2025, 1, 1) + timedelta(rng.randrange(120))
            for _ in range(rng.randint(1, 3)):
                end = at + timedelta(rng.randint(1, 60))
                end = None if end > as_of else end
                held.append((f"{c}-{n}", c, "1", rng.choice(["active", "paused", None]), at, end))
                if end is None:
                    break
                at = end

    def active_on(customer, due):
        return any(
            c == customer and status == "active" and start <= due and (due <= as_of if end is None else due < end)
            for _, c, _, status, start, end in held
        )

    people = frame([(c, datetime.combine(d, datetime.min.time())) for c, d in signups.items()], CUSTOMER)
    versions = frame(held, VERSION)
    plans = frame(
        [("1", "n", Decimal("1.00"), "t", date(2025, 1, 1), None)],
        "plan_id string, plan_name string, monthly_price decimal(10,2), tier string, effective_from date, effective_to date",
    )
    expected = expected_cells(signups, active_on, as_of)
    by_version = retention_cohorts(people, versions, as_of)
    assert cells(by_version) == expected
    assert cells(retention_from_fact(people, fact_daily(versions, plans, as_of), as_of)) == expected
    assert [(f.name, f.dataType) for f in by_version.schema] == [(f.name, f.dataType) for f in RETENTION.schema]
    assert {r.cohort_type for r in by_version.collect()} == {"subscription"}


def test_engagement_within_a_week_from_the_period_date(frame):
    people = customers(frame, ("a", "2025-01-01"), ("b", "2025-01-15"), ("c", "2025-01-20"))
    seen = frame(
        [
            ("a", ts("2025-01-08 00:00:00")),   # first day of W1
            ("a", ts("2025-01-31 12:00:00")),   # first day of M1
            ("b", ts("2025-01-14 23:59:59")),   # last day of W1
            ("b", ts("2025-02-07 00:00:00")),   # a day after M1's week
            ("c", ts("2025-01-07 23:59:59")),   # a day before W1
            ("c", None),
            ("stranger", ts("2025-01-08")),
        ],
        "customer_id string, event_ts timestamp",
    )
    got = {r.period_name: r.retained_users for r in retention_engagement(people, seen, "2025-02-28").collect()}
    assert got == {"W1": 2, "M1": 1}
    weekly = retention_engagement(people, seen, "2025-01-20", "week")
    assert {(str(r.cohort_month), r.period_name) for r in weekly.collect()} == {
        ("2024-12-30", "W1"), ("2025-01-13", "W1"),
    }
    assert weekly.first().cohort_type == "engagement"


def test_a_customer_with_very_many_subscriptions_is_reduced_before_the_join(frame, spark):
    versions = spark.range(5000).select(
        F.concat(F.lit("s"), "id").alias("subscription_id"), F.lit("hot").alias("customer_id"), F.lit("active").alias("status"),
        F.expr("date_add(date'2025-01-01', cast(id % 10 as int))").alias("start_date"),
        F.expr("date_add(date'2025-01-11', cast(id % 40 as int))").alias("end_date"),
    )
    out = retention_cohorts(customers(frame, ("hot", "2025-01-05"), ("cold", "2025-01-06")), versions, "2025-03-31")
    got = {r.period_name: (r.cohort_size, r.retained_users) for r in out.collect()}
    assert got == {"W1": (2, 1), "M1": (2, 1)}
    plan = plan_text(out)
    below_join = plan[plan.index("Join"):]
    assert "partial_max(last_day" in below_join
