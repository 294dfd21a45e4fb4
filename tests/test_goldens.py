"""Hand-made rows with answers worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest

from tenure.contracts import CUSTOMERS, PLANS
from tenure.operators.spine import rejected_windows
from tenure.plans.cohorts import cohort_sizes, customer_cohorts, retention_cohorts, retention_from_fact
from tenure.plans.fact import date_spine, fact_daily, one_at_a_time, price_ranges
from tenure.plans.kpi import kpi_daily, kpi_daily_changepoints
from tests.conftest import day, money, ts

AS_OF = "2025-03-31"
BUSINESS = {"valid_from": "sub_start_date", "valid_to": "sub_end_date"}


@pytest.fixture(scope="module")
def tables(spark):
    t = ts("2025-01-01")
    customers = [("c1", "h", "IN", ts("2025-01-05"), t), ("c2", "h", "US", ts("2025-01-20"), t), ("c3", "h", "GB", ts("2025-02-03"), t), ("c4", "h", "DE", None, t)]
    plans = [("p1", "Basic", money("10.00"), "basic", day("2025-01-01"), day("2025-02-28"), t), ("p1", "Basic", money("15.00"), "basic", day("2025-03-01"), None, t),
             ("p2", "Pro", money("40.00"), "pro", day("2025-01-01"), None, t)]
    subscriptions = [
        ("s1", "c1", "p1", "active", day("2025-01-05"), None),                # 10, from March 15
        ("s2", "c2", "p2", "active", day("2025-01-20"), day("2025-02-10")),   # 40, then on plan 1
        ("s2", "c2", "p1", "active", day("2025-02-10"), None),
        ("s3", "c3", "p2", "trialing", day("2025-02-03"), day("2025-02-17")),
        ("s3", "c3", "p2", "canceled", day("2025-02-17"), day("2025-03-01")),
        ("s4", "c3", "p2", "active", day("2025-03-01"), day("2025-03-11")),
        ("s4", "c3", "p2", "paused", day("2025-03-11"), None),
        ("s5", "c4", "p1", "active", day("2025-02-02"), day("2025-02-02")),   # covers no day
        ("s6", "c4", "p1", "active", day("2025-02-09"), day("2025-02-01")),   # ends before it begins
    ]
    return {
        "customers": spark.createDataFrame(customers, CUSTOMERS.schema), "plans": spark.createDataFrame(plans, PLANS.schema),
        "subscriptions": spark.createDataFrame(subscriptions, "subscription_id string, customer_id string, plan_id string, status string, sub_start_date date, sub_end_date date"),
    }


def test_days(tables):
    assert rejected_windows(tables["subscriptions"], **BUSINESS).count() == 1
    assert date_spine(tables["subscriptions"], AS_OF, **BUSINESS).count() == 86 + 71 + 26 + 31
    assert date_spine(tables["subscriptions"], AS_OF, end_rule="inclusive", **BUSINESS).count() == 86 + 72 + 28 + 32 + 1


def test_kpis(tables):
    expected = {  # mrr, new, expansion, contraction, churn, active
        date(2025, 1, 5): (10, 10, 0, 0, 0, 1), date(2025, 1, 20): (50, 40, 0, 0, 0, 2), date(2025, 2, 9): (50, 0, 0, 0, 0, 2),
        date(2025, 2, 10): (20, 0, 0, 30, 0, 2), date(2025, 3, 1): (70, 40, 10, 0, 0, 3), date(2025, 3, 10): (70, 0, 0, 0, 0, 3),
        date(2025, 3, 11): (30, 0, 0, 0, 40, 2), date(2025, 3, 31): (30, 0, 0, 0, 0, 2),
    }
    daily = kpi_daily(fact_daily(tables["subscriptions"], tables["plans"], AS_OF, for_kpi=True, **BUSINESS))
    changes = kpi_daily_changepoints(tables["subscriptions"], tables["plans"], AS_OF, **BUSINESS)
    for out in (daily, changes):
        got = {r.dt: r for r in out.collect()}
        assert len(got) == 86
        for d, (mrr, new, up, down, churn, n) in expected.items():
            r = got[d]
            assert (r.mrr, r.new_mrr, r.expansion_mrr, r.contraction_mrr, r.churn_mrr, r.active_customers) == (mrr, new, up, down, churn, n), d
            assert r.arr == 12 * mrr and r.arpu == (Decimal(mrr) / n).quantize(Decimal("0.01"))
        assert sum(r.new_mrr for r in got.values()) == 90 and sum(r.churn_mrr for r in got.values()) == 40


def test_window_alone_equals_the_whole(tables):
    whole = {r.dt: r for r in kpi_daily(fact_daily(tables["subscriptions"], tables["plans"], AS_OF, for_kpi=True, **BUSINESS)).collect()}
    for first in ("2025-02-10", "2025-03-01", "2025-03-11", "2025-03-20"):
        part = fact_daily(tables["subscriptions"], tables["plans"], AS_OF, for_kpi=True, from_dt=first, **BUSINESS)
        got = {r.dt: r for r in kpi_daily(part, first).collect()}
        assert got == {d: r for d, r in whole.items() if d >= date.fromisoformat(first)}
        earlier = part.filter(f"dt < '{first}'")
        assert earlier.count() == earlier.select("subscription_id").distinct().count()


def test_retention(tables):
    sizes = {r.cohort_month: r.cohort_size for r in cohort_sizes(customer_cohorts(tables["customers"])).collect()}
    assert sizes == {date(2025, 1, 1): 2, date(2025, 2, 1): 1}
    # Periods begin on the first of the cohort's month: 8 and 31 January, 1 April is past; 8 February and 3 March.
    expected = {(1, "W1"): 1, (1, "M1"): 2, (2, "W1"): 0, (2, "M1"): 1}
    fact = fact_daily(tables["subscriptions"], tables["plans"], AS_OF, **BUSINESS)
    for out in (retention_cohorts(tables["customers"], tables["subscriptions"], AS_OF, **BUSINESS), retention_from_fact(tables["customers"], fact, AS_OF)):
        assert {(r.cohort_month.month, r.period_name): r.retained_users for r in out.collect()} == expected


def test_overlapping_inputs_are_cut(frame):
    lists = [("p", day("2025-01-01"), None, "Y"), ("p", day("2025-03-01"), None, "Y"), ("p", day("2025-01-01"), None, "N")]
    ranges = price_ranges(frame(lists, "plan_id string, effective_from date, effective_to date, active_status string"))
    assert sorted((str(r.effective_from), str(r.effective_to)) for r in ranges.collect()) == [("2025-01-01", "2025-02-28"), ("2025-03-01", "None")]
    versions = frame([("s", "a", day("2025-01-01"), ts("2025-01-05"), None), ("s", "b", day("2025-02-01"), ts("2025-02-05"), None), ("s", "late", day("2024-12-01"), ts("2025-03-05"), None),
                      ("s", "twin", day("2025-01-15"), ts("2025-02-05"), None)],
                     "subscription_id string, status string, sub_start_date date, start_date timestamp, end_date timestamp")
    got = {r.status: (str(r.start_date)[:10], str(r.end_date)[:10]) for r in one_at_a_time(versions).collect()}
    assert got == {"a": ("2025-01-05", "2025-02-05"), "twin": ("2025-02-05", "2025-02-05"), "b": ("2025-02-05", "None")}
