import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenure.contracts import FACT_DAILY, KPI_DAILY
from tenure.operators.ranges import fits_broadcast, measured_bytes, overlapping_ranges
from tenure.operators.spine import rejected_windows
from tenure.plans.fact import attach_plan, cut_by_month, daily_partitions, date_spine, fact_daily, plan_timeline
from tenure.plans.kpi import kpi_daily, kpi_daily_changepoints, kpi_deltas, kpi_snapshot
from tests import brute
from tests.conftest import day, money, plan_text, rows

VERSION = "subscription_id string, customer_id string, plan_id string, status string, start_date date, end_date date"
PLAN = "plan_id string, plan_name string, monthly_price decimal(10,2), tier string, effective_from date, effective_to date"
AS_OF = "2025-01-31"


def versions(frame, *items):
    """(subscription, plan, status, start, end) rows."""
    return frame([(s, "c-" + s, p, st, day(a), day(b)) for s, p, st, a, b in items], VERSION)


def plans(frame, *items):
    return frame([(p, "plan " + p, money(x), "tier " + p, day(a), day(b)) for p, x, a, b in items], PLAN)


def spans(df):
    """Subscription and status to its days of January."""
    found = {}
    for r in df.collect():
        found.setdefault((r.subscription_id, r.status_at_day), []).append(r.dt.day)
    return {k: sorted(v) for k, v in found.items()}


CHANGES = [
    ("s", "1", "trialing", "2025-01-05", "2025-01-08"),
    ("s", "1", "active", "2025-01-08", "2025-01-09"),
    ("s", "1", "paused", "2025-01-09", "2025-01-09"),
    ("s", "1", "canceled", "2025-01-29", None),
    ("bad", "1", "active", "2025-01-10", "2025-01-02"),
]


def test_spine_half_open_and_inclusive(frame):
    v = versions(frame, *CHANGES)
    assert spans(date_spine(v, AS_OF)) == {
        ("s", "trialing"): [5, 6, 7], ("s", "active"): [8], ("s", "canceled"): [29, 30, 31],
    }
    assert spans(date_spine(v, AS_OF, end_rule="inclusive")) == {
        ("s", "trialing"): [5, 6, 7, 8], ("s", "active"): [8, 9], ("s", "paused"): [9], ("s", "canceled"): [29, 30, 31],
    }
    assert [r.subscription_id for r in rejected_windows(v).collect()] == ["bad"]
    with pytest.raises(ValueError):
        date_spine(v, AS_OF, end_rule="open")


def test_spine_clip_keeps_the_last_row_before_the_window(frame):
    v = versions(frame, *CHANGES)
    assert spans(date_spine(v, AS_OF, from_dt="2025-01-30", to_dt="2025-01-30")) == {("s", "canceled"): [30]}
    assert spans(date_spine(v, AS_OF, from_dt="2025-01-08", to_dt="2025-01-30", keep_previous=True)) == {
        ("s", "trialing"): [7], ("s", "active"): [8], ("s", "canceled"): [29, 30],
    }
    assert spans(date_spine(v, AS_OF, from_dt="2025-01-31", keep_previous=True)) == {
        ("s", "canceled"): [30, 31],  # one earlier row is all that the window needs
    }


def test_business_time_columns(frame):
    v = versions(frame, ("s", "1", "active", "2025-01-30", None)).withColumnsRenamed(
        {"start_date": "sub_start_date", "end_date": "sub_end_date"}
    )
    assert spans(date_spine(v, AS_OF, "sub_start_date", "sub_end_date")) == {("s", "active"): [30, 31]}


def test_timeline_covers_every_day_once(frame):
    p = plans(frame, ("1", "9.00", "2025-01-05", "2025-01-10"), ("1", "12.00", "2025-01-15", None), ("2", "5.00", "0001-01-01", None))
    got = [(r.plan_id, r.monthly_price, str(r.plan_from), str(r.plan_to)) for r in plan_timeline(p).orderBy("plan_id", "plan_from").collect()]
    assert got == [
        ("1", None, "0001-01-01", "2025-01-04"),
        ("1", Decimal("9.00"), "2025-01-05", "2025-01-10"),
        ("1", None, "2025-01-11", "2025-01-14"),
        ("1", Decimal("12.00"), "2025-01-15", "9999-12-31"),
        ("2", Decimal("5.00"), "0001-01-01", "9999-12-31"),
    ]


def test_overlapping_plan_ranges_fan_out_like_the_daily_join_and_are_reported(frame):
    p = plans(frame, ("1", "9.00", "2025-01-01", "2025-01-20"), ("1", "12.00", "2025-01-05", "2025-01-08"), ("1", "15.00", "2025-01-25", None))
    v = versions(frame, ("s", "1", "active", "2025-01-01", None))
    by_day = attach_plan(date_spine(v, AS_OF), p).select("dt", "monthly_price")
    by_piece = fact_daily(v, p, AS_OF).select("dt", "monthly_price_at_day")
    assert rows(by_day) == rows(by_piece) and by_day.count() == 31 + 4
    assert rows(overlapping_ranges(p, "plan_id", "effective_from", "effective_to")) == [("1", date(2025, 1, 5), date(2025, 1, 8), 1)]
    twice = p.unionByName(p.filter("monthly_price = 15"))
    assert [(r.effective_from.day, r.n_rows) for r in overlapping_ranges(twice, "plan_id", "effective_from", "effective_to").orderBy("effective_from").collect()] == [(5, 1), (25, 2)]


def test_fact_contract_flags_and_unknown_plan(frame):
    p = plans(frame, ("1", "9.00", "2025-01-01", "2025-01-30"))
    v = versions(frame, ("a", "1", "active", "2025-01-30", None), ("b", "?", "trialing", "2025-01-31", None), ("c", "1", None, "2025-01-30", "2025-01-31"))
    out = fact_daily(v, p, AS_OF)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in FACT_DAILY.schema]
    got = {(r.subscription_id, r.dt.day): (r.monthly_price_at_day, r.tier_at_day, r.is_active, r.is_trialing, r.is_canceled) for r in out.collect()}
    assert got == {
        ("a", 30): (Decimal("9.00"), "tier 1", 1, 0, 0),
        ("a", 31): (None, None, 1, 0, 0),
        ("b", 31): (None, None, 0, 1, 0),
        ("c", 30): (Decimal("9.00"), "tier 1", 0, 0, 0),
    }


def test_active_plan_versions_only(frame):
    p = plans(frame, ("1", "9.00", "2025-01-01", None), ("1", "12.00", "2025-01-01", None)).withColumn(
        "active_status", F.when(F.col("monthly_price") > 10, "Y").otherwise("N")
    )
    v = versions(frame, ("s", "1", "active", "2025-01-30", None))
    out = fact_daily(v, p, AS_OF, active_plans_only=True)
    assert [r.monthly_price_at_day for r in out.collect()] == [Decimal("12.00")] * 2


def deltas(frame, *steps):
    """Steps are (day, status, price); the columns are active, new, churn, expansion, contraction, mrr."""
    fact = frame(
        [(date(2025, 1, d), "s", "c", "1", st, money(p)) for d, st, p in steps],
        "dt date, subscription_id string, customer_id string, plan_id string, status_at_day string,"
        " monthly_price_at_day decimal(10,2)",
    )
    cells = {}
    for r in kpi_deltas(kpi_snapshot(fact)).collect():
        values = (r.is_active_today, r.new_mrr, r.churn_mrr, r.expansion_mrr, r.contraction_mrr, r.mrr_today)
        cells[r.dt.day] = tuple(None if v is None else float(v) for v in values)
    return cells


@pytest.mark.parametrize(
    "steps, last",
    [
        ([(1, "active", "9.00")], (1, 9, 0, 0, 0, 9)),
        ([(1, "trialing", "9.00")], (0, 0, 0, 0, 0, 0)),
        ([(1, "trialing", "9.00"), (2, "active", "9.00")], (1, 9, 0, 0, 0, 9)),
        ([(1, "active", "9.00"), (2, "active", "9.00")], (1, 0, 0, 0, 0, 9)),
        ([(1, "active", "9.00"), (2, "active", "12.00")], (1, 0, 0, 3, 0, 12)),
        ([(1, "active", "9.00"), (2, "active", "5.00")], (1, 0, 0, 0, 4, 5)),
        ([(1, "active", "9.00"), (2, "canceled", "12.00")], (0, 0, 9, 0, 0, 0)),
        ([(1, "active", "9.00"), (5, "paused", "9.00")], (0, 0, 9, 0, 0, 0)),
        ([(1, "active", "9.00"), (9, "active", "9.00")], (1, 0, 0, 0, 0, 9)),
        ([(1, "paused", "9.00"), (2, "active", "7.00")], (1, 7, 0, 0, 0, 7)),
        ([(1, "active", None)], (1, None, 0, 0, 0, None)),
        ([(1, "active", "9.00"), (2, "active", None)], (1, 0, 0, 0, 0, None)),
        ([(1, "active", None), (2, "active", "9.00")], (1, 0, 0, 9, 0, 9)),
        ([(1, "active", None), (2, "canceled", "9.00")], (0, 0, 0, 0, 0, 0)),
        ([(1, "active", "9.00"), (2, None, "9.00")], (0, 0, 0, 0, 0, 0)),
    ],
)
def test_movement_rules(frame, steps, last):
    assert deltas(frame, *steps)[steps[-1][0]] == last


def as_cells(df):
    return {
        r.dt: (r.mrr, r.new_mrr, r.expansion_mrr, r.contraction_mrr, r.churn_mrr, r.active_customers, r.arr, r.arpu)
        for r in df.collect()
    }


def random_business(seed, subscriptions=12, horizon=60):
    """Versions that never overlap, with gaps and reactivations, and plans with gaps in their prices."""
    rng = random.Random(seed)
    first = date(2025, 1, 1)
    out = []
    for s in range(subscriptions):
        at = rng.randrange(horizon // 2)
        while at < horizon:
            length = rng.randint(1, 15)
            end = at + length
            status = rng.choice(["active", "active", "trialing", "paused", "canceled", None])
            is_open = end >= horizon
            out.append((f"s{s}", rng.choice("123x"), status, first + timedelta(at), None if is_open else first + timedelta(end)))
            at = end + rng.choice([0, 0, 0, 1, 7])
    price_list = []
    for p in "123":
        at = rng.randrange(10)
        while at < horizon:
            length = rng.randint(3, 20)
            is_open = at + length >= horizon
            price = Decimal(rng.randrange(500, 9999)) / 100
            price_list.append((p, price, first + timedelta(at), None if is_open else first + timedelta(at + length - 1)))
            at += length + rng.choice([0, 0, 4])
    return out, price_list, first + timedelta(horizon - 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kpis_against_brute_force(frame, seed):
    v, p, as_of = random_business(seed)
    vf = frame([(s, "c", pl, st, a, b) for s, pl, st, a, b in v], VERSION)
    pf = frame([(pl, "n", x, "t", a, b) for pl, x, a, b in p], PLAN)
    expected = brute.kpis(brute.day_rows(v, p, as_of))

    full = as_cells(kpi_daily(fact_daily(vf, pf, as_of, for_kpi=True)))
    assert full == expected
    assert as_cells(kpi_daily(fact_daily(vf, pf, as_of))) == expected
    assert as_cells(kpi_daily_changepoints(vf, pf, as_of)) == expected

    inclusive = kpi_daily(fact_daily(vf, pf, as_of, end_rule="inclusive", for_kpi=True))
    assert as_cells(inclusive) == brute.kpis(brute.day_rows(v, p, as_of, inclusive=True))

    window = ("2025-01-20", "2025-02-10")
    inside = {k: c for k, c in expected.items() if date(2025, 1, 20) <= k <= date(2025, 2, 10)}
    assert as_cells(kpi_daily(fact_daily(vf, pf, as_of, for_kpi=True, from_dt=window[0], to_dt=window[1]), *window)) == inside
    assert as_cells(kpi_daily_changepoints(vf, pf, as_of, from_dt=window[0], to_dt=window[1])) == inside

    # Too large to broadcast: the salted join gives the same rows.
    assert as_cells(kpi_daily(fact_daily(vf, pf, as_of, for_kpi=True, max_broadcast_bytes=0))) == expected
    assert as_cells(kpi_daily_changepoints(vf, pf, as_of, max_broadcast_bytes=0)) == expected


def test_days_where_nothing_has_a_price_are_null_not_zero(frame):
    v = versions(frame, ("a", "?", "active", "2025-01-01", "2025-01-03"), ("b", "1", "paused", "2025-01-02", "2025-01-04"))
    p = plans(frame, ("1", "9.00", "2025-01-01", None))
    for out in (kpi_daily(fact_daily(v, p, AS_OF, for_kpi=True)), kpi_daily_changepoints(v, p, AS_OF)):
        cells = as_cells(out)
        assert cells[date(2025, 1, 1)][:2] == (None, None) and cells[date(2025, 1, 1)][6:] == (None, None)
        assert cells[date(2025, 1, 2)][:2] == (Decimal(0), Decimal(0)) and cells[date(2025, 1, 2)][5] == 1
        assert cells[date(2025, 1, 3)][5:] == (0, Decimal(0), Decimal(0))
        assert len(cells) == 3


def test_movement_identity_on_contiguous_versions(frame):
    """mrr(d) - mrr(d-1) = new + expansion - contraction - churn when no row stops or lacks a price."""
    rng = random.Random(11)
    v = []
    for s in range(10):
        cuts = sorted({1, *(rng.randint(2, 30) for _ in range(4))})
        for a, b in zip(cuts, [*cuts[1:], None]):
            v.append((f"s{s}", rng.choice("12"), rng.choice(["active", "paused"]), f"2025-01-{a:02}", b and f"2025-01-{b:02}"))
    p = plans(frame, ("1", "9.00", "2025-01-01", "2025-01-14"), ("1", "7.50", "2025-01-15", None), ("2", "20.00", "2025-01-01", None))
    out = kpi_daily_changepoints(versions(frame, *v), p, AS_OF).orderBy("dt").collect()
    assert len(out) == 31
    for before, r in zip(out, out[1:]):
        assert r.mrr - before.mrr == r.new_mrr + r.expansion_mrr - r.contraction_mrr - r.churn_mrr


def test_kpi_contract_and_rounding(frame):
    p = plans(frame, ("1", "10.00", "2025-01-01", None), ("2", "10.01", "2025-01-01", None))
    v = versions(frame, ("a", "1", "active", "2025-01-31", None), ("b", "2", "active", "2025-01-31", None))
    out = kpi_daily(fact_daily(v, p, AS_OF, for_kpi=True))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in KPI_DAILY.schema]
    assert out.first().arpu == Decimal("10.01")  # 10.005, half up


def test_measured_bytes_bounds_the_broadcast(frame, spark):
    df = frame([("abcd", 1), (None, 2)], "a string, b int")
    assert measured_bytes(df) == 2 * 32 + 4
    assert fits_broadcast(df, 68) and not fits_broadcast(df, 67)
    assert measured_bytes(df.filter("b > 5")) == 0
    assert not fits_broadcast(df.select(F.array("a")), 10**9)


def test_daily_rows_are_not_shuffled_for_the_lag(frame):
    v = versions(frame, ("a", "1", "active", "2025-01-01", None))
    p = plans(frame, ("1", "9.00", "2025-01-01", None))
    plan = plan_text(kpi_daily(fact_daily(v, p, AS_OF, for_kpi=True)))
    above_explode = plan[: plan.index("Generate explode(sequence")]
    assert above_explode.count("Exchange hashpartitioning") == 1, "only the aggregation by day"
    assert "BroadcastHashJoin" in plan and "BatchEvalPython" not in plan
    salted = plan_text(kpi_daily(fact_daily(v, p, AS_OF, for_kpi=True, max_broadcast_bytes=0)))
    assert "__range_salt" in salted


def test_partitions_follow_the_number_of_days(frame, spark):
    v = versions(frame, *CHANGES, ("t", "1", "active", "2025-01-01", None))
    assert date_spine(v, AS_OF).count() == 38
    cores = spark.sparkContext.defaultParallelism
    assert [daily_partitions(v, AS_OF, rows_per_task=n) for n in (38, 37, 2, 1)] == [None, cores, max(19, cores), max(38, cores)]
    assert daily_partitions(v, AS_OF, from_dt="2025-01-30", rows_per_task=4) is None
    p = plans(frame, ("1", "9.00", "2025-01-01", None))
    sized = fact_daily(v, p, AS_OF, for_kpi=True, partitions=3)
    assert rows(kpi_daily(sized)) == rows(kpi_daily(fact_daily(v, p, AS_OF, for_kpi=True)))
    plan = plan_text(kpi_daily(sized))
    assert plan.count("Exchange hashpartitioning(subscription_id") == 1
    assert "REPARTITION_BY_NUM" in plan


def test_a_popular_plan_spreads_over_tasks_when_not_broadcast(frame, spark):
    days = spark.range(2000).select(
        F.concat(F.lit("s"), "id").alias("subscription_id"), F.lit("1").alias("plan_id"), F.lit(date(2025, 1, 3)).alias("dt")
    )
    p = plans(frame, ("1", "9.00", "2025-01-01", None))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = attach_plan(days, p, max_broadcast_bytes=0).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and len(sizes) >= 5 and max(sizes) < 1000


def test_days_placed_by_month_before_they_are_made(spark, frame):
    v = versions(frame, ("s1", "p1", "active", "2024-11-15", "2025-02-03"), ("s1", "p1", "canceled", "2025-02-03", None), ("s2", "p9", "active", "2025-01-31", "2025-02-01"))
    p = plans(frame, ("p1", "9.00", "2024-12-10", None))
    plain = fact_daily(v, p, AS_OF)
    placed = fact_daily(v, p, AS_OF, by_month=True)
    assert rows(placed.drop("dt_month")) == rows(plain)
    assert placed.where("dt_month <> date_format(dt, 'yyyy-MM')").count() == 0
    # Windows are shuffled, not days.
    plan = plan_text(placed)
    assert plan.index("sequence(first_day") < plan.index("Exchange")
    windows = frame([("s1", day("2024-11-15"), day("2025-02-03")), ("s2", day("2025-01-31"), day("2025-01-31"))], "subscription_id string, first_day date, last_day date")
    cut = cut_by_month(windows, rows_per_task=20)
    assert "rangepartitioning(dt_month" in plan_text(cut)
    assert rows(cut, "subscription_id", "first_day") == [
        ("s1", day("2024-11-15"), day("2024-11-30"), "2024-11"), ("s1", day("2024-12-01"), day("2024-12-31"), "2024-12"),
        ("s1", day("2025-01-01"), day("2025-01-31"), "2025-01"), ("s1", day("2025-02-01"), day("2025-02-03"), "2025-02"), ("s2", day("2025-01-31"), day("2025-01-31"), "2025-01"),
    ]
