from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenure.contracts import CUSTOMERS, INVOICES, KPI_DAILY, PLANS, RETENTION, SUBSCRIPTIONS
from tenure.jobs import (
    Layout,
    current,
    dimension,
    land,
    load_bronze,
    load_dimensions,
    load_event_stream,
    load_fact,
    load_gold,
    load_silver,
    read_kpis,
    read_retention,
    rejected,
    violations,
)
from tenure.plans.kpi import kpi_daily
from tenure.sources.dimension_store import retire_open_versions
from tenure.sources.tables import landing_path, read_table
from tenure.streaming.events import late_rows
from tests.conftest import day, money, rows, ts

HASH = "0f" * 32


def batch(spark, updated, subscriptions, basic="9.00"):
    t = ts(updated)
    make = lambda data, contract: spark.createDataFrame(data, contract.schema)
    return {
        "customers": make([("c1", HASH, "IN", ts("2025-01-03"), t), ("c2", HASH, "gb", ts("2025-01-20"), t),
                           ("c3", "jo@example.com", "US", ts("2025-01-20"), t)], CUSTOMERS),
        "plans": make([("p1", "Basic", money(basic), "basic", day("2025-01-01"), None, t),
                       ("p2", "Pro", money("29.00"), "pro", day("2025-01-01"), None, t)], PLANS),
        "subscriptions": make([(*s, t) for s in subscriptions], SUBSCRIPTIONS),
        "invoices": make([("i1", "c1", "s1", day("2025-01-05"), money("9.00"), "USD", True, None, t),
                          ("i2", "c2", "s2", day("2025-01-05"), money("-1.00"), "USD", True, None, t)], INVOICES),
    }


def events(spark, layout, batch_id, *items):
    spark.createDataFrame(
        [(e, "login", at, (c, None, None)) for e, c, at in items],
        "event_id string, event_type string, event_ts string,"
        " payload struct<customer_id:string,amount:decimal(10,2),failure_reason:string>",
    ).write.json(landing_path(layout.landing, "events", batch_id))


def test_two_loads_end_to_end(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    first = [("s1", "c1", "p1", "trialing", day("2025-01-03"), None), ("s2", "c2", "p2", "active", day("2025-01-20"), None)]
    land(batch(spark, "2025-02-01", first), layout, "b1")
    events(spark, layout, "b1", ("e1", "c1", "2025-01-08T10:00:00Z"), ("e1", "c1", "2025-01-08T10:00:00Z"))
    (tmp_path / "lake/landing/events/batch=b1/broken.json").write_text("no json\n")
    load_bronze(spark, layout, "b1", "2025-02-01 06:00:00")
    assert [r._corrupt_record for r in read_table(spark, landing_path(layout.bronze, "events_unreadable", "b1")).collect()] == ["no json"]
    load_silver(spark, layout, "b1")
    load_dimensions(spark, layout, "b1", "2025-02-01 06:00:00")
    load_fact(spark, layout, "b1", "2025-02-10")

    # The second load is incremental: only the changed subscription and the repriced plan arrive.
    second = batch(spark, "2025-02-05", [("s1", "c1", "p1", "active", day("2025-01-03"), None)], basic="12.00")
    land({"subscriptions": second["subscriptions"], "plans": second["plans"].filter("plan_id = 'p1'")}, layout, "b2")
    load_bronze(spark, layout, "b2", "2025-02-05 06:00:00", ["subscriptions", "plans"])
    for _ in range(2):  # running a batch again changes nothing
        load_silver(spark, layout, "b2", tables=["subscriptions", "plans"])
        load_dimensions(spark, layout, "b2", "2025-02-05 06:00:00", previous_batch="b1")
    load_fact(spark, layout, "b2", "2025-02-10", from_dt="2025-02-01")
    load_gold(spark, layout, "b2", "2025-02-10")

    assert {r.customer_id for r in current(spark, layout, "customers").collect()} == {"c1", "c2"}
    assert [(r.customer_id, r.rule) for r in rejected(spark, layout, "customers").collect()] == [("c3", "raw_email")]
    assert [r.invoice_id for r in current(spark, layout, "invoices").collect()] == ["i1"]
    assert [(r.invoice_id, r.rule) for r in rejected(spark, layout, "invoices").collect()] == [("i2", "quality")]
    assert current(spark, layout, "events").count() == 1
    assert current(spark, layout, "subscriptions").count() == 2, "the first load is still there"
    incremental = {t: rows(current(spark, layout, t)) for t in ("customers", "plans", "subscriptions", "invoices", "events")}
    load_silver(spark, layout)
    assert {t: rows(current(spark, layout, t)) for t in incremental} == incremental, "a rebuild from all batches gives the same"
    history = dimension(spark, layout, "subscriptions", "b2").orderBy("subscription_id", "start_date").collect()
    assert [(r.subscription_id, r.status, r.active_status, r.start_date.day, r.end_date and r.end_date.day) for r in history] == [
        ("s1", "trialing", "N", 1, 5), ("s1", "active", "Y", 5, None), ("s2", "active", "Y", 1, None),
    ]
    assert {(r.plan_id, r.monthly_price, r.active_status) for r in dimension(spark, layout, "plans", "b2").collect()} == {
        ("p1", Decimal("9.00"), "N"), ("p1", Decimal("12.00"), "Y"), ("p2", Decimal("29.00"), "Y"),
    }
    assert dimension(spark, layout, "subscriptions", "b1").count() == 2, "an earlier batch can still be read"

    kpis = read_kpis(spark, layout)
    assert kpis.columns == KPI_DAILY.schema.names
    got = {r.dt: (r.mrr, r.new_mrr, r.active_customers) for r in kpis.collect()}
    assert got[date(2025, 2, 4)] == (Decimal("29.00"), Decimal("0.00"), 1)
    assert got[date(2025, 2, 5)] == (Decimal("41.00"), Decimal("12.00"), 2)
    assert len(got) == 10
    stored_fact = read_table(spark, layout.silver("fact_subscription_daily"))
    assert rows(kpi_daily(stored_fact)) == rows(kpis)

    cells = read_retention(spark, layout)
    assert cells.columns == RETENTION.schema.names
    assert {(r.cohort_type, r.period_name, r.cohort_size, r.retained_users) for r in cells.collect()} == {
        ("subscription", "W1", 2, 0), ("subscription", "M1", 2, 0),
        ("engagement", "W1", 2, 1), ("engagement", "M1", 2, 0),
    }

    assert violations(spark, layout).collect() == []

    business = layout.gold("gold_kpi_daily")
    load_gold(spark, layout, "b2", "2025-02-10", "sub_start_date", "sub_end_date")
    assert read_table(spark, business).count() == (date(2025, 2, 10) - date(2025, 1, 3)).days + 1
    load_fact(spark, layout, "b2", "2025-02-10", valid_from="sub_start_date", valid_to="sub_end_date")
    facts = read_table(spark, layout.silver("fact_subscription_daily"))
    assert facts.count() == facts.select("subscription_id", "dt").distinct().count()
    assert rows(kpi_daily(facts)) == rows(read_kpis(spark, layout))


def lake(spark, tmp_path, loads, as_of):
    """One layout after loads of (as-of, extracts), each merged into the one before."""
    layout, previous, since = Layout(str(tmp_path / "lake")), None, {}
    for n, (at, extracts) in enumerate(loads):
        batch_id = f"b{n}"
        since = since | land(extracts, layout, batch_id, since)
        load_bronze(spark, layout, batch_id, f"{at} 06:00:00", list(extracts))
        load_silver(spark, layout, batch_id, tables=list(extracts))
        load_dimensions(spark, layout, batch_id, f"{at} 06:00:00", previous_batch=previous)
        previous = batch_id
    return layout, previous, since


def test_every_price_range_and_stretch_of_a_subscription_counts(spark, tmp_path):
    t = ts("2025-01-01")
    first = batch(spark, "2025-01-01", [("s1", "c1", "p1", "active", day("2025-01-01"), None)])
    first["plans"] = spark.createDataFrame(
        [("p1", "Basic", money("9.00"), "basic", day("2025-01-01"), None, t), ("p1", "Basic", money("12.00"), "basic", day("2025-04-01"), None, t)], PLANS.schema)
    first["subscriptions"] = spark.createDataFrame(
        [("s1", "c1", "p1", "active", day("2025-01-01"), None, t), ("s2", "c2", "p1", "canceled", day("2025-01-01"), day("2025-01-10"), t),
         ("s2", "c2", "p1", "active", day("2025-02-01"), None, t)], SUBSCRIPTIONS.schema)
    layout, last, since = lake(spark, tmp_path, [("2025-01-02", first)], "2025-04-10")
    assert since["plans"] == datetime(2025, 1, 1)
    load_gold(spark, layout, last, "2025-04-10", "sub_start_date", "sub_end_date")
    mrr = {r.dt: r.mrr for r in read_kpis(spark, layout).collect()}
    assert mrr[date(2025, 1, 31)] == Decimal("9.00") and mrr[date(2025, 2, 10)] == Decimal("18.00") and mrr[date(2025, 4, 1)] == Decimal("24.00")
    load_gold(spark, layout, last, "2025-02-10")
    assert {r.dt: r.mrr for r in read_kpis(spark, layout).collect()}[date(2025, 2, 10)] == Decimal("18.00")


def test_business_time_forgets_what_was_replaced(spark, tmp_path):
    one = batch(spark, "2025-01-01", [("s1", "c1", "p1", "active", day("2025-01-01"), None)])
    two = batch(spark, "2025-02-05", [("s1", "c1", "p1", "canceled", day("2025-01-01"), day("2025-02-05"))])
    layout, last, _ = lake(spark, tmp_path, [("2025-01-02", one), ("2025-02-05", {"subscriptions": two["subscriptions"]})], "2025-02-10")
    business = {"valid_from": "sub_start_date", "valid_to": "sub_end_date"}
    load_fact(spark, layout, last, "2025-02-10", **business)
    load_gold(spark, layout, last, "2025-02-10", **business)
    facts = read_table(spark, layout.silver("fact_subscription_daily"))
    assert facts.count() == facts.select("subscription_id", "dt").distinct().count() == 35
    assert rows(kpi_daily(facts)) == rows(read_kpis(spark, layout))
    assert all(r.mrr == 0 for r in read_kpis(spark, layout).collect())


def test_a_rejected_newest_row_closes_its_key(spark, tmp_path):
    one = batch(spark, "2025-01-01", [("s1", "c1", "p1", "active", day("2025-01-01"), None)])
    two = batch(spark, "2025-02-05", [("s1", "c1", "p1", "canceled", day("2025-01-01"), None)])
    layout, last, _ = lake(spark, tmp_path, [("2025-01-02", one), ("2025-02-05", {"subscriptions": two["subscriptions"]})], "2025-02-10")
    assert [r.rule for r in rejected(spark, layout, "subscriptions").collect()] == ["lifecycle"]
    versions = dimension(spark, layout, "subscriptions", last).collect()
    assert [(r.active_status, r.end_date.day) for r in versions] == [("N", 5)]


def test_new_columns_and_unusable_values_are_kept(spark, tmp_path):
    layout = Layout(str(tmp_path))
    plain = batch(spark, "2025-01-01", [])["plans"]
    land({"plans": plain}, layout, "b1")
    odd = spark.createDataFrame([("p9", "Odd", "free", "x", "2025-01-01", None, "2025-01-02 00:00:00", "EU")],
                                "plan_id string, plan_name string, monthly_price string, tier string, effective_from string, effective_to string, last_updated string, region string")
    land({"plans": odd}, layout, "b2", {"plans": "2025-01-01"})
    for b in ("b1", "b2"):
        load_bronze(spark, layout, b, "2025-01-03 00:00:00", ["plans"])
        load_silver(spark, layout, b, tables=["plans"])
    got = {r.plan_id: r for r in current(spark, layout, "plans").collect()}
    assert got["p9"].region == "EU" and got["p1"].region is None and got["p9"].monthly_price is None
    rejects = read_table(spark, landing_path(layout.bronze, "plans_rejects", "b2")).collect()
    assert [r.columns for r in rejects] == [["monthly_price"]] and '"free"' in rejects[0].row


def test_a_month_that_loses_its_rows_is_removed(spark, tmp_path):
    one = batch(spark, "2025-01-01", [("s1", "c1", "p1", "active", day("2025-01-01"), day("2025-03-15"))])
    one["subscriptions"] = one["subscriptions"].withColumn("status", F.lit("canceled"))
    two = batch(spark, "2025-02-05", [("s1", "c1", "p1", "canceled", day("2025-01-01"), day("2025-01-20"))])
    layout, last, _ = lake(spark, tmp_path, [("2025-01-02", one)], "2025-04-10")
    business = {"valid_from": "sub_start_date", "valid_to": "sub_end_date"}
    load_fact(spark, layout, last, "2025-04-10", **business)
    assert {r.dt_month for r in read_table(spark, layout.silver("fact_subscription_daily")).select("dt_month").distinct().collect()} == {"2025-01", "2025-02", "2025-03"}
    land({"subscriptions": two["subscriptions"]}, layout, "b9")
    load_bronze(spark, layout, "b9", "2025-02-05 06:00:00", ["subscriptions"])
    load_silver(spark, layout, "b9", tables=["subscriptions"])
    load_dimensions(spark, layout, "b9", "2025-02-05 06:00:00", previous_batch=last)
    load_fact(spark, layout, "b9", "2025-04-10", from_dt="2025-02-01", **business)
    assert {r.dt_month for r in read_table(spark, layout.silver("fact_subscription_daily")).select("dt_month").distinct().collect()} == {"2025-01"}


def test_open_versions_are_retired(spark, tmp_path):
    one = batch(spark, "2025-01-01", [("s1", "c1", "p1", "active", day("2025-01-01"), None)])
    two = batch(spark, "2025-02-05", [("s1", "c1", "p2", "active", day("2025-01-01"), None)])
    layout, last, _ = lake(spark, tmp_path, [("2025-01-02", one), ("2025-02-05", {"subscriptions": two["subscriptions"]})], "2025-02-10")
    before = rows(dimension(spark, layout, "subscriptions", last))
    assert retire_open_versions(spark, layout.silver("subscriptions_scd2"), last) == ["b0"]
    assert rows(dimension(spark, layout, "subscriptions", last)) == before and len(before) == 2


def test_fact_window_starts_with_a_month(spark, tmp_path):
    with pytest.raises(ValueError, match="first of a month"):
        load_fact(spark, Layout(str(tmp_path)), "b1", "2025-02-10", from_dt="2025-02-02")


def test_event_stream_appends_what_is_new(spark, tmp_path):
    layout = Layout(str(tmp_path))
    folder = tmp_path / "landing/event_stream"
    folder.mkdir(parents=True)
    line = '{{"event_id":"{0}","event_ts":"2025-01-{1:02d}T00:00:00Z","payload":{{"customer_id":"c"}}}}\n'
    odd = '{"event_id":"x","payload":{"customer_id":"c"}}\n{"event_id":"y","event_ts":"soon"}\nno json\n'
    (folder / "1.json").write_text(line.format("a", 1) + line.format("a", 1) + line.format("b", 9) + odd)
    load_event_stream(spark, layout)
    (folder / "2.json").write_text(line.format("b", 9) + line.format("c", 10) + line.format("late", 2))
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    query = load_event_stream(spark, layout, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == shuffle
    out = read_table(spark, layout.silver("event_stream"))
    assert sorted(r.event_id for r in out.collect()) == ["a", "b", "c"]
    broken = read_table(spark, layout.silver("event_stream_unreadable")).collect()
    assert sorted((r.event_id or "", r.reason) for r in broken) == [("", "not_json"), ("x", "timestamp"), ("y", "timestamp")]
    assert [r.event_id for r in read_table(spark, layout.silver("event_stream_late")).collect()] == ["late"]
    assert late_rows(query) == 1
