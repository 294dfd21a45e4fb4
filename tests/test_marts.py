"""Marts by changes against full rebuilds."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tenure import jobs
from tenure.jobs import Layout, current, land, load_bronze, load_dimensions, load_kpi_changes, load_silver, read_kpi_changes
from tenure.contracts import PLANS, SUBSCRIPTIONS
from tenure.marts import RetentionMart
from tenure.operators.bitmaps import bit_counts, bitmaps, merged_bitmaps, numbered
from tenure.plans import cohorts, kpi
from tenure.plans.fact import fact_daily, price_ranges
from tests.conftest import day, money, rows, ts

FIRST = date(2025, 1, 1)


def plans(spark, updated, basic):
    t = ts(updated)
    return spark.createDataFrame([("p1", "Basic", money(basic), "basic", FIRST, None, t), ("p2", "Pro", money("29.00"), "pro", FIRST, date(2025, 3, 1), t),
                                  ("p2", "Pro", money("31.00"), "pro", date(2025, 3, 2), None, t)], PLANS.schema)


def loads(rng, n):
    """Three loads of subscriptions: all, then some changed and some new, twice."""
    state, out = {}, []
    for k, at in enumerate(("2025-02-01", "2025-02-10", "2025-03-05")):
        changed = {}
        ids = range(n) if k == 0 else [*rng.sample(range(n), 4), n + 10 * k, n + 10 * k + 1]
        for i in ids:
            start = state[i][4] if i in state and rng.random() < 0.6 else FIRST + timedelta(rng.randrange(25 * (k + 1)))
            status = rng.choice(["active", "active", "trialing", "canceled"])
            end = start + timedelta(rng.randrange(1, 60)) if status == "canceled" else None
            changed[i] = (f"s{i:03d}", f"c{i % 7}", rng.choice(["p1", "p2", "p9"]), status, start, end, ts(at))
        state |= changed
        out.append((at, list(changed.values())))
    return out


def test_kpis_by_changes_equal_a_rebuild_after_every_load(spark, tmp_path):
    rng, layout, previous = random.Random(7), Layout(str(tmp_path / "lake")), None
    business = ("sub_start_date", "sub_end_date")
    for k, (at, subscriptions) in enumerate(loads(rng, 60)):
        batch = f"b{k}"
        extracts = {"subscriptions": spark.createDataFrame(subscriptions, SUBSCRIPTIONS.schema)}
        if k != 1:  # the second load leaves prices alone, the third reprices a plan
            extracts["plans"] = plans(spark, at, "9.00" if k == 0 else "12.50")
        if k == 0:
            extracts["customers"] = spark.createDataFrame([("c0", "0f" * 32, "IN", ts("2025-01-03"), ts(at))], jobs.CUSTOMERS.schema)
        land(extracts, layout, batch)
        load_bronze(spark, layout, batch, f"{at} 06:00:00", list(extracts))
        load_silver(spark, layout, batch, tables=list(extracts))
        load_dimensions(spark, layout, batch, f"{at} 06:00:00", previous_batch=previous)
        prices = price_ranges(jobs.dimension(spark, layout, "plans", batch))
        for valid in (("start_date", "end_date"), business):
            touched = load_kpi_changes(spark, layout, batch, previous, *valid, max_bytes=4_000)
            as_of = "2025-02-15" if k == 1 else "2025-04-01"
            want = kpi.kpi_daily_changepoints(jobs.subscription_versions(spark, layout, batch, *valid), prices, as_of, *valid).where(F.col("dt") <= as_of)
            assert rows(read_kpi_changes(spark, layout, batch, as_of, *valid)) == rows(want), (batch, valid, as_of)
            if k == 1:  # a batch that was applied is not applied again
                assert load_kpi_changes(spark, layout, batch, previous, *valid, max_bytes=4_000).versions_read == 0
                assert rows(read_kpi_changes(spark, layout, batch, as_of, *valid)) == rows(want)
            if k == 1:
                assert touched.subscriptions == 6 and touched.versions_read < 25 and touched.parts_read < touched.parts
            if k == 2:
                assert touched.subscriptions > 6, "subscriptions of a repriced plan are touched"
        previous = batch
    assert current(spark, layout, "subscriptions").count() > 60


def test_a_batch_that_stopped_in_the_middle(spark, tmp_path):
    from tenure.marts import KpiMart

    mart = KpiMart(spark, str(tmp_path / "mart"))
    schema = "subscription_id string, customer_id string, plan_id string, status string, sub_start_date date, sub_end_date date, start_date timestamp, end_date timestamp, active_status string"
    prices = spark.createDataFrame([("p1", FIRST, None, money("10.00"))], "plan_id string, effective_from date, effective_to date, monthly_price decimal(10,2)")
    one = spark.createDataFrame([(f"s{i}", "c", "p1", "active", FIRST, None, ts("2025-01-02"), None, "Y") for i in range(5)], schema)
    two = spark.createDataFrame([("s1", "c", "p1", "active", FIRST, None, ts("2025-01-02"), ts("2025-01-05"), "N"), ("s1", "c", "p1", "canceled", FIRST, None, ts("2025-01-05"), None, "Y")], schema)
    mart.update("b0", one, prices)
    mart.update("b1", two, prices, "b0")
    want = rows(mart.read("b1", "2025-01-10"))
    assert {r[0]: r[6] for r in want}[date(2025, 1, 6)] == 4
    # The versions were stored and the mark was not.
    from tenure.sources.files import delete

    delete(spark, mart._at("applied", "b1"))
    mart.update("b1", two, prices, "b0")
    assert rows(mart.read("b1", "2025-01-10")) == want


def test_numbers_and_bitmaps(spark, tmp_path):
    keys = spark.range(70_000).select(F.col("id").cast("string").alias("k"))
    first = numbered(keys.where("k % 2 = 0").unionByName(keys.where("k % 4 = 0")), "k", None, str(tmp_path / "a"))
    first.write.parquet(str(tmp_path / "first"))
    first = spark.read.parquet(str(tmp_path / "first"))
    every = numbered(keys.unionByName(spark.createDataFrame([(None,)], "k string")), "k", first, str(tmp_path / "b"))
    got = {r.k: r.number for r in every.collect()}
    assert sorted(got.values()) == list(range(1, 70_001)) and all(got[r.k] == r.number for r in first.collect())
    numbers = every.withColumn("g", (F.col("number") % 3).cast("int"))
    a, b = (bitmaps(numbers.where(f"number % {m} = 0"), ["g"], "number") for m in (2, 5))
    want = {r.g: r.n for r in numbers.where("number % 2 = 0 or number % 5 = 0").groupBy("g").agg(F.count_distinct("number").alias("n")).collect()}
    assert {r.g: r.n for r in bit_counts(merged_bitmaps([a, b], ["g"]), ["g"]).collect()} == want


def test_retention_by_bitmaps_equals_counting(spark, tmp_path):
    rng = random.Random(4)
    customers = spark.createDataFrame([(f"c{i}", ts("2024-01-01") + timedelta(rng.randrange(300)) if i % 9 else None) for i in range(300)], "customer_id string, created_at timestamp")
    versions = []
    for i in range(300):
        d = date(2024, 1, 1) + timedelta(rng.randrange(200))
        for _ in range(rng.randrange(1, 4)):
            end = d + timedelta(rng.randrange(1, 90))
            versions.append((f"s{i}", f"c{i}", "p1", rng.choice(["active", "canceled"]), d, end))
            d = end
    subs = spark.createDataFrame(versions, "subscription_id string, customer_id string, plan_id string, status string, start_date date, end_date date")
    prices = spark.createDataFrame([("p1", "a", "t", money("9.00"), FIRST, None)], "plan_id string, plan_name string, tier string, monthly_price decimal(10,2), effective_from date, effective_to date")
    fact = fact_daily(subs, prices, "2025-06-01").cache()
    mart, previous, low = RetentionMart(spark, str(tmp_path / "m")), None, "2024-01-01"
    for k, high in enumerate(("2024-05-01", "2024-10-01", "2025-07-01")):
        known = customers.where(F.col("created_at") < high)
        part = fact.where((F.col("dt") >= low) & (F.col("dt") < high))
        days = spark.sql(f"SELECT explode(sequence(date'{low}', date_sub(date'{high}', 1), interval 1 day)) AS dt")
        for _ in range(2):  # running a load again changes nothing
            mart.update(f"b{k}", known, part, days, previous)
        previous, low = f"b{k}", high
    assert rows(mart.read("b2", "2025-06-01")) == rows(cohorts.retention_cohorts(customers, subs, "2025-06-01"))
    assert rows(mart.sizes("b2")) == rows(cohorts.cohort_sizes(cohorts.customer_cohorts(customers)))
    # A month that is stated anew counts as it now is.
    none = fact.limit(0)
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2025-06-30', interval 1 day)) AS dt")
    mart.update("b3", customers, none, days, "b2")
    assert all(r.retained_users == 0 for r in mart.read("b3", "2025-06-01").collect())
