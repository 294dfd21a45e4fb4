"""The as-of merge against brute force, hot keys included; coalescing against days."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tenure.operators.asof import asof_join
from tenure.operators.islands import coalesced
from tenure.plans.fact import fact_daily
from tests.conftest import day, money, plan_text, rows

FIRST = date(2024, 1, 1)


def tables(rng, n_facts, hot):
    versions, at = [], {}
    for k in ["a", "b", "c", None]:
        d = FIRST + timedelta(rng.randrange(30))
        for _ in range(rng.randrange(1, 12)):
            end = d + timedelta(rng.randrange(0, 20))
            versions.append((k, d, end if rng.random() < 0.8 else None, f"{k}{d}"))
            d = end + timedelta(1 + rng.randrange(8))
        at[k] = d
    keys = ["a"] * hot + ["b", "c", "none", None]
    facts = [(i, rng.choice(keys), FIRST + timedelta(int(rng.random() ** 3 * 200)) if rng.random() < 0.97 else None) for i in range(n_facts)]
    return facts, versions


def brute(facts, versions):
    out = []
    for i, k, d in facts:
        begun = [(f, t, v) for key, f, t, v in versions if key is not None and key == k and d is not None and f <= d]
        last = max(begun, key=lambda x: x[0], default=None)
        out.append((i, k, d, last[2] if last and (last[1] is None or d <= last[1]) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    facts, versions = tables(rng, 600, 1 if seed % 2 else 20)
    f = spark.createDataFrame(facts, "id int, k string, dt date")
    v = spark.createDataFrame(versions, "k string, f date, t date, v string")
    joined = asof_join(f, v, "k", "dt", "f", "t", ["id"], rows_per_stretch=(50, 10_000)[seed % 3 == 0])
    assert joined.columns == ["id", "k", "dt", "v"]
    assert "CartesianProduct" not in plan_text(joined) and "NestedLoop" not in plan_text(joined)
    assert sorted((tuple(r) for r in joined.collect()), key=str) == brute(facts, versions)


def test_a_day_with_half_of_all_facts_spreads(spark):
    facts = spark.range(4_000).select("id", F.lit("a").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(day("2024-03-01"))).otherwise(F.date_add(F.lit(FIRST), (F.col("id") % 90).cast("int"))).alias("dt"))
    versions = spark.createDataFrame([("a", day("2024-01-10"), None, 1), ("a", day("2024-03-01"), None, 2)], "k string, f date, t date, v int")
    joined = asof_join(facts, versions, "k", "dt", "f", "t", ["id"], rows_per_stretch=100)
    assert joined.where("dt >= '2024-03-01'").select("v").distinct().collect()[0].v == 2
    # Tasks of the merge: no stretch has much more than its share, and versions are not copied per task.
    from tenure.operators import asof

    told = facts.select(F.col("k").alias("key"), asof._place(F.col("dt"), F.lit(asof._SPREAD) + F.pmod(F.xxhash64("id"), F.lit(asof._SPREAD))).alias("place"))
    bounds = asof._bounds(told, 100)
    sizes = [r["count"] for r in asof._stretched(told, bounds).groupBy("stretch").count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 300


def test_no_rows(spark):
    f = spark.createDataFrame([], "id int, k string, dt date")
    v = spark.createDataFrame([], "k string, f date, t date, v string")
    assert asof_join(f, v, "k", "dt", "f", "t").count() == 0
    one = spark.createDataFrame([(1, "a", FIRST)], "id int, k string, dt date")
    assert rows(asof_join(one, v, "k", "dt", "f")) == [(1, "a", FIRST, None, None)]


def test_coalesced_versions_give_the_same_days(spark):
    rng = random.Random(3)
    versions = []
    for s in range(40):
        d = FIRST
        for _ in range(rng.randrange(1, 9)):
            end = d + timedelta(rng.randrange(0, 12))
            versions.append((f"s{s}", f"c{s}", rng.choice(["p1", "p1", "p2", None]), rng.choice(["active", "active", "canceled"]), d, end))
            d = end + timedelta(rng.choice([0, 0, 0, 3]))
        versions.append((f"s{s}", f"c{s}", "p1", "active", d, None))
    df = spark.createDataFrame(versions, "subscription_id string, customer_id string, plan_id string, status string, start_date date, end_date date")
    joined = coalesced(df, ["subscription_id"], ["customer_id", "plan_id", "status"])
    plans = spark.createDataFrame([("p1", "a", "t", money("9.00"), FIRST, None, None)], "plan_id string, plan_name string, tier string, monthly_price decimal(10,2), effective_from date, effective_to date, x string")
    assert rows(fact_daily(joined, plans, "2024-06-01")) == rows(fact_daily(df, plans, "2024-06-01"))
    used = [v for v in versions if v[5] is None or v[4] < v[5]]
    meets = [a[0] == b[0] and a[5] == b[4] and a[1:4] == b[1:4] for a, b in zip(used, used[1:], strict=False)]
    assert joined.count() == len(used) - sum(meets) < len(used) - 20
    # Nothing more can be joined.
    assert rows(coalesced(joined, ["subscription_id"], ["customer_id", "plan_id", "status"]).select(joined.columns)) == rows(joined)


@pytest.mark.parametrize("seed", range(3))
def test_days_with_many_facts_are_merged_in_place_of_them(spark, seed):
    rng = random.Random(seed)
    _, versions = tables(rng, 0, 1)
    facts = [(i, rng.choice(["a", "a", "b", "none", None]), FIRST + timedelta(rng.randrange(40)) if rng.random() < 0.97 else None) for i in range(2_000)]
    f = spark.createDataFrame(facts, "id int, k string, dt date")
    v = spark.createDataFrame(versions, "k string, f date, t date, v string")
    joined = asof_join(f, v, "k", "dt", "f", "t", ["id"], rows_per_stretch=50)
    assert joined.columns == ["id", "k", "dt", "v"]
    assert sorted((tuple(r) for r in joined.collect()), key=str) == brute(facts, versions)
    # The facts are neither shuffled nor sorted.
    left = plan_text(joined).split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in left and "Sort" not in left and "Exchange" not in left
