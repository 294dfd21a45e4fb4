import random
from datetime import datetime

import pytest

from tenure.operators.scd2 import (
    row_hash,
    scd2_changes,
    scd2_initial,
    scd2_merge,
    scd2_staged,
    scd2_step,
)
from tenure.operators.updates import conditional_update
from tenure.plans.dimensions import PLAN_TRACKED, merge_plans
from tenure.sources.dimension_store import create_dimension, merge_dimension, read_dimension
from tests.conftest import day, money, plan_text, rows, ts

SCHEMA = "id string, a string, b string, last_updated timestamp"
T0, T1, T2, T3 = (f"2025-01-0{i} 00:00:00" for i in (1, 2, 3, 4))


def state(df):
    """(id, a, b, start, end, flag) without the load metadata."""
    return sorted(
        ((r.id, r.a, r.b, str(r.start_date)[:10], str(r.end_date)[:10] if r.end_date else None, r.active_status)
         for r in df.collect()),
        key=str,
    )


def source(frame, *pairs, updated="2025-01-01"):
    return frame([(k, a, b, ts(updated)) for k, a, b in pairs], SCHEMA)


def test_new_changed_same_and_missing(frame):
    target = scd2_initial(source(frame, ("same", "x", "1"), ("chg", "x", "1"), ("gone", "x", "1")), T0)
    now = source(frame, ("same", "x", "1"), ("chg", "y", "1"), ("new", "n", None), updated="2025-01-02")
    assert state(scd2_merge(target, now, ["id"], T1)) == [
        ("chg", "x", "1", "2025-01-01", "2025-01-02", "N"),
        ("chg", "y", "1", "2025-01-02", None, "Y"),
        ("gone", "x", "1", "2025-01-01", None, "Y"),
        ("new", "n", None, "2025-01-02", None, "Y"),
        ("same", "x", "1", "2025-01-01", None, "Y"),
    ]
    closed = state(scd2_merge(target, now, ["id"], T1, close_missing=True))
    assert ("gone", "x", "1", "2025-01-01", "2025-01-02", "N") in closed and len(closed) == 5


def test_metadata_alone_is_no_change_and_merging_twice_changes_nothing(frame):
    target = scd2_initial(source(frame, ("k", "x", "1")), T0)
    again = source(frame, ("k", "x", "1"), updated="2025-06-01")
    once = scd2_merge(target, again, ["id"], T1)
    assert state(once) == state(target)
    changed = source(frame, ("k", "y", "1"))
    first = scd2_merge(target, changed, ["id"], T1)
    assert state(scd2_merge(first, changed, ["id"], T2)) == state(first)


def test_value_moved_between_nullable_columns_is_a_change(frame):
    target = scd2_initial(source(frame, ("k", "v", None)), T0)
    moved = source(frame, ("k", None, "v"))
    assert len(state(scd2_merge(target, moved, ["id"], T1))) == 2
    hashes = {r.row_hash for df in (target, moved) for r in row_hash(df, ["id", "a", "b"]).collect()}
    assert len(hashes) == 1, "the hash alone would have missed it"


def test_there_and_back_compares_with_the_open_version_only(frame):
    dim = scd2_initial(source(frame, ("k", "A", "1")), T0)
    for value, at in (("B", T1), ("A", T2), ("A", T3)):
        dim = scd2_merge(dim, source(frame, ("k", value, "1")), ["id"], at)
    assert state(dim) == [
        ("k", "A", "1", "2025-01-01", "2025-01-02", "N"),
        ("k", "A", "1", "2025-01-03", None, "Y"),
        ("k", "B", "1", "2025-01-02", "2025-01-03", "N"),
    ]


def test_changes_and_staged_rows(frame):
    target = scd2_merge(
        scd2_initial(source(frame, ("c", "x", "1"), ("s", "x", "1")), T0), source(frame, ("c", "y", "1")), ["id"], T1
    )
    changes = scd2_changes(source(frame, ("c", "z", "1"), ("s", "x", "1"), ("n", "n", "n")), target, ["id"])
    assert {(r.id, r.a, r.tgt_a) for r in changes.collect()} == {("c", "z", "y"), ("n", "n", None)}
    staged = {(r.MERGEKEY, r.id) for r in scd2_staged(changes, ["id"]).collect()}
    assert staged == {("c", "c"), (None, "c"), ("n", "n")}


def test_composite_keys(frame):
    schema = "k1 string, k2 int, v string"
    target = scd2_initial(frame([("a", 1, "x"), ("a", 2, "x")], schema), T0)
    now = frame([("a", 1, "x"), ("a", 2, "y")], schema)
    out = scd2_merge(target, now, ["k1", "k2"], T1)
    assert sorted((r.k2, r.v, r.active_status) for r in out.collect()) == [(1, "x", "Y"), (2, "x", "N"), (2, "y", "Y")]
    keys = {r.MERGEKEY for r in scd2_staged(scd2_changes(now, target, ["k1", "k2"]), ["k1", "k2"]).collect()}
    assert keys == {'{"k1":"a","k2":"2"}', None}


def test_plan_versions_keep_their_tier(frame):
    schema = (
        "plan_id string, plan_name string, monthly_price decimal(10,2), tier string, effective_from date,"
        " effective_to date, last_updated timestamp"
    )
    plans = frame(
        [("1", "Basic", money("9.00"), "basic", day("2025-01-01"), None, ts("2025-01-01")),
         ("2", "Pro", money("29.00"), "pro", day("2025-01-01"), None, ts("2025-01-01"))],
        schema,
    )
    from pyspark.sql import functions as F

    repriced = conditional_update(plans, F.col("plan_name") == "Basic", {"monthly_price": F.lit(101)})
    assert repriced.schema["monthly_price"].dataType.simpleString() == "decimal(10,2)"
    out = merge_plans(scd2_initial(plans.filter(F.col("plan_name").isin("Basic")), T0), repriced, T1)
    got = sorted((r.plan_name, str(r.monthly_price), r.tier, r.active_status) for r in out.collect())
    assert got == [("Basic", "101.00", "basic", "Y"), ("Basic", "9.00", "basic", "N"), ("Pro", "29.00", "pro", "Y")]
    assert "tier" in PLAN_TRACKED


def test_many_random_loads_keep_the_invariants(frame):
    rng = random.Random(7)
    expected = {}
    dim = None
    for i in range(4):
        at = f"2025-02-0{i + 1} 00:00:00"
        present = {k: rng.choice("xyz") for k in "abcdefgh" if rng.random() < 0.7}
        src = source(frame, *[(k, v, None) for k, v in present.items()])
        dim = scd2_initial(src, at) if dim is None else scd2_merge(dim, src, ["id"], at)
        for k, v in present.items():
            history = expected.setdefault(k, [])
            if not history or history[-1] != v:
                history.append(v)
    found = {}
    for r in dim.orderBy("id", "start_date").collect():
        found.setdefault(r.id, []).append(r)
    assert {k: [r.a for r in v] for k, v in found.items()} == expected
    for versions in found.values():
        assert [r.active_status for r in versions] == ["N"] * (len(versions) - 1) + ["Y"]
        for before, after in zip(versions, versions[1:]):
            assert before.end_date == after.start_date


def test_step_returns_only_open_and_newly_closed(frame):
    first = scd2_initial(source(frame, ("k", "A", "1")), T0)
    second = scd2_merge(first, source(frame, ("k", "B", "1")), ["id"], T1)
    step = scd2_step(second, source(frame, ("k", "C", "1")), ["id"], T2)
    assert [(r.a, r.active_status) for r in step.orderBy("a").collect()] == [("B", "N"), ("C", "Y")]


def test_dimension_store_equals_merging_in_memory(frame, spark, tmp_path):
    root = str(tmp_path / "dim")
    loads = [("b1", T0, "A"), ("b2", T1, "B"), ("b3", T2, "C")]
    src = lambda v: source(frame, ("k", v, "1"), ("fixed", "f", None), ("n" + v, v, v))
    dim = scd2_initial(src("A"), T0)
    create_dimension(src("A"), root, "b1", T0)
    for (previous, _, _), (batch, at, value) in zip(loads, loads[1:]):
        dim = scd2_merge(dim, src(value), ["id"], at)
        for _ in range(2):  # a repeated batch replaces itself
            merge_dimension(spark, src(value), root, dim.schema, previous, batch, ["id"], at)
    stored = read_dimension(spark, root, dim.schema, "b3")
    assert stored.columns == dim.columns
    assert rows(stored) == rows(dim)
    assert state(read_dimension(spark, root, dim.schema, "b1")) == state(scd2_initial(src("A"), T0))
    with pytest.raises(ValueError, match="sort after"):
        merge_dimension(spark, src("D"), root, dim.schema, "b3", "b3", ["id"], T3)


def test_null_keys_and_repeated_keys(frame):
    target = scd2_initial(source(frame, ("k", "x", "1"), (None, "x", "1")), T0)
    for at in (T1, T2, T3):  # the same load again and again opens nothing
        target = scd2_merge(target, source(frame, ("k", "x", "1"), (None, "x", "1")), ["id"], at)
    assert state(target) == [("k", "x", "1", "2025-01-01", None, "Y"), (None, "x", "1", "2025-01-01", None, "Y")]
    twice = frame([("k", "old", "1", ts("2025-01-01")), ("k", "new", "1", ts("2025-01-02"))], SCHEMA)
    opened = [v for v in state(scd2_merge(target, twice, ["id"], T3)) if v[5] == "Y" and v[0] == "k"]
    assert opened == [("k", "new", "1", "2025-01-04", None, "Y")]
    assert scd2_changes(source(frame, (None, "x", "1")), target, ["id"]).count() == 0


def test_withdrawn_keys_close(frame):
    target = scd2_initial(source(frame, ("k", "x", "1"), ("m", "x", "1")), T0)
    now = source(frame, ("k", "y", "1"), ("m", "x", "1"), ("n", "x", "1")).selectExpr("*", "id <> 'm' AS gone")
    assert state(scd2_merge(target, now, ["id"], T1, ["a", "b"], closing="gone")) == [
        ("k", "x", "1", "2025-01-01", "2025-01-02", "N"), ("m", "x", "1", "2025-01-01", None, "Y"),
    ]


def test_chained_merges_read_the_target_once(frame, spark, tmp_path):
    source(frame, ("k", "x", "1")).write.parquet(str(tmp_path / "s"))
    now = spark.read.parquet(str(tmp_path / "s"))
    dim = scd2_initial(now, T0)
    for n, at in enumerate((T1, T2, T3), 2):
        dim = scd2_merge(dim, now, ["id"], at)
        assert plan_text(dim).count("FileScan") == n


def test_stamp_is_the_given_time(frame):
    assert scd2_initial(source(frame, ("k", "A", "1")), T0).first().start_date == datetime(2025, 1, 1)
