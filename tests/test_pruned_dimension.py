"""Merges that read some files against merges of everything."""

import random

import pytest

from tenure.operators.scd2 import scd2_initial, scd2_merge
from tenure.sources.pruned_dimension import PrunedDimension
from tests.conftest import rows

SCHEMA = "a string, b int, v int, note string"
KEYS, TRACKED = ["a", "b"], ["v"]


def stored(spark, tmp_path, **options):
    return PrunedDimension(spark, str(tmp_path / "dim"), KEYS, TRACKED, **options)


def test_random_batches_equal_merges_of_everything(spark, tmp_path):
    rng = random.Random(5)
    dim = stored(spark, tmp_path, rows_per_file=40)
    keys = [(f"k{i}", i % 3) for i in range(600)] + [(None, 1), ("n", None), (None, None)]
    first = spark.createDataFrame([(*k, 0, "first") for k in keys], SCHEMA)
    dim.create(first, "b0", "2025-01-01")
    want, states = rows(scd2_initial(first, "2025-01-01")), {}
    schema = scd2_initial(first, "2025-01-01").schema
    read = []
    for n in range(1, 5):
        changed = [(*k, rng.randrange(2), f"batch {n}") for k in rng.sample(keys, 6)] + [(None, None, n, "nulls")]
        fresh = [(f"new{n}-{i}", None, 1, "new") for i in range(25)]
        keys += [r[:2] for r in fresh]
        changes = spark.createDataFrame({r[:2]: r for r in changed + fresh}.values(), SCHEMA)
        hit = set(dim.files_of(changes, f"b{n - 1}"))
        for name in {r["file"] for r in dim._live(f"b{n - 1}") if r["file"]} - hit:
            held = {(r.a, r.b) for r in spark.read.parquet(f"{dim.path}/open/{name}").collect()}
            assert not held & {(r.a, r.b) for r in changes.collect()}
        merged = dim.merge(changes, f"b{n - 1}", f"b{n}", f"2025-01-0{n + 1}")
        read.append((merged.files_read, merged.files_live))
        assert merged.files_read == len(hit)
        want = rows(scd2_merge(spark.createDataFrame(want, schema), changes, KEYS, f"2025-01-0{n + 1}", TRACKED))
        assert rows(dim.read(f"b{n}")) == want
        states[n] = want
    # At most a file per changed key, and seldom one in vain; new keys find none.
    assert all(some <= 7 + 2 < everything for some, everything in read)
    assert all(rows(dim.read(f"b{n}")) == state for n, state in states.items())


def test_new_keys_rewrite_nothing(spark, tmp_path):
    dim = stored(spark, tmp_path, rows_per_file=500)
    dim.create(spark.range(8000).selectExpr("cast(id as string) a", "0 b", "1 v", "'x' note"), "b0", "2025-01-01")
    fresh = spark.range(8000, 8100).selectExpr("cast(id as string) a", "0 b", "1 v", "'x' note")
    merged = dim.merge(fresh, "b0", "b1", "2025-01-02")
    assert merged.files_live >= 14 and merged.files_read <= 3
    assert dim.read("b1").count() == 8100


def test_many_small_files_are_folded(spark, tmp_path):
    dim = stored(spark, tmp_path, rows_per_file=1000, max_small=3)
    make = lambda low, high: spark.range(low, high).selectExpr("cast(id as string) a", "0 b", "1 v", "'x' note")
    dim.create(make(0, 10), "b0", "2025-01-01")
    seen = [dim.merge(make(10 * n, 10 * n + 10), f"b{n - 1}", f"b{n}", "2025-01-02").files_live for n in range(1, 9)]
    assert max(seen) <= 6 and dim.read("b8").count() == 90
    assert dim.read("b8").filter("active_status = 'Y'").count() == 90


@pytest.mark.parametrize("n", [0, 30])
def test_running_a_batch_again_empty_batches_and_withdrawn_keys(spark, tmp_path, n):
    dim = stored(spark, tmp_path, rows_per_file=10)
    dim.create(spark.range(n).selectExpr("cast(id as string) a", "0 b", "1 v", "'x' note"), "b0", "2025-01-01")
    nothing = spark.createDataFrame([], SCHEMA)
    assert dim.merge(nothing, "b0", "b1", "2025-01-02").files_read == 0
    assert rows(dim.read("b1")) == rows(dim.read("b0")) and dim.read("b0").count() == n
    gone = spark.createDataFrame([("3", 0, 1, "x", True), ("4", 0, 9, "x", False)], SCHEMA + ", gone boolean")
    for _ in range(2):
        dim.merge(gone, "b1", "b2", "2025-01-03", closing="gone")
        state = {(r.a, r.v, r.active_status) for r in dim.read("b2").filter("a in ('3', '4')").collect()}
        assert state == ({("4", 9, "Y")} if not n else {("3", 1, "N"), ("4", 1, "N"), ("4", 9, "Y")})
    with pytest.raises(ValueError):
        dim.merge(gone, "b2", "b1", "2025-01-04")
    with pytest.raises(FileNotFoundError):
        dim.read("b9")


def test_files_do_not_grow_with_the_table_and_changes_are_made_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tenure.sources import pruned_dimension

    monkeypatch.setattr(pruned_dimension, "MAX_FILES", 4)
    dim = stored(spark, tmp_path, rows_per_file=10)
    dim.create(spark.range(400).selectExpr("cast(id as string) a", "0 b", "1 v", "'x' note"), "b0", "2025-01-01")
    assert len([r for r in dim._live("b0") if r["file"]]) <= 4
    made = spark.sparkContext.accumulator(0)

    def counted(x):
        made.add(1)
        return x

    changes = spark.range(395, 405, 1, 1).select(F.udf(counted, "string")(F.col("id").cast("string")).alias("a"), F.lit(0).alias("b"), F.lit(2).alias("v"), F.lit("x").alias("note"))
    dim.merge(changes, "b0", "b1", "2025-01-02")
    assert made.value == 10
    after = dim.read("b1")
    assert after.filter("active_status = 'Y'").count() == 405 and after.filter("v = 2").count() == 10 and after.filter("active_status = 'N'").count() == 5
    assert len([r for r in dim._live("b1") if r["file"]]) <= 8
