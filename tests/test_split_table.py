"""Parts that split: contents against a plain dictionary, bounded rewriting, digests."""

import random

import pytest
from pyspark.sql import functions as F

from tenure.operators.dedup import latest_by
from tenure.sources import split_table as st
from tenure.sources.files import folders, size
from tests.conftest import plan_text, rows

SCHEMA = "id string, n int, v string"


def newest(df):
    return latest_by(df, ["id"], ["n"])


def check(table):
    """The directory is prefix-free and complete, and every row lies in the part of its key."""
    parts = table.parts()
    names = [p.part for p in parts]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert sum(2.0 ** -(len(n) - 1) for n in names) == 1
    for p in parts:
        held = table.read([p.part])
        assert held.count() == p.n_rows
        assert held.where(~F.startswith(st.key_bits(table.keys), F.lit(p.part))).count() == 0


def test_batches_against_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"], max_bytes=6_000, partition_by=["n"])
    want = {}
    for load in range(4):
        batch = [(f"k{rng.randrange(900)}", load, f"v{rng.random()}") for _ in range(600 if load == 0 else 150)]
        batch = list({b[0]: b for b in batch}.values()) + [(None, load, "null key")]
        want |= {b[0]: b for b in batch}
        df = spark.createDataFrame(batch, SCHEMA)
        if load == 0:
            table.create(df)
        else:
            table.upsert(df, newest)
            before = sorted(map(str, rows(table.read().select("id", F.col("n").cast("int"), "v"))))
            table.upsert(df, newest)  # running a batch again changes nothing
            assert sorted(map(str, rows(table.read().select("id", F.col("n").cast("int"), "v")))) == before
        got = {r.id: (r.id, int(r.n), r.v) for r in table.read().collect()}
        assert got == want
        check(table)
    assert len(table.parts()) > 4


@pytest.mark.parametrize("n", [4_000, 16_000])
def test_a_small_batch_rewrites_a_bounded_number_of_bytes(spark, tmp_path, n):
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"], max_bytes=20_000)
    table.create(spark.range(n).select(F.col("id").cast("string"), F.lit(0).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
    check(table)
    parts = len(table.parts())
    assert parts >= n // 600
    touched = table.upsert(spark.createDataFrame([("7", 1, "x"), ("new", 1, "y")], SCHEMA), newest)
    assert len(touched) <= 2
    newest_generation = sorted(int(f.split("=")[1]) for f in folders(spark, table.path) if f.startswith("generation="))[-1]
    assert size(spark, f"{table.path}/generation={newest_generation}") <= 2 * 25_000
    assert {r.v for r in table.read().where("id in ('7', 'new')").collect()} == {"x", "y"} and table.read().count() == n + 1
    # A read of the touched parts lists their files only.
    assert len(table.read(touched).inputFiles()) < len(table.read().inputFiles()) / 2


def test_superseded_files_go_with_the_next_batch(spark, tmp_path):
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"])
    table.create(spark.createDataFrame([("a", 0, "x")], SCHEMA))
    reader = table.read()
    table.upsert(spark.createDataFrame([("b", 0, "x")], SCHEMA), newest)
    assert reader.count() == 1, "a reader of the last directory still finds its files"
    table.upsert(spark.createDataFrame([("c", 0, "x")], SCHEMA), newest)
    assert size(spark, f"{table.path}/generation=0") < 500
    assert table.read().count() == 3


def test_no_rows_one_key_and_new_columns(spark, tmp_path):
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"], max_bytes=2_000)
    table.create(spark.createDataFrame([], SCHEMA))
    assert table.read().columns == ["id", "n", "v"] and table.read().count() == 0
    assert table.upsert(spark.createDataFrame([], SCHEMA), newest) == []
    hot = spark.range(2_000).select(F.lit("hot").alias("id"), F.col("id").cast("int").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.upsert(hot, lambda both: both)
    assert table.read().count() == 2_000 and len([p for p in table.parts() if p.n_rows]) == 1
    table.upsert(spark.createDataFrame([("w", 1, "v", 9.5)], SCHEMA + ", extra double"), lambda both: both)
    assert {r.extra for r in table.read().collect()} == {None, 9.5}
    check(table)


def test_digests_tell_which_parts_changed(spark, tmp_path):
    wanted = spark.range(3_000).select(F.col("id").cast("string"), F.lit(0).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"], max_bytes=20_000, digest_columns=["id", "n", "v"])
    table.create(wanted)
    assert table.differing(wanted.orderBy(F.rand(3))) == []
    changed = wanted.withColumn("v", F.when(F.col("id") == "17", "other").otherwise(F.col("v"))).where("id <> '40'")
    changed = changed.unionByName(spark.createDataFrame([("new", 0, "x")], SCHEMA))
    assert table.differing(changed) == table.touched(spark.createDataFrame([("17", 0, ""), ("40", 0, ""), ("new", 0, "")], SCHEMA))
    assert "Scan" not in plan_text(table.located(wanted)).replace("Scan ExistingRDD", "").replace("Range", "")


def test_parts_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "MAX_PARTS", 10)
    rows_of = lambda low, high: spark.range(low, high).select(F.col("id").cast("string"), F.lit(0).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = st.SplitTable(spark, str(tmp_path / "t"), ["id"], max_bytes=5_000, digest_columns=["id", "n", "v"])
    table.create(rows_of(0, 3_000))
    check(table)
    assert 8 <= len(table.parts()) <= 10
    table.upsert(rows_of(2_500, 6_000), newest)
    check(table)
    assert len(table.parts()) <= 10 and table.read().count() == 6_000 and table.differing(rows_of(0, 6_000)) == []
    # Measured by other rows, which stand for those that take long to make.
    other = st.SplitTable(spark, str(tmp_path / "u"), ["id"], max_bytes=50_000)
    other.create(rows_of(0, 100).where("id % 2 = 0"), measured=rows_of(0, 3_000))
    assert len(other.parts()) >= 4 and other.read().count() == 50
