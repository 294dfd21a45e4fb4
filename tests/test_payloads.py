"""Drifting payloads: every field of every batch reads back."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.sources.payloads import field, fields_seen, read_lines, shredded

KNOWN = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("amount", T.DecimalType(10, 2))])


def test_a_field_that_first_shows_in_the_second_batch(spark, tmp_path):
    rng = random.Random(1)
    first = [{"id": f"a{i}", "n": i, "amount": i / 4} for i in range(20)]
    second = [{"id": f"b{i}", "n": i if i % 3 else "many", "extra": {"os": rng.choice("xyz"), "deep": [1, {"k": i}]}, "flag": i % 2 == 0, "none": None} for i in range(20)]
    for k, batch in enumerate((first, second)):
        (tmp_path / f"{k}.json").write_text("\n".join(json.dumps(r) for r in batch) + "\n\n")
        rows = shredded(read_lines(spark, [str(tmp_path / f"{k}.json")]), KNOWN)
        rows.write.parquet(str(tmp_path / "table"), mode="append")
    stored = spark.read.parquet(str(tmp_path / "table"))
    got = {r.id: r for r in stored.select("id", "n", "amount", field("$.extra.os", "string").alias("os"), field("$.extra.deep[1].k", "int").alias("k"),
                                            field("$.flag", "boolean").alias("flag"), field("$.n", "string").alias("odd"), F.to_json("rest").alias("rest"), "unreadable").collect()}
    for r in first:
        g = got[r["id"]]
        assert (g.n, float(g.amount), g.os, g.k, g.flag, g.rest, g.unreadable) == (r["n"], r["amount"], None, None, None, "{}", None)
    for r in second:
        g = got[r["id"]]
        number = r["n"] if r["n"] != "many" else None
        assert (g.n, g.amount, g.os, g.k, g.flag) == (number, None, r["extra"]["os"], r["extra"]["deep"][1]["k"], r["flag"])
        assert g.odd == (None if number is not None else "many"), "a value that doesn't fit stays in the rest"
        assert json.loads(g.rest).keys() == {"extra", "flag", "none"} | (set() if number is not None else {"n"})
    seen = {(r.field, r.n_rows) for r in fields_seen(stored).groupBy("field").agg(F.sum("n_rows").alias("n_rows")).collect()}
    assert seen == {("extra", 20), ("flag", 20), ("none", 20), ("n", 7)}


def test_lines_that_are_no_objects(spark):
    lines = ["", "  ", "no json", "[1]", "7", "null", '{"id":"x","id":"y"}', '{"id":"z"', "{}"]
    got = [tuple(r) for r in shredded(spark.createDataFrame([(t, 1) for t in lines], "value string, batch int"), KNOWN).select("batch", "id", "unreadable").collect()]
    broken = ["no json", "[1]", "7", "null", '{"id":"x","id":"y"}', '{"id":"z"']
    assert sorted(map(str, got)) == sorted(map(str, [*((1, None, t) for t in broken), (1, None, None)]))
    assert shredded(spark.createDataFrame([], "value string"), KNOWN).columns == ["id", "n", "amount", "rest", "unreadable"]
