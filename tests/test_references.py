"""Reference counts against the full check, batch after batch."""

import random

import pytest

from tenure.operators.checks import fk_orphans
from tenure.sources.references import ReferenceCounts, deltas


def test_batches_against_the_full_check(spark, tmp_path):
    rng = random.Random(5)
    counts = ReferenceCounts(spark, str(tmp_path / "counts"), max_bytes=3_000)
    children, parents = [], []
    for n in range(4):
        come_c = [(rng.choice([None, *(f"k{rng.randrange(300)}" for _ in range(9))]),) for _ in range(200)]
        come_p = [(f"k{rng.randrange(300)}",) for _ in range(40)]
        gone_c = rng.sample(children, min(len(children), 60))
        gone_p = rng.sample(parents, min(len(parents), 25))
        for x in gone_c:
            children.remove(x)
        for x in gone_p:
            parents.remove(x)
        children, parents = children + come_c, parents + come_p
        df = lambda data: spark.createDataFrame(data, "id string")
        change = deltas(df(come_c), "id", "child", 1).unionByName(deltas(df(gone_c), "id", "child", -1)).unionByName(
            deltas(df(come_p), "id", "parent", 1)).unionByName(deltas(df(gone_p), "id", "parent", -1))
        for _ in range(2):  # a batch that is applied again changes nothing
            counts.apply(f"b{n}", change)
        want = {r.id: r.n_rows for r in fk_orphans(df(children), "id", df(parents).distinct(), "id").collect()}
        assert {r["key"]: r.n_rows for r in counts.orphans().collect()} == want and want
    assert len(counts.table.parts()) > 2
    # One changed key reads and writes one part; listing orphans reads their files only.
    assert len(counts.apply("b9", deltas(df([("k1",)]), "id", "child", 1))) == 1
    assert all("is_orphan=true" in f for f in counts.orphans().inputFiles())


def test_more_gone_than_came(spark, tmp_path):
    counts = ReferenceCounts(spark, str(tmp_path / "counts"))
    one = spark.createDataFrame([("a",), (None,)], "id string")
    with pytest.raises(Exception, match="more rows went than came"):
        counts.apply("b0", deltas(one, "id", "child", -1))
    counts.apply("b1", deltas(one, "id", "child", 1))
    assert [tuple(r) for r in counts.orphans().collect()] == [("a", 1)]
    counts.apply("b2", deltas(one, "id", "child", -1))
    assert counts.orphans().count() == 0
