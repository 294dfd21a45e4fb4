"""Running totals and pieces of texts against Python."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tenure.llm import columns as c


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 1000, 70_000])
def test_running_totals(spark, frame, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    df = frame([(values,)], "v array<int>").select(c.running(F.col("v"), lambda a, b: a + b).alias("s"), c.running(F.col("v"), F.greatest).alias("m"))
    r = df.first()
    assert r.s == list(accumulate(values)) and r.m == list(accumulate(values, max))


def test_pieces_of_a_text(spark, frame):
    rng = random.Random(1)
    text = "".join(rng.choices("aé\n日𝄞", k=3000))
    cuts = [(rng.randrange(-50, 3050), rng.randrange(0, 700)) for _ in range(200)] + [(0, 0), (0, 3000), (256, 256), (255, 1), (256, 0), (-5, 3), (3000, 5)]
    df = frame([(text, a, n) for a, n in cuts], "text string, a int, n int").select("a", "n", c.cut_out(c.chunks(F.col("text")), F.col("a"), F.col("n")).alias("got"))
    for r in df.collect():
        assert r.got == text[max(0, r.a):max(0, r.a + r.n)], (r.a, r.n)
    assert frame([("",)], "text string").select(c.cut_out(c.chunks(F.col("text")), F.lit(0), F.lit(9)).alias("x")).first().x == ""
