"""Exact distinct counts by bitmaps that can be merged, over densely numbered keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(keys: DataFrame, key: str, known: DataFrame | None, path: str) -> DataFrame:
    """``key`` and number: known keys keep theirs, others get the next ones from 1 on, without gaps.

    New keys are range-sorted and written to ``path``; each range numbers its own, after as many as all ranges before it hold. Null
    keys get no number.
    """
    fresh = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known, key, "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    ranged = fresh.repartitionByRange(key).sortWithinPartitions(key).withColumn("place", F.monotonically_increasing_id())
    ranged.write.mode("overwrite").parquet(path)
    placed = fresh.sparkSession.read.schema(ranged.schema).parquet(path).withColumn("range", F.shiftright("place", 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, as many as the write had tasks.
    sizes = placed.groupBy("range").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    begins = sizes.select("range", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begins"))
    new = placed.join(F.broadcast(begins), "range").select(key, (F.lit(first + 1) + F.col("begins") + F.col("place") - F.col("low")).alias("number"))
    return new if known is None else known.select(key, "number").unionByName(new)


def bitmaps(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """by, bucket, bitmap: which numbers occur, 32,768 of them in a bitmap of 4 KB."""
    bucket = F.bitmap_bucket_number(number)
    return rows.groupBy(*by, bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def merged_bitmaps(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """The bitmaps of all parts: what occurs in any of them."""
    return reduce(DataFrame.unionByName, parts).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bit_counts(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, n: how many different numbers occur."""
    return found.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
