"""Referential checks that follow changes: counts per key, kept up to date by signed deltas.

For each key value the table holds how many child rows refer to it and how many parent rows have it. A batch says which rows came and
which went; only the parts that its keys fall into are read and written. Orphans lie in files of their own, so
listing them reads no other key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.sources.split_table import MAX_BYTES, SplitTable


def deltas(rows: DataFrame, column: str, side: str, sign: int) -> DataFrame:
    """The signed counts of rows that came (1) or went (-1), for ``side`` child or parent. Null keys refer to nothing."""
    n = F.lit(sign).cast("long") * F.count(F.lit(1))
    counted = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key")).agg(n.alias("n"))
    zero = F.lit(0).cast("long")
    return counted.select("key", (F.col("n") if side == "child" else zero).alias("n_children"), (F.col("n") if side == "parent" else zero).alias("n_parents"))


class ReferenceCounts:
    """Counts of one foreign key under a path."""

    def __init__(self, spark: SparkSession, path: str, max_bytes: int = MAX_BYTES):
        self.spark = spark
        self.table = SplitTable(spark, path, ["key"], partition_by=["is_orphan"], max_bytes=max_bytes)

    def apply(self, batch: str, changes: DataFrame) -> list[str]:
        """Add a batch of ``deltas``; gives the parts that were touched. Batches sort as text, and one applied before changes nothing.

        A key whose counts are both zero is forgotten when a later batch
        touches its part. A count below zero says that a batch took away what was never there: it fails.
        """
        fresh = changes.groupBy("key").agg(F.sum("n_children").alias("n_children"), F.sum("n_parents").alias("n_parents")).withColumn("changed_in", F.lit(batch))
        if not self.table.exists():
            self.table.create(_judged(fresh.limit(0), batch))
        return self.table.upsert(fresh, lambda both: _judged(_summed(both, batch), batch))

    def orphans(self) -> DataFrame:
        """Keys that are referred to and have no parent, with the number of rows that refer to them."""
        found = self.table.read().filter("cast(is_orphan as boolean)")
        return found.select("key", F.col("n_children").alias("n_rows"))


def _summed(both: DataFrame, batch: str) -> DataFrame:
    """Counts per key; rows that had this batch already keep what they have."""
    stored = F.col("is_orphan").isNotNull()
    had = F.max(F.when(stored, F.col("changed_in")))
    old = lambda c: F.coalesce(F.sum(F.when(stored, F.col(c))), F.lit(0))
    new = lambda c: F.coalesce(F.sum(F.when(~stored, F.col(c))), F.lit(0))
    applied = F.coalesce(had >= batch, F.lit(False))
    return both.groupBy("key").agg(
        *(F.when(applied, old(c)).otherwise(old(c) + new(c)).alias(c) for c in ("n_children", "n_parents")),
        F.greatest(F.coalesce(had, F.lit(batch)), F.when(F.sum((~stored).cast("int")) > 0, F.lit(batch))).alias("changed_in"),
    )


def _judged(counts: DataFrame, batch: str) -> DataFrame:
    least = F.least("n_children", "n_parents")
    failed = F.raise_error(F.concat(F.lit("more rows went than came for key "), F.col("key"))).cast("boolean")
    sound = F.when(least < 0, failed).otherwise(F.lit(True))
    kept = counts.filter(sound & ((F.col("n_children") != 0) | (F.col("n_parents") != 0) | (F.col("changed_in") == batch)))
    return kept.withColumn("is_orphan", (F.col("n_children") > 0) & (F.col("n_parents") == 0))
