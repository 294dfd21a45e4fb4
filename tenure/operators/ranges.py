"""Effective-dated joins: attach the attribute version that holds on a day or in a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Attribute sides measured above this many bytes are joined by shuffle instead of broadcast.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# The open ends of an effective range.
FIRST_DAY = "0001-01-01"
LAST_DAY = "9999-12-31"


def measured_bytes(df: DataFrame) -> int:
    """Data size of a flat table: 16 bytes per column plus the text lengths, summed on Spark."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row_bytes: Column = F.lit(16 * len(df.columns)).cast("long")
    for name in texts:
        row_bytes = row_bytes + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.sum(row_bytes)).first()[0] or 0


def is_flat(df: DataFrame) -> bool:
    """No arrays, maps or structs, so that ``measured_bytes`` counts everything."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return not any(isinstance(f.dataType, nested) for f in df.schema)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure a table on Spark and compare it with a broadcast bound."""
    return is_flat(df) and measured_bytes(df) <= max_bytes


def left_range_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    overlap: Column,
    spread_by: list[str],
    is_small: bool,
    salts: int | None = None,
) -> DataFrame:
    """Left join ``facts`` to ``versions`` on ``key`` and the range condition ``overlap``.

    ``is_small`` is the outcome of ``fits_broadcast``. A small side is broadcast, so the
    facts never move. Otherwise both sides are shuffled on (key, salt): each version is
    repeated once per salt and the facts of a popular key spread over ``salts`` tasks, by default as many
    as the cluster has cores, by a hash of ``spread_by``. Both ways give the same rows.

    ``versions`` must not share column names with ``facts`` except for ``key``.
    """
    salts = salts or max(2, facts.sparkSession.sparkContext.defaultParallelism)
    right = versions.withColumnRenamed(key, "__range_key")
    matches = (F.col(key) == F.col("__range_key")) & overlap
    if is_small:
        return facts.join(F.broadcast(right), matches, "left").drop("__range_key")
    salted_right = right.withColumn("__range_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_facts = facts.withColumn(
        "__fact_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    )
    matches = matches & (F.col("__fact_salt") == F.col("__range_salt"))
    return salted_facts.join(salted_right, matches, "left").drop(
        "__range_key", "__range_salt", "__fact_salt"
    )


def overlapping_ranges(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Days on which a range begins although another range of the same key still runs.

    Ranges are inclusive; a null end never ends. Ranges that begin on the same day are
    counted together (``n_rows``) first, which leaves one row per key and day to compare.
    """
    closed_end = F.coalesce(F.col(end).cast("date"), F.lit(LAST_DAY).cast("date"))
    begun = df.groupBy(key, F.col(start).cast("date").alias(start)).agg(
        F.max(closed_end).alias("last_day"), F.count(F.lit(1)).alias("n_rows")
    )
    earlier = Window.partitionBy(key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    still_running = F.coalesce(F.col(start) <= F.max("last_day").over(earlier), F.lit(False))
    return (
        begun.withColumn("__overlaps", still_running | (F.col("n_rows") > 1))
        .filter("__overlaps").drop("__overlaps")
    )
