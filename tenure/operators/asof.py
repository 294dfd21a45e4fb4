"""As-of join by one merge: versions and facts, or the days of facts, sorted together, the last version carried forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.operators.ranges import fits_broadcast, is_flat

#: Facts of one key that one task merges, at least; a key with more is cut into stretches of time.
ROWS_PER_STRETCH = 8_000_000
#: Stretches of a key, at most. A stretch then holds more than ROWS_PER_STRETCH facts, a 200th of all at most.
MAX_STRETCHES = 200
_SPREAD = 2 ** 20
#: Days of keys that are merged in place of their facts, at most, and the facts that a day of a key must have on average for that.
MAX_DAYS = 1_000_000
FACTS_PER_DAY = 4


def _place(day: Column, within: Column) -> Column:
    """Where a row stands in time: versions of a day before its facts, and these spread over the day."""
    return F.datediff(day, F.lit("0001-01-01").cast("date")).cast("long") * (2 * _SPREAD) + within


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    effective_from: str,
    effective_to: str | None = None,
    spread_by: Sequence[str] = (),
    rows_per_stretch: int = ROWS_PER_STRETCH,
) -> DataFrame:
    """Facts with the columns of the version of their key that began last on or before their day; null where none had begun, or
    where it is over (``effective_to`` is the last day of a version).

    Nothing is broadcast but the bounds of hot keys, and no version is copied but the one that each stretch of a hot key begins
    with. A key with more than ``rows_per_stretch`` facts is cut at quantiles of its facts' days, and within a day
    by a hash of ``spread_by``, so a key with half of all facts, or a day of it, is merged by many tasks. Null keys and days
    have no version. Of versions of a key that begin together, the one that ends last counts.

    Where many facts share their key and day, the days are merged, and their versions, as far as they fit a broadcast, are joined to the
    facts, which then are neither shuffled nor sorted.
    """
    args = (key, day, effective_from, effective_to)
    days = facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(F.count(F.lit(1)).alias("__n")).cache()
    n_days, n_facts = days.agg(F.count(F.lit(1)), F.sum("__n")).first()
    attached = [c for c in versions.columns if c not in (key, effective_from, effective_to)]
    if 0 < FACTS_PER_DAY * n_days <= n_facts and n_days <= MAX_DAYS and key != day and is_flat(versions):
        named = versions.select(*(F.col(c) if c in (key, effective_from, effective_to) else F.col(c).alias(f"__version_{c}") for c in versions.columns))
        dated = _merged(days.select(key, day), named, *args, (key, day), rows_per_stretch).withColumnsRenamed({key: "__key", day: "__day"})
        if fits_broadcast(dated):
            joined = facts.join(F.broadcast(dated), (F.col(key) == F.col("__key")) & (F.col(day) == F.col("__day")), "left")
            return joined.select(*(F.col(c) for c in facts.columns), *(F.col(f"__version_{c}").alias(c) for c in attached))
    days.unpersist()
    return _merged(facts, versions, *args, spread_by, rows_per_stretch)


def _merged(
    facts: DataFrame, versions: DataFrame, key: str, day: str, effective_from: str, effective_to: str | None, spread_by: Sequence[str], rows_per_stretch: int,
) -> DataFrame:
    carried = [c for c in versions.columns if c != key]
    attached = [c for c in carried if c != effective_from and c != effective_to]
    spread = F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(_SPREAD))
    told = facts.select(
        F.col(key).alias("key"), _place(F.col(day), F.lit(_SPREAD) + spread).alias("place"), F.struct(*(F.col(c) for c in facts.columns)).alias("fact"),
    )
    begun = versions.filter(F.col(key).isNotNull() & F.col(effective_from).isNotNull()).select(
        F.col(key).alias("key"), _place(F.col(effective_from), F.lit(0)).alias("place"), F.struct(*(F.col(c) for c in carried)).alias("version"),
    )
    bounds = _bounds(told, rows_per_stretch)
    told, begun = _stretched(told, bounds), _stretched(begun, bounds)
    handed = begun if bounds is None else begun.unionByName(_handed_over(begun, bounds))

    nothing = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    both = told.select("key", "stretch", "place", "fact", nothing(handed, "version")).unionByName(
        handed.select("key", "stretch", "place", nothing(told, "fact"), "version")
    )
    ends = F.coalesce(F.col(f"version.{effective_to}").cast("date"), F.lit("9999-12-31").cast("date")) if effective_to else F.lit(None).cast("date")
    so_far = Window.partitionBy("key", "stretch").orderBy("place", ends.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    merged = both.withColumn("version", F.last("version", ignorenulls=True).over(so_far)).filter(F.col("fact").isNotNull())
    holds = F.col("key").isNotNull() & F.col(f"fact.{day}").isNotNull()
    if effective_to:
        holds = holds & F.coalesce(F.col(f"fact.{day}") <= F.col(f"version.{effective_to}").cast("date"), F.lit(True))
    return merged.select("fact.*", *(F.when(holds, F.col(f"version.{c}")).alias(c) for c in attached))


def _bounds(told: DataFrame, rows_per_stretch: int) -> DataFrame | None:
    """key and bounds: where the stretches of a hot key begin, all but the first. None without hot keys."""
    counts = told.filter(F.col("key").isNotNull() & F.col("place").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    least = max(rows_per_stretch, (total or 0) // MAX_STRETCHES)
    if not largest or largest <= least:
        return None
    hot = F.broadcast(counts.filter(F.col("n") > least).select("key"))  # at most MAX_STRETCHES keys
    n = -(-largest // least)
    at = F.percentile_approx("place", F.array(*(F.lit(i / n) for i in range(1, n))), F.lit(100 * n))
    return told.join(hot, "key").groupBy("key").agg(F.array_sort(F.array_distinct(at)).alias("bounds"))


def _stretched(rows: DataFrame, bounds: DataFrame | None) -> DataFrame:
    if bounds is None:
        return rows.withColumn("stretch", F.lit(0))
    before = F.size(F.filter(F.coalesce("bounds", F.array().cast("array<bigint>")), lambda b: b <= F.col("place")))
    return rows.join(F.broadcast(bounds), "key", "left").withColumn("stretch", F.coalesce(before, F.lit(0))).drop("bounds")


def _handed_over(begun: DataFrame, bounds: DataFrame) -> DataFrame:
    """For each stretch of a hot key, the last version that began before it, as its first row."""
    stretches = bounds.select("key", F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias("stretch"))
    last = begun.join(F.broadcast(bounds.select("key")), "key", "left_semi").groupBy("key", "stretch").agg(
        F.max_by("version", "place").alias("version"), F.max("place").alias("place")
    )
    earlier = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    handed = stretches.join(last, ["key", "stretch"], "left").select(
        "key", "stretch", F.lit(-1).cast("long").alias("place"), F.last("version", ignorenulls=True).over(earlier).alias("version")
    )
    return handed.filter(F.col("version").isNotNull())
