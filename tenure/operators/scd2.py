"""Type-2 dimensions as functions of (target, source, as_of).

The target holds ``start_date``, ``end_date`` and ``active_status`` ('Y' for the one open
version of a key). The source holds the wanted current state, one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.contracts import LOAD_METADATA, SCD2_COLUMNS
from tenure.functions.times import as_timestamp
from tenure.operators.dedup import latest_by


def tracked_columns(source: DataFrame, keys: Sequence[str]) -> list[str]:
    """The default comparison: everything except the key and the load metadata."""
    return [c for c in source.columns if c not in keys and c not in LOAD_METADATA]


def scd2_initial(df: DataFrame, as_of: str | datetime) -> DataFrame:
    """First load: every row becomes the open version of its key."""
    return df.withColumns({
        "start_date": as_timestamp(as_of),
        "end_date": F.lit(None).cast("timestamp"),
        "active_status": F.lit("Y"),
    })


def seed_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order, for a partial first load."""
    return df.orderBy(*keys).limit(n)


def active_versions(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("active_status") == "Y")


def _any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    differs: Column = F.lit(False)
    for left, right in pairs:
        differs = differs | ~left.eqNullSafe(right)
    return differs


def scd2_changes(
    source: DataFrame, target: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None = None
) -> DataFrame:
    """Source rows that are new or differ from the open version, next to its ``tgt_`` columns."""
    tracked = tracked_columns(source, keys) if tracked is None else list(tracked)
    compared = [*keys, *tracked]
    current = active_versions(target).select([F.col(c).alias(f"tgt_{c}") for c in compared])
    current = current.withColumn("__known", F.lit(True))
    differs = _any_differs([(F.col(c), F.col(f"tgt_{c}")) for c in tracked])
    joined = source.join(current, _null_safe("", "tgt_", keys), "left")
    return joined.filter(F.col("__known").isNull() | differs).drop("__known")


def scd2_staged(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge input: changed rows twice (MERGEKEY set closes, MERGEKEY null inserts), new rows once.

    Both copies come from one pass over ``changes`` instead of a union of two branches.
    """
    merge_key = (
        F.col(keys[0]).cast("string") if len(keys) == 1
        else F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))
    )
    no_key = F.lit(None).cast("string")
    copies = F.when(F.col(f"tgt_{keys[0]}").isNotNull(), F.array(merge_key, no_key)).otherwise(
        F.array(merge_key)
    )
    return changes.withColumn("MERGEKEY", F.explode(copies))


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Keys are equal; null keys equal each other."""
    same: Column = F.lit(True)
    for k in keys:
        same = same & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return same


def _decided(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: str | datetime,
    tracked: Sequence[str] | None,
    close_missing: bool,
    closing: str | None,
    with_history: bool,
) -> DataFrame:
    tracked = tracked_columns(source, keys) if tracked is None else list(tracked)
    stamp = as_timestamp(as_of)
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema}
    # Of source rows that share a key, the newest counts, so that no key gets two open versions.
    newest = [c for c in ("last_updated",) if c in source.columns]
    source = latest_by(source, keys, newest)

    # Closed history passes through the same join: a marked row of the target never meets the source.
    is_open = F.col("active_status").eqNullSafe("Y")
    used = target if with_history else target.filter(is_open)
    old = used.select(
        *[F.col(k).alias(f"__old_{k}") for k in keys], is_open.alias("__open"), F.struct(*columns).alias("__old")
    )
    new = source.select(
        *[F.col(k).alias(f"__new_{k}") for k in keys], F.lit(True).alias("__new_open"), F.struct(*source.columns).alias("__new")
    )
    joined = old.join(new, _null_safe("__old_", "__new_", keys) & (F.col("__open") == F.col("__new_open")), "full_outer")

    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    current = has_old & F.col("__open")
    differs = _any_differs([(F.col(f"__old.{c}"), F.col(f"__new.{c}")) for c in tracked])
    withdrawn = F.lit(False) if closing is None else F.coalesce(F.col(f"__new.{closing}"), F.lit(False))
    replaced = current & has_new & differs & ~withdrawn
    closes = replaced | (current & has_new & withdrawn)
    if close_missing:
        closes = closes | (current & ~has_new)

    def version(name: str, overrides: dict[str, Column], available: Sequence[str]) -> Column:
        fields = []
        for c in columns:
            value = overrides.get(c, F.col(f"{name}.{c}") if c in available else F.lit(None))
            fields.append(value.cast(types[c]).alias(c))
        return F.struct(*fields)

    kept = version("__old", {}, columns)
    closed = version("__old", {"end_date": stamp, "active_status": F.lit("N")}, columns)
    opened = version(
        "__new",
        {"start_date": stamp, "end_date": F.lit(None), "active_status": F.lit("Y")},
        [c for c in source.columns if c not in SCD2_COLUMNS],
    )
    results = F.array_compact(F.array(
        F.when(has_old, F.when(closes, closed).otherwise(kept)),
        F.when(has_new & ~withdrawn & (~has_old | replaced), opened),
    ))
    return joined.select(F.explode(results).alias("__row")).select("__row.*")


def scd2_step(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: str | datetime,
    tracked: Sequence[str] | None = None,
    close_missing: bool = False,
    closing: str | None = None,
) -> DataFrame:
    """The rows this load touches or keeps open: next open versions plus newly closed ones.

    One full outer join of open versions with the source decides for each key whether it is
    kept, closed, replaced or inserted, and emits its zero to two result rows. History that
    was closed earlier takes no part and is not read.

    Keys are compared null-safe, so a row without a key is a key of its own and is not opened again
    by each load. Of source rows that share a key the newest counts. Keys that left the source stay open unless
    ``close_missing``. ``closing`` names a boolean source column: rows where it is true close their key.
    """
    return _decided(target, source, keys, as_of, tracked, close_missing, closing, with_history=False)


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: str | datetime,
    tracked: Sequence[str] | None = None,
    close_missing: bool = False,
    closing: str | None = None,
) -> DataFrame:
    """Next state of the whole dimension. The target is read once, so merges can be chained."""
    return _decided(target, source, keys, as_of, tracked, close_missing, closing, with_history=True)


def row_hash(df: DataFrame, columns: Sequence[str], name: str = "row_hash") -> DataFrame:
    """Add a 64-bit hash of ``columns``. It skips nulls, so it is no substitute for comparing."""
    return df.withColumn(name, F.xxhash64(*columns))
