"""Latest-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def latest_by(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per key: the newest by ``newest_first``, ties broken by all other columns.

    The row number is compared with 1 right away, which lets Spark cut each map task down
    to one row per key before the shuffle (WindowGroupLimit). A key that holds a large part
    of the table therefore sends at most one row per map task to its reducer.
    """
    tie_break = [
        f.name for f in df.schema
        if f.name not in keys and f.name not in newest_first and _orderable(f.dataType)
    ]
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *tie_break]]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).filter("__rank = 1").drop("__rank")


#: Rows that a task of ``latest_by_key`` sorts, about.
ROWS_PER_SORT = 500_000
#: Buckets of key hashes that are counted to find keys with very many rows.
BUCKETS = 4096


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], rows_per_sort: int = ROWS_PER_SORT) -> DataFrame:
    """As ``latest_by``, for many rows of which most have a key of their own.

    Sorting such rows before the shuffle removes few of them and is done over as many rows as a file split holds, which spills. Here
    rows are shuffled first, into partitions of about ``rows_per_sort``, and sorted once. Only keys are read to count
    rows by buckets of key hashes; buckets with more than twice what a partition should hold have keys with very many rows,
    and go through ``latest_by`` as it is.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # BUCKETS rows at most
    total = sum(r["n"] for r in counts)
    if total <= rows_per_sort:
        return latest_by(df, keys, newest_first)
    usual = -(-total // BUCKETS)
    hot = [r["bucket"] for r in counts if r["n"] > max(2 * rows_per_sort, 8 * usual)]
    few = df.filter(~bucket.isin(hot)) if hot else df
    rows = sum(r["n"] for r in counts if r["bucket"] not in set(hot))
    own = latest_by(few.repartition(max(1, -(-rows // rows_per_sort)), *keys), keys, newest_first)
    return own.unionByName(latest_by(df.filter(bucket.isin(hot)), keys, newest_first)) if hot else own
