"""Versioned dimensions on plain files.

Every load writes one batch folder split by ``active_status``: all open versions, and the
versions this load closed. What a load opened or closed is also kept by itself, for marts that follow changes. Earlier history stays where it is, a load never overwrites what
it reads, and running a batch again replaces only that batch. Batch ids sort as text.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.functions.times import as_timestamp
from tenure.operators.scd2 import scd2_initial, scd2_step
from tenure.sources.files import delete, exists, folders


def _batch_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def _write_batch(rows: DataFrame, root: str, batch_id: str, fmt: str) -> None:
    rows.write.format(fmt).mode("overwrite").partitionBy("active_status").save(_batch_path(root, batch_id))


def _changes_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/_changes/{batch_id}"


def _write_changes(rows: DataFrame, root: str, batch_id: str, as_of: str | datetime, fmt: str) -> None:
    changed = (F.col("active_status") == "N") | (F.col("start_date") == as_timestamp(as_of))
    rows.filter(changed).write.format(fmt).mode("overwrite").save(_changes_path(root, batch_id))


def create_dimension(
    df: DataFrame, root: str, batch_id: str, as_of: str | datetime, fmt: str = "parquet"
) -> None:
    """First load."""
    _write_batch(scd2_initial(df, as_of), root, batch_id, fmt)
    schema = scd2_initial(df, as_of).schema
    _write_changes(_read_batch(df.sparkSession, root, schema, batch_id, fmt), root, batch_id, as_of, fmt)


def _read_batch(spark: SparkSession, root: str, schema: T.StructType, batch_id: str, fmt: str) -> DataFrame:
    stored = T.StructType([*(f for f in schema if f.name != "active_status"), T.StructField("active_status", T.StringType())])
    return spark.read.format(fmt).schema(stored).load(_batch_path(root, batch_id)).select([f.name for f in schema])


def read_changes(spark: SparkSession, root: str, schema: T.StructType, batch_id: str, fmt: str = "parquet") -> DataFrame:
    """The versions that a load opened or closed, as they were after it."""
    return spark.read.format(fmt).schema(schema).load(_changes_path(root, batch_id))


def read_dimension(
    spark: SparkSession, root: str, schema: T.StructType, batch_id: str, fmt: str = "parquet"
) -> DataFrame:
    """The dimension after ``batch_id``: its open versions, and all versions closed so far.

    ``schema`` names the columns including the versioning ones. Both filters are on
    partition columns, so superseded open versions are never read.
    """
    stored = T.StructType([f for f in schema if f.name != "active_status"])
    partitioned = T.StructType([
        *stored, T.StructField("batch_id", T.StringType()), T.StructField("active_status", T.StringType())
    ])
    rows = spark.read.format(fmt).schema(partitioned).load(root)
    is_open = (F.col("batch_id") == batch_id) & (F.col("active_status") == "Y")
    is_closed = (F.col("batch_id") <= batch_id) & (F.col("active_status") == "N")
    return rows.filter(is_open | is_closed).select([f.name for f in schema])


def merge_dimension(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    schema: T.StructType,
    previous_batch: str,
    batch_id: str,
    keys: Sequence[str],
    as_of: str | datetime,
    tracked: Sequence[str] | None = None,
    close_missing: bool = False,
    fmt: str = "parquet",
    closing: str | None = None,
) -> None:
    """Merge ``source`` into the dimension as a new batch."""
    if batch_id <= previous_batch:
        raise ValueError(f"batch {batch_id!r} must sort after {previous_batch!r}")
    target = read_dimension(spark, root, schema, previous_batch, fmt)
    _write_batch(scd2_step(target, source, keys, as_of, tracked, close_missing, closing), root, batch_id, fmt)
    _write_changes(_read_batch(spark, root, schema, batch_id, fmt), root, batch_id, as_of, fmt)


def retire_open_versions(spark: SparkSession, root: str, before_batch: str) -> list[str]:
    """Delete the copies of open versions of batches before ``before_batch``, which later batches replace.

    Closed history stays. Such a batch can no longer be read as a state of its own.
    """
    gone = []
    for name in folders(spark, root):
        batch = name.removeprefix("batch_id=")
        if name.startswith("batch_id=") and batch < before_batch:
            path = f"{root.rstrip('/')}/{name}/active_status=Y"
            if exists(spark, path):
                delete(spark, path)
                gone.append(batch)
    return gone
