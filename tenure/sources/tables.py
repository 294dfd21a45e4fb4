"""Landing batches, tables and partition overwrites. Parquet unless another format is given."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.contracts import EVENTS
from tenure.sources.files import delete


def landing_path(root: str, source: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/{source}/batch={batch_id}"


def write_landing(df: DataFrame, root: str, source: str, batch_id: str) -> str:
    """Land one extract in its own batch folder; running the batch again replaces only itself."""
    path = landing_path(root, source, batch_id)
    df.write.mode("overwrite").parquet(path)
    return path


def read_landing(
    spark: SparkSession, root: str, source: str, schema: T.StructType, batch_id: str | None = None
) -> DataFrame:
    """One landed batch, or all of them with their ``batch`` column, in the given schema."""
    if batch_id is not None:
        return spark.read.schema(schema).parquet(landing_path(root, source, batch_id))
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    return spark.read.schema(with_batch).parquet(f"{root.rstrip('/')}/{source}")


def read_event_files(spark: SparkSession, path: str, schema: T.StructType = EVENTS.schema) -> DataFrame:
    """JSON-lines events with an explicit schema; unreadable lines go to ``_corrupt_record``."""
    with_corrupt = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in schema],
        T.StructField("_corrupt_record", T.StringType()),
    ])
    return spark.read.schema(with_corrupt).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """A table at rest. ``merge_schema`` unites the columns of files written over time."""
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", "true") if merge_schema else reader).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    placed: bool = False,
) -> None:
    """Replace (or append to) a table.

    A partitioned table is rebalanced on its partition columns first. That keeps files few,
    and unlike a plain repartition it lets Spark split a partition value that is very large. Rows that are ``placed`` by
    them already are written as they lie.
    """
    if partition_by:
        rows = df if placed else df.hint("rebalance", *[F.col(c) for c in partition_by])
        rows.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)
    else:
        df.write.format(fmt).mode(mode).save(path)


def save_as_table(df: DataFrame, name: str, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write an external catalog table at ``path``."""
    df.write.format(fmt).mode(mode).option("path", path).saveAsTable(name)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", every: Iterable[Sequence[str]] = (), placed: bool = False,
) -> None:
    """Replace the partitions that ``df`` has rows for.

    ``every`` lists the partitions (values in order) that ``df`` stands for: of these, the ones without rows
    are removed, since nothing is left in them. ``placed`` as in ``write_table``.
    """
    rows = df if placed else df.hint("rebalance", *[F.col(c) for c in partition_by])
    (
        rows.write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    )
    every = {tuple(map(str, values)) for values in every}
    if every:
        cells = df.select(*[F.col(c).cast("string") for c in partition_by]).distinct()
        present = {tuple(r) for r in cells.filter(F.concat_ws("/", *partition_by).isin(["/".join(v) for v in every])).collect()}
        for values in sorted(every - present):
            delete(df.sparkSession, "/".join([path.rstrip("/"), *(f"{c}={v}" for c, v in zip(partition_by, values, strict=True))]))


def with_month(df: DataFrame, day: str = "dt", name: str = "dt_month") -> DataFrame:
    """Add the month of a day as the partition column of daily tables."""
    return df.withColumn(name, F.date_format(day, "yyyy-MM"))
