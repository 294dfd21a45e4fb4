"""Config-driven extracts: full by stored query, incremental by watermark."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.contracts import COPY_CONFIG, conform

# The load type that means "by watermark", its column, and where it starts.
INCREMENTAL = "incremental"
WATERMARK_COLUMN = "last_updated"
FIRST_WATERMARK = "1900-01-01"

# Where the config table is kept.
CONFIG_SCHEMA = "ext"
CONFIG_TABLE = "copy_config"


@dataclass(frozen=True)
class ExtractSpec:
    source_name: str
    load_type: str
    source_query: str | None = None

    @property
    def is_incremental(self) -> bool:
        return self.load_type == INCREMENTAL


def extract_specs(config: DataFrame) -> Iterator[ExtractSpec]:
    """The rows of the config table, one after another; each becomes a lazy extract of its own."""
    for r in conform(config, COPY_CONFIG.schema).orderBy("source_name").toLocalIterator():
        yield ExtractSpec(r.source_name, r.load_type, r.source_query)


def read_config(spark: SparkSession, schema: str = CONFIG_SCHEMA, table: str = CONFIG_TABLE) -> DataFrame:
    """The config table from the catalog."""
    return spark.table(f"{schema}.{table}")


def read_config_csv(spark: SparkSession, path: str) -> DataFrame:
    """The config table kept as CSV with a header."""
    return conform(spark.read.option("header", "true").csv(path), COPY_CONFIG.schema)


def full_extract(spark: SparkSession, query: str) -> DataFrame:
    """The result of a spec's stored query over registered tables."""
    return spark.sql(query)


def incremental_extract(
    table: DataFrame, since: str | date | datetime = FIRST_WATERMARK, column: str = WATERMARK_COLUMN
) -> DataFrame:
    """Rows strictly newer than ``since``. The literal takes the column's type, so it is pushed down."""
    return table.filter(F.col(column) > F.lit(str(since)).cast(table.schema[column].dataType))


def next_watermark(
    extracted: DataFrame, since: str | date | datetime = FIRST_WATERMARK, column: str = WATERMARK_COLUMN
) -> DataFrame:
    """One row, ``next_watermark``: the newest value seen, or ``since`` when nothing came."""
    start = F.lit(str(since)).cast(extracted.schema[column].dataType)
    return extracted.agg(F.coalesce(F.max(column), start).alias("next_watermark"))


def extract(
    spark: SparkSession,
    spec: ExtractSpec,
    read_table: Callable[[str], DataFrame] | None = None,
    since: str | date | datetime = FIRST_WATERMARK,
) -> DataFrame:
    """Route a spec: by watermark from its table, or in full by its stored query."""
    if spec.is_incremental:
        return incremental_extract((read_table or spark.table)(spec.source_name), since)
    if not spec.source_query:
        raise ValueError(f"{spec.source_name}: a full load needs a source_query")
    return full_extract(spark, spec.source_query)


Since = str | date | datetime


def since_of(since: Since | dict[str, Since], source: str) -> Since:
    """The watermark of a source: one for all, or one for each, which begins at FIRST_WATERMARK."""
    return since.get(source, FIRST_WATERMARK) if isinstance(since, dict) else since


def extract_all(
    spark: SparkSession,
    config: DataFrame,
    read_table: Callable[[str], DataFrame] | None = None,
    since: Since | dict[str, Since] = FIRST_WATERMARK,
    run_query: Callable[[ExtractSpec], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """One lazy extract per config row, by source name.

    ``since`` is one watermark or one per source. ``run_query`` takes over both load types, for instance to let a
    database run them: ``lambda spec: jdbc_query(spark, url, source_query(spec, "sales", since_of(since, spec.source_name)))``.
    """
    if run_query is not None:
        return {s.source_name: run_query(s) for s in extract_specs(config)}
    return {s.source_name: extract(spark, s, read_table, since_of(since, s.source_name)) for s in extract_specs(config)}


def next_watermarks(
    extracts: dict[str, DataFrame], since: Since | dict[str, Since] = FIRST_WATERMARK, column: str = WATERMARK_COLUMN
) -> dict[str, Since]:
    """The next watermark of each extract that has the column: the newest value seen, or the one it began with."""
    return {
        name: next_watermark(df, since_of(since, name), column).first()["next_watermark"]
        for name, df in extracts.items() if column in df.columns
    }


def source_query(
    spec: ExtractSpec, schema: str, since: str | date | datetime = FIRST_WATERMARK, column: str = WATERMARK_COLUMN
) -> str:
    """The SQL a database server runs for a spec: its stored query, or its table by watermark."""
    if not spec.is_incremental:
        if not spec.source_query:
            raise ValueError(f"{spec.source_name}: a full load needs a source_query")
        return spec.source_query
    for name in (schema, spec.source_name, column):
        if not re.fullmatch(r"[A-Za-z_]\w*", name):
            raise ValueError(f"{name!r} is not a plain identifier")
    newer_than = datetime.fromisoformat(str(since)).isoformat(sep=" ")
    return f"SELECT * FROM {schema}.{spec.source_name} WHERE {column} > '{newer_than}'"


def jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A query on a database, read by ``num_partitions`` tasks over ranges of a column."""
    reader = spark.read.format("jdbc").options(**jdbc_options(
        url, query, partition_column, bounds, num_partitions, properties
    ))
    return reader.load()


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. The whole query goes in ``dbtable`` because partitioned reads need that."""
    options = {"url": url, "dbtable": f"({query}) extract_source", "fetchsize": "10000", **(properties or {})}
    if partition_column is not None:
        if bounds is None or num_partitions < 2:
            raise ValueError("a partitioned read needs bounds and at least two partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options
