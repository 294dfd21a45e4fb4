"""Compare a query with its SQL on one scale: same columns, same rows in any order.

Usage: python -m testbed.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from testbed.oracle import oracle_sql
from testbed.registry import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value) if value is not None else None


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[int, str | None]:
    """Row count, and what differs (or None)."""
    df = queries()[name](spark, sf_dir)
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return sum(ours.values()), None
    result = con.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    theirs = _bag(theirs_columns, result.fetchall())
    if sorted(df.columns) != sorted(theirs_columns):
        return sum(ours.values()), f"columns {sorted(df.columns)} against {sorted(theirs_columns)}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return sum(ours.values()), (
            f"{sum(extra.values())} rows too many such as {next(iter(extra), None)}, "
            f"{sum(missing.values())} missing such as {next(iter(missing), None)}"
        )
    return sum(ours.values()), None


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            rows, problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report every query
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={rows} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")


if __name__ == "__main__":
    main()
