"""Files of whatever store a path names, by the session's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, fs = _path(spark, path)
    return fs.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    found, fs = _path(spark, path)
    fs.delete(found, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    found, fs = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(found) if f.isDirectory()) if fs.exists(found) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path; 0 if there is none."""
    found, fs = _path(spark, path)
    return fs.getContentSummary(found).getLength() if fs.exists(found) else 0
