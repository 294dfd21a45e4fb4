"""Column updates under a condition, and load stamps."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.functions.times import as_timestamp


def conditional_update(df: DataFrame, where: Column, assignments: dict[str, Any]) -> DataFrame:
    """Set columns where ``where`` holds; other rows and all column types stay as they are."""
    types = {f.name: f.dataType for f in df.schema}
    updated = {}
    for name, value in assignments.items():
        new = value if isinstance(value, Column) else F.lit(value)
        updated[name] = F.when(where, new.cast(types[name])).otherwise(F.col(name))
    return df.withColumns(updated)


def stamp_load(df: DataFrame, source_file: str, as_of: str | datetime) -> DataFrame:
    """Add ``ingestion_date`` and ``source_file``."""
    return df.withColumns({"ingestion_date": as_timestamp(as_of), "source_file": F.lit(source_file)})
