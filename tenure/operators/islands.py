"""Temporal coalescing: neighbouring versions that say the same become one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coalesced(versions: DataFrame, key: Sequence[str], attributes: Sequence[str], valid_from: str = "start_date", valid_to: str = "end_date") -> DataFrame:
    """Half-open versions of which those that follow one another without a gap and have equal attributes are joined.

    Gives key, attributes, ``valid_from`` and ``valid_to``. Versions of a key must not overlap; those without a day, or without a
    beginning, are left out. Nulls among attributes equal each other. The windows and the grouping share one shuffle by key.
    """
    used = versions.filter(F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to))))
    in_order = Window.partitionBy(*key).orderBy(valid_from)
    same = F.lag(valid_to).over(in_order) == F.col(valid_from)
    for a in attributes:
        same = same & F.lag(a).over(in_order).eqNullSafe(F.col(a))
    begins = (~F.coalesce(same, F.lit(False))).cast("int")
    counted = used.withColumn("__begins", begins).withColumn("__island", F.sum("__begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return counted.groupBy(*key, "__island").agg(
        *(F.min_by(a, valid_from).alias(a) for a in attributes), F.min(valid_from).alias(valid_from), F.max_by(valid_to, valid_from).alias(valid_to)
    ).drop("__island")
