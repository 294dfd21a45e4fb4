"""Country codes. The list of assigned ISO 3166-1 alpha-2 codes is a parameter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def assigned_country_codes(spark: SparkSession) -> frozenset[str]:
    """The alpha-2 codes the driver's Java runtime lists as assigned (249 on current ones).

    Needs a classic session; on a remote (Connect) session pass your own list instead.
    """
    return frozenset(spark.sparkContext._jvm.java.util.Locale.getISOCountries())


def is_country(code: Column, codes: Iterable[str]) -> Column:
    """True where the upper-cased ``code`` is one of ``codes``; null for a null code."""
    return F.upper(code).isin(sorted(codes))
