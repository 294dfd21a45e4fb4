"""Payloads that drift: known fields become columns, all others are kept as VARIANT.

A field that first shows in some batch is neither lost nor does it need a new column in older files: it is read by its path from
the rest, from every batch alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shredded(lines: DataFrame, known: T.StructType, value: str = "value") -> DataFrame:
    """JSON objects (text column ``value``) as the columns of ``known``, ``rest`` (VARIANT, all other fields) and ``unreadable``.

    A known field whose value doesn't fit its type is null as a column and stays in ``rest``, so nothing is lost. Lines that hold no
    JSON object, or one that gives a field twice, come whole in ``unreadable``, with nulls elsewhere. Blank lines are no
    events. Other columns of ``lines`` are kept.
    """
    taken = [*known.names, "rest", "unreadable"]
    others = [c for c in lines.columns if c != value and c not in taken]
    parsed = F.from_json(F.when(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.col(value)), "map<string,variant>")
    rows = lines.filter(F.trim(F.col(value)) != "").select(*others, F.col(value).alias("__line"), parsed.alias("__fields"))
    get = lambda f: F.try_variant_get(F.try_element_at("__fields", F.lit(f.name)), "$", f.dataType.simpleString())
    rows = rows.withColumns({f"__known_{f.name}": get(f) for f in known})
    kept = F.map_filter("__fields", lambda k, _: ~k.isin(known.names) | _unfit(k, known))
    rest = F.when(F.col("__fields").isNotNull(), F.to_variant_object(kept))
    return rows.select(
        *others, *(F.col(f"__known_{f.name}").alias(f.name) for f in known), rest.alias("rest"),
        F.when(F.col("__fields").isNull(), F.col("__line")).alias("unreadable"),
    )


def _unfit(key: Column, known: T.StructType) -> Column:
    """Is the field known, there and not null, but not of its type?"""
    unfit: Column = F.lit(False)
    for f in known:
        there = F.try_element_at("__fields", F.lit(f.name))
        unfit = unfit | ((key == f.name) & F.col(f"__known_{f.name}").isNull() & ~F.is_variant_null(there))
    return unfit


def field(path: str, data_type: str, rest: str = "rest") -> Column:
    """A field of the rest by its JSON path; null where it isn't there or doesn't fit the type."""
    return F.try_variant_get(rest, path, data_type)


def fields_seen(payloads: DataFrame, rest: str = "rest") -> DataFrame:
    """Which unknown fields came, how often, and with which types: field, type, n_rows."""
    shape = F.schema_of_variant(rest)
    inside = F.from_json(F.to_json(rest), "map<string,variant>")
    named = payloads.filter(shape.startswith("OBJECT")).select(F.explode(inside).alias("field", "v"))
    return named.groupBy("field", F.schema_of_variant("v").alias("type")).agg(F.count(F.lit(1)).alias("n_rows"))


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths))
