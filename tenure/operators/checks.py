"""Key and reference checks. Spark enforces neither, so they are queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.contracts import Contract


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with ``n_rows``. Counts are combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Referenced values missing from the parent, with ``n_rows``.

    The child is reduced to one row per value before the anti join, so a value that most
    rows share costs no more than any other. Null references are not orphans.
    """
    referenced = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("__parent"))
    return referenced.join(known, F.col(column) == F.col("__parent"), "left_anti")


def contract_violations(tables: dict[str, DataFrame], contracts: dict[str, Contract]) -> DataFrame:
    """Repeated keys, missing keys and orphaned references of all tables in one frame.

    Columns: ``table_name``, ``rule`` (``unique``, ``not_null`` or ``reference``),
    ``column_name``, ``value`` and ``n_rows``. References to tables not given are skipped.

    Each table is read once: a row states its key, its references and its missing columns, which are
    counted together. A table that others refer to is read once more for its keys.
    """
    def statement(rule: str, name: str, parent: str | None, parts: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(name).alias("column_name"), F.lit(parent).cast("string").alias("parent"),
            F.array(*[p.cast("string") for p in parts]).alias("parts"),
        )

    stated, parents = [], {}
    for name, df in tables.items():
        contract = contracts[name]
        said = [statement("unique", "|".join(contract.key), None, [F.col(c) for c in contract.key])]
        for column, parent, parent_key in contract.references:
            if parent in tables:
                said.append(F.when(F.col(column).isNotNull(), statement("reference", column, f"{parent}.{parent_key}", [F.col(column)])))
                parents[f"{parent}.{parent_key}"] = tables[parent].select(F.col(parent_key).cast("string").alias("__key"))
        required = [f.name for f in contract.schema if not f.nullable and f.name in df.columns]
        said += [F.when(F.col(c).isNull(), statement("not_null", c, None, [F.lit(None)])) for c in required]
        stated.append(
            df.select(F.explode(F.array_compact(F.array(*said))).alias("s")).groupBy("s.rule", "s.column_name", "s.parent", "s.parts")
            .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
            .filter((F.col("rule") != "unique") | (F.col("n_rows") > 1))
        )
    every = reduce(DataFrame.unionByName, stated)
    if parents:
        known = reduce(DataFrame.unionByName, [keys.distinct().withColumn("__of", F.lit(of)) for of, keys in parents.items()])
        # A left join and not an anti join, which would be planned once per table.
        found = known.withColumn("__found", F.lit(True))
        every = every.join(found, (F.col("parent") == F.col("__of")) & (F.element_at("parts", 1) == F.col("__key")), "left")
        every = every.filter(F.col("__found").isNull())
    value = F.when(F.col("rule") != "not_null", F.concat_ws("|", "parts"))
    return every.select("table_name", "rule", "column_name", value.alias("value"), "n_rows")
