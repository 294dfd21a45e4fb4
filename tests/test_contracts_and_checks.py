from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.contracts import CUSTOMERS, INVOICES, KPI_DAILY, Contract, conform
from tenure.operators.checks import contract_violations, fk_orphans, pk_duplicates
from tests.conftest import rows


def schema(*fields):
    return T.StructType([T.StructField(*f) for f in fields])


def test_conform_casts_orders_and_fills(frame):
    df = frame([("7.126", "2024-02-03 04:05:06", "x")], "price string, at string, extra string")
    target = schema(("at", T.DateType()), ("price", T.DecimalType(10, 2)), ("note", T.StringType()))
    out = conform(df, target)
    assert out.columns == ["at", "price", "note"]
    assert rows(out) == [(date(2024, 2, 3), Decimal("7.13"), None)]


def test_conform_null_on_error_or_raise(frame):
    df = frame([("abc",), ("1",)], "n string")
    target = schema(("n", T.IntegerType()))
    assert rows(conform(df, target, on_error="null")) == [(None,), (1,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, target).collect()


def test_conform_refuses_boolean_as_number_and_missing_required(frame):
    df = frame([(True,)], "paid boolean")
    with pytest.raises(ValueError, match="boolean"):
        conform(df, schema(("paid", T.IntegerType())))
    with pytest.raises(ValueError, match="missing"):
        conform(df, CUSTOMERS.schema)
    assert conform(df, schema(("paid", T.BooleanType()))).first().paid is True


def test_contract_types():
    assert KPI_DAILY.schema["mrr"].dataType == T.DecimalType(15, 2)
    assert KPI_DAILY.schema["arpu"].dataType == T.DecimalType(10, 2)
    assert INVOICES.schema["paid"].dataType == T.BooleanType()
    assert not INVOICES.schema["invoice_id"].nullable and INVOICES.schema["failure_reason"].nullable


def test_pk_duplicates_counts_a_hot_key(frame, spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    assert rows(pk_duplicates(df, ["k"])) == [(0, 1000)]


def test_fk_orphans(frame):
    child = frame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id int, parent string")
    parent = frame([("a",), ("a",), ("c",)], "parent string")
    assert rows(fk_orphans(child, "parent", parent, "parent")) == [("b", 2)]


def test_contract_violations_names_table_rule_and_value(frame):
    parent = Contract(schema(("p", T.StringType(), False)), key=("p",))
    child = Contract(
        schema(("c", T.StringType(), False), ("p", T.StringType(), True)),
        key=("c",), references=(("p", "parent", "p"), ("p", "elsewhere", "p")),
    )
    tables = {
        "parent": frame([("a",), ("a",), (None,)], "p string"),
        "child": frame([("x", "a"), ("y", "gone"), ("z", None), (None, "gone")], "c string, p string"),
    }
    assert rows(contract_violations(tables, {"parent": parent, "child": child})) == [
        ("child", "not_null", "c", None, 1),
        ("child", "reference", "p", "gone", 2),
        ("parent", "not_null", "p", None, 1),
        ("parent", "unique", "p", "a", 2),
    ]


def test_checks_read_each_table_once_and_parents_once_more(spark, tmp_path):
    from tenure.contracts import CUSTOMERS, INVOICES, SUBSCRIPTIONS
    from tests.conftest import plan_text

    contracts = {"customers": CUSTOMERS, "subscriptions": SUBSCRIPTIONS, "invoices": INVOICES}
    tables = {}
    for name, c in contracts.items():
        spark.createDataFrame([], c.schema).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    plan = plan_text(contract_violations(tables, contracts))
    assert plan.count("FileScan") == 5  # three tables, and two of them as parents
