"""Every registered query against its SQL on the smallest scale."""

import os

import pytest

from testbed.compare import compare, connect
from testbed.oracle import oracle_sql
from testbed.registry import queries
from tests.conftest import TESTDATA

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="needs the driver's test tables")


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    n_rows, problem = compare(spark, con, TESTDATA, name)
    assert problem is None
    assert n_rows > 0


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[0] == "dt"
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_no_python_workers_in_any_query(spark):
    from tests.conftest import plan_text

    for name in ("customers_silver", "invoices_silver", "kpi_daily", "retention_cohorts", "scd2_merge_subscriptions"):
        plan = plan_text(queries()[name](spark, TESTDATA))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
