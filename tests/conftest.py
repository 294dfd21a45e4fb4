import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tenure-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a frame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def day(text):
    return date.fromisoformat(text) if text else None


def ts(text):
    return datetime.fromisoformat(text) if text else None


def money(text):
    return Decimal(text) if text is not None else None


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_text(df):
    """The physical plan as Spark prints it."""
    return df._jdf.queryExecution().executedPlan().toString()
