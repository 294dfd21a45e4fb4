"""Table contracts: column types, keys and references, plus the cast into a contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_TOTAL = T.DecimalType(15, 2)
RATE = T.DecimalType(5, 4)

#: Columns that describe a load rather than the business entity.
LOAD_METADATA = ("last_updated", "ingestion_date", "source_file")

SCD2_COLUMNS = ("start_date", "end_date", "active_status")


@dataclass(frozen=True)
class Contract:
    """Schema of one table, its key, and ``(column, parent table, parent column)`` references."""

    schema: T.StructType
    key: tuple[str, ...]
    references: tuple[tuple[str, str, str], ...] = ()


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": MONEY,
    "total": MONEY_TOTAL,
    "rate": RATE,
    "payload": T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("failure_reason", T.StringType()),
    ]),
}


def _schema(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    """A schema from ``name type`` pairs; works without a session."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in required) for n, t in pairs])


# Names and types of the tables as sources and marts have them.
CUSTOMERS = Contract(
    _schema(
        "customer_id string, email_hash string, country string, created_at timestamp,"
        " last_updated timestamp",
        required=("customer_id", "email_hash", "last_updated"),
    ),
    key=("customer_id",),
)

PLANS = Contract(
    _schema(
        "plan_id string, plan_name string, monthly_price money, tier string,"
        " effective_from date, effective_to date, last_updated timestamp",
        required=("plan_id", "plan_name", "monthly_price", "tier", "effective_from", "last_updated"),
    ),
    key=("plan_id",),
)

SUBSCRIPTIONS = Contract(
    _schema(
        "subscription_id string, customer_id string, plan_id string, status string,"
        " start_date date, end_date date, last_updated timestamp",
        required=("subscription_id", "customer_id", "plan_id", "status", "start_date", "last_updated"),
    ),
    key=("subscription_id",),
    references=(("customer_id", "customers", "customer_id"), ("plan_id", "plans", "plan_id")),
)

INVOICES = Contract(
    _schema(
        "invoice_id string, customer_id string, subscription_id string, invoice_date date,"
        " amount money, currency string, paid boolean, failure_reason string,"
        " last_updated timestamp",
        required=(
            "invoice_id", "customer_id", "subscription_id", "invoice_date", "amount", "currency",
            "paid", "last_updated",
        ),
    ),
    key=("invoice_id",),
    references=(
        ("customer_id", "customers", "customer_id"),
        ("subscription_id", "subscriptions", "subscription_id"),
    ),
)

EVENTS = Contract(
    _schema(
        "event_id string, event_type string, event_ts string,"
        " payload payload",
        required=("event_id",),
    ),
    key=("event_id",),
)

FACT_DAILY = Contract(
    _schema(
        "dt date, subscription_id string, customer_id string, plan_id string,"
        " status_at_day string, plan_name string, tier_at_day string,"
        " monthly_price_at_day money, is_active int, is_trialing int, is_canceled int"
    ),
    key=("subscription_id", "dt"),
)

KPI_DAILY = Contract(
    _schema(
        "dt date, mrr total, new_mrr total, expansion_mrr total,"
        " contraction_mrr total, churn_mrr total, active_customers bigint,"
        " arr total, arpu money"
    ),
    key=("dt",),
)

RETENTION = Contract(
    _schema(
        "cohort_month date, cohort_size int, period_name string, period_number int,"
        " period_date date, retained_users int, retention_rate rate, cohort_type string"
    ),
    key=("cohort_month", "period_number", "cohort_type"),
)

COPY_CONFIG = Contract(
    _schema(
        "source_name string, load_type string, source_query string",
        required=("source_name", "load_type"),
    ),
    key=("source_name",),
)


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in its contract, followed by the columns that the contract doesn't know, as they came.

    Values that can't be cast become null and are named in ``__unusable`` (array of column names).
    """
    present = {f.name: f.dataType for f in df.schema}
    extra = [c for c in df.columns if c not in schema.names]
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema if f.name in present and present[f.name] != f.dataType
    ]
    unusable = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    marked = df.withColumn("__unusable", unusable)
    cast = conform(marked, T.StructType([*schema, *(T.StructField(c, present[c]) for c in extra), T.StructField("__unusable", T.ArrayType(T.StringType()))]), on_error="null")
    return cast


def conform(df: DataFrame, schema: T.StructType, on_error: str = "raise") -> DataFrame:
    """Project ``df`` onto ``schema``, casting each column.

    Narrowing casts are allowed (a timestamp loses its time of day, a decimal is rounded
    to scale). A boolean is never turned into a number. ``on_error='null'`` turns values
    that cannot be cast into nulls, ``'raise'`` lets the ANSI cast fail. A missing
    nullable column becomes a typed null.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', got {on_error!r}")
    present = {f.name: f.dataType for f in df.schema}

    def projected(field: T.StructField) -> Column:
        if field.name not in present:
            if not field.nullable:
                raise ValueError(f"required column {field.name!r} is missing")
            return F.lit(None).cast(field.dataType).alias(field.name)
        have = present[field.name]
        if isinstance(have, T.BooleanType) and isinstance(field.dataType, T.NumericType):
            raise ValueError(f"column {field.name!r} is boolean and may not become a number")
        value = F.col(field.name)
        if have != field.dataType:
            value = value.try_cast(field.dataType) if on_error == "null" else value.cast(field.dataType)
        return value.alias(field.name)

    return df.select([projected(f) for f in schema])
