"""Test tables mapped to the subscription domain. Every mapping uses the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenure.contracts import MONEY
from tenure.functions.times import as_date, as_timestamp
from tenure.operators.dedup import latest_by

AS_OF = "2001-08-01"
TERM_DAYS = 30
REPRICED_EVERY_DAYS = 48
FIRST_PRICE_LIST = "1995-03-01"

# Country by nation key; the last two are not assigned codes.
NATION_COUNTRIES = [
    "AR", "BR", "CA", "CN", "DE", "EG", "ES", "FR", "GB", "ID", "IN", "IR", "JP",
    "KE", "MA", "MX", "NG", "PE", "RO", "RU", "SA", "US", "VN", "XX", "ZZ",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status() -> Column:
    s = F.col("o_orderstatus")
    return F.when(s == "F", "active").when(s == "P", "trialing").when(s == "O", "canceled")


def _orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.concat(F.lit("S"), F.col("o_custkey")).alias("subscription_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).alias("plan_id"),
        _status().alias("status"),
        F.col("o_orderdate").cast("date").alias("day"),
        "o_orderkey",
    )


def subscription_versions(orders: DataFrame) -> DataFrame:
    """One subscription per customer; each order is a version that lasts until the next order,
    or a term of thirty days if none comes. Versions that reach past the as-of day are open."""
    newest = latest_by(_orders(orders), ["subscription_id", "day"], ["o_orderkey"])
    following = F.lead("day").over(Window.partitionBy("subscription_id").orderBy("day"))
    term_end = F.date_add("day", TERM_DAYS)
    ends = F.least(F.coalesce(following, term_end), term_end)
    return newest.select(
        "subscription_id", "customer_id", "plan_id", "status",
        F.col("day").alias("start_date"),
        F.when(ends <= as_date(AS_OF), ends).alias("end_date"),
    )


def plan_versions(part: DataFrame) -> DataFrame:
    """Five plans of five brands each, repriced every 48 days in order of part size."""
    lists = part.groupBy(
        F.expr("cast((cast(substring(p_brand, 7) as int) + 4) div 5 as string)").alias("plan_id"),
        F.expr(f"date_add(date'{FIRST_PRICE_LIST}', (p_size - 1) * {REPRICED_EVERY_DAYS})").alias("effective_from"),
    ).agg(
        F.min("p_name").alias("plan_name"),
        F.max("p_retailprice").cast(MONEY).alias("monthly_price"),
        F.min("p_type").alias("tier"),
    )
    following = F.lead("effective_from").over(Window.partitionBy("plan_id").orderBy("effective_from"))
    return lists.withColumn("effective_to", F.date_sub(following, 1))


def subscriptions_raw(orders: DataFrame) -> DataFrame:
    """Orders as subscription rows; same-day orders of a customer collide on the key."""
    renews = F.col("plan_id").isin("1", "2")
    return _orders(orders).select(
        "subscription_id", "customer_id", "plan_id", "status",
        F.col("day").alias("start_date"),
        F.when(renews, F.date_add("day", TERM_DAYS)).alias("end_date"),
        F.expr("cast(day as timestamp_ntz) + make_interval(0, 0, 0, 0, 0, 0, o_orderkey)").alias("last_updated"),
    )


def customers_raw(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """A first load of all customers plus a second load that moves one segment to Canada."""
    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("created_at"))
    code = F.element_at(F.array(*[F.lit(c) for c in NATION_COUNTRIES]), F.col("c_nationkey") + 1)
    raw_email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    base = customer.join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", raw_email).otherwise(F.sha2("c_name", 256)).alias("email_hash"),
        F.when(F.col("c_acctbal") < 0, F.lower(code)).otherwise(code).alias("country"),
        F.col("created_at"),
        "c_mktsegment",
    )
    loads = F.when(
        F.col("c_mktsegment") == "BUILDING",
        F.array(F.struct(F.col("country"), as_timestamp("2000-01-01").alias("last_updated")),
                F.struct(F.lit("CA").alias("country"), as_timestamp("2001-01-01").alias("last_updated"))),
    ).otherwise(F.array(F.struct(F.col("country"), as_timestamp("2000-01-01").alias("last_updated"))))
    return base.withColumn("load", F.explode(loads)).select(
        "customer_id", "email_hash", F.col("load.country").alias("country"), "created_at",
        F.col("load.last_updated").alias("last_updated"),
    )


def customer_dates(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers with their signup day: the first order. Of those who never ordered, most signed up on a
    day that their key gives, and every seventh has no known day."""
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    given = F.when(F.col("c_custkey") % 7 != 0, F.expr("date_add(date'1995-01-01', cast(c_custkey % 2000 as int))"))
    return customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.coalesce(F.col("first_order"), given.cast("timestamp_ntz")).alias("created_at"),
    )


def part_plans(part: DataFrame) -> DataFrame:
    """Each part as a plan of its own."""
    return part.select(
        F.col("p_partkey").cast("string").alias("plan_id"),
        F.col("p_type").alias("plan_name"),
        F.col("p_retailprice").cast(MONEY).alias("monthly_price"),
        F.col("p_brand").alias("tier"),
        as_date("1995-01-01").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        as_timestamp("1995-01-01").alias("last_updated"),
    )


def current_subscriptions(orders: DataFrame, cut: str) -> DataFrame:
    """What a source system showed on ``cut``: the newest order of each customer as its subscription."""
    known = _orders(orders).filter(F.col("day") <= as_date(cut))
    return latest_by(known, ["subscription_id"], ["day", "o_orderkey"]).select(
        "subscription_id", "customer_id", "plan_id", "status",
        F.col("day").alias("sub_start_date"),
        F.when(F.col("status") == "canceled", F.date_add("day", TERM_DAYS)).alias("sub_end_date"),
    )


def invoices_raw(lineitem: DataFrame) -> DataFrame:
    """Line items as invoices. Many share an invoice id, so there are real duplicates."""
    failed = F.col("l_returnflag") == "R"
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("invoice_id"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        F.col("l_orderkey").cast("string").alias("subscription_id"),
        F.col("l_shipdate").cast("date").alias("invoice_date"),
        (F.when(F.col("l_quantity") < 3, -1).otherwise(1) * F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("amount"),
        F.when(F.col("l_linestatus") == "F", "USD").otherwise("EUR").alias("currency"),
        (~failed).alias("paid"),
        F.when(failed & (F.col("l_discount") > 0.02), "card_declined").alias("failure_reason"),
        F.col("l_shipdate").alias("last_updated"),
    )


def raw_events(events: DataFrame, event_id: Column) -> DataFrame:
    """Events as they would arrive: text timestamps and a nested payload."""
    code = F.concat(F.lit("code_"), F.get_json_object("props", "$.k"))
    return events.select(
        event_id.alias("event_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_ts"),
        F.struct(
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("value").cast(MONEY).alias("amount"),
            F.when(F.col("event_type") == "error", code).alias("failure_reason"),
        ).alias("payload"),
    )


def unique_event_id() -> Column:
    return F.col("event_id").cast("string")


def coarse_event_id() -> Column:
    """One id per user, day and type, so that ids repeat."""
    return F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd"), F.col("event_type"))


def user_dates(events: DataFrame) -> DataFrame:
    """Event users with their first event as the signup day."""
    return events.groupBy(F.col("user_id").cast("string").alias("customer_id")).agg(
        F.min("ts").alias("created_at")
    )


# --- two loads through the jobs --------------------------------------------------------

#: The second load has all orders, up to their last day; the jobs run for two months more.
FIRST_CUT, SECOND_CUT, JOB_AS_OF = "2001-04-30", AS_OF, "2001-09-30"
FIRST_RUN, SECOND_RUN = "2001-05-01 06:00:00", "2001-08-02 06:00:00"


def _source_subscriptions(orders: DataFrame, cut: str) -> DataFrame:
    return current_subscriptions(orders, cut).withColumnsRenamed({"sub_start_date": "start_date", "sub_end_date": "end_date"}).withColumn(
        "last_updated", F.col("start_date").cast("timestamp_ntz")
    )


def _source_plans(part: DataFrame, repriced: bool) -> DataFrame:
    """All price lists; in the second load the lists of plan 1 are dearer by ten."""
    lists = plan_versions(part).withColumn("last_updated", as_timestamp(FIRST_CUT))
    if not repriced:
        return lists
    return lists.filter("plan_id = '1'").withColumns({
        "monthly_price": (F.col("monthly_price") + 10).cast(MONEY), "last_updated": as_timestamp(SECOND_CUT),
    })


def first_load(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Everything as the sources showed it on the first day."""
    orders = table(spark, sf, "orders")
    customers = customers_raw(table(spark, sf, "customer"), orders).filter(F.col("last_updated") <= as_timestamp("2000-01-01"))
    return {
        "customers": customers, "plans": _source_plans(table(spark, sf, "part"), repriced=False),
        "subscriptions": _source_subscriptions(orders, FIRST_CUT), "invoices": invoices_raw(table(spark, sf, "lineitem")),
    }


def second_load(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """What is newer: subscriptions with a later order, dearer price lists, moved customers."""
    orders = table(spark, sf, "orders")
    newer = _source_subscriptions(orders, SECOND_CUT).filter(F.col("start_date") > as_date(FIRST_CUT))
    customers = customers_raw(table(spark, sf, "customer"), orders).filter(F.col("last_updated") > as_timestamp("2000-01-01"))
    return {"customers": customers, "plans": _source_plans(table(spark, sf, "part"), repriced=True), "subscriptions": newer}
