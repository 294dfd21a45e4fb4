"""The checked queries: one per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure import contracts, jobs
from tenure.contracts import CUSTOMERS, EVENTS, INVOICES, SUBSCRIPTIONS, conform
from tenure.functions.countries import assigned_country_codes
from tenure.functions.times import as_date, as_timestamp
from tenure.jobs import Layout
from tenure.marts import RetentionMart
from tenure.operators.asof import asof_join
from tenure.operators.bitmaps import numbered
from tenure.operators.checks import contract_violations, fk_orphans, pk_duplicates
from tenure.operators.islands import coalesced
from tenure.operators.scd2 import (
    row_hash,
    scd2_changes,
    scd2_initial,
    scd2_merge,
    scd2_staged,
    seed_rows,
)
from tenure.operators.updates import conditional_update
from tenure.plans import cohorts, dimensions, fact, kpi, silver
from tenure.plans.bronze import bronze, bronze_events
from tenure.sources.extract import extract_all, full_extract, incremental_extract, next_watermark
from tenure.sources.payloads import field, read_lines, shredded
from tenure.sources.pruned_dimension import PrunedDimension
from tenure.sources.references import ReferenceCounts, deltas
from tenure.sources.scratch import scratch_path
from tenure.sources.split_table import SplitTable
from tenure.sources.tables import (
    overwrite_partitions,
    read_event_files,
    read_landing,
    read_table,
    with_month,
    write_landing,
    write_table,
)
from tenure.streaming.engagement import EngagementStream
from tenure.streaming.events import drop_redelivered, event_stream, stream_session, write_available
from testbed import domain as d

LOAD_TS = "2001-08-01 06:00:00"
FIRST_LOAD_TS = "2000-01-01 00:00:00"
EVENTS_AS_OF = "2024-01-31"
WINDOW = ("1999-05-01", "1999-08-31")

Query = Callable[[SparkSession, str], DataFrame]


def _portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, so that any engine's result compares."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        columns.append(c)
    return df.select(columns)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "orders")


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    return d.subscription_versions(_orders(spark, sf))


def _plans(spark: SparkSession, sf: str) -> DataFrame:
    return d.plan_versions(d.table(spark, sf, "part"))


def _bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    raw = d.customers_raw(d.table(spark, sf, "customer"), _orders(spark, sf))
    return bronze(conform(raw, CUSTOMERS.schema), "customers", LOAD_TS)


def _bronze_invoices(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(d.invoices_raw(d.table(spark, sf, "lineitem")), "invoices", LOAD_TS)


def _bronze_subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(d.subscriptions_raw(_orders(spark, sf)), "subscriptions", LOAD_TS)


def _fact(spark: SparkSession, sf: str, **options) -> DataFrame:
    return fact.fact_daily(_versions(spark, sf), _plans(spark, sf), d.AS_OF, **options)


# --- extracts -------------------------------------------------------------------------


def _register_sources(spark: SparkSession, sf: str) -> None:
    for name in ("customer", "orders", "part", "lineitem"):
        d.table(spark, sf, name).createOrReplaceTempView(f"src_{name}")


def full_extract_q(spark: SparkSession, sf: str) -> DataFrame:
    _register_sources(spark, sf)
    return full_extract(
        spark, "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM src_part"
    )


def incremental_extract_q(spark: SparkSession, sf: str) -> DataFrame:
    return incremental_extract(_orders(spark, sf), "1999-12-31", "o_orderdate")


def next_watermark_q(spark: SparkSession, sf: str) -> DataFrame:
    fresh = incremental_extract(d.table(spark, sf, "lineitem"), "1999-12-31", "l_shipdate")
    return next_watermark(fresh, "1999-12-31", "l_shipdate")


def config_extract_q(spark: SparkSession, sf: str) -> DataFrame:
    """Four sources, two of each load type; what each extract brought."""
    _register_sources(spark, sf)
    config = spark.createDataFrame(
        [
            ("customer", "full", "SELECT c_custkey AS id FROM src_customer"),
            ("part", "full", "SELECT p_partkey AS id FROM src_part"),
            ("orders", "incremental", None),
            ("lineitem", "incremental", None),
        ],
        "source_name string, load_type string, source_query string",
    )

    def read(name: str) -> DataFrame:
        key, day = {"orders": ("o_orderkey", "o_orderdate"), "lineitem": ("l_orderkey", "l_shipdate")}[name]
        return spark.table(f"src_{name}").select(F.col(key).alias("id"), F.col(day).alias("last_updated"))

    summaries = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
        .select(F.lit(name).alias("source_name"), "n_rows", "min_id", "max_id")
        for name, df in extract_all(spark, config, read, since="1998-06-30").items()
    ]
    result = summaries[0]
    for s in summaries[1:]:
        result = result.unionByName(s)
    return result


def contract_cast_q(spark: SparkSession, sf: str) -> DataFrame:
    """Invoices that arrive as text, some of it unusable, cast into their contract."""
    raw = d.invoices_raw(d.table(spark, sf, "lineitem"))
    text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    broken = text.withColumns({
        "amount": F.when(F.col("currency") == "EUR", F.concat("amount", F.lit(" EUR"))).otherwise(F.col("amount")),
        "invoice_date": F.when(F.col("failure_reason").isNotNull(), "pending").otherwise(F.col("invoice_date")),
    })
    return conform(broken, INVOICES.schema, on_error="null")


# --- bronze and silver ----------------------------------------------------------------


def bronze_stamp_q(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_subscriptions(spark, sf)


def bronze_customers_q(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_customers(spark, sf)


def bronze_plans_q(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(d.part_plans(d.table(spark, sf, "part")), "plans", LOAD_TS)


def bronze_invoices_q(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_invoices(spark, sf)


def _land_events(spark: SparkSession, sf: str, name: str, redeliver: bool = False) -> str:
    """Write the events as JSON lines to scratch space; optionally deliver purchases again."""
    raw = d.raw_events(d.table(spark, sf, "events"), d.unique_event_id())
    path = scratch_path(spark, name)
    raw.write.json(path)
    if redeliver:
        raw.filter(F.col("event_type") == "purchase").write.mode("append").json(path)
    return path


def events_flatten_q(spark: SparkSession, sf: str) -> DataFrame:
    landed = read_event_files(spark, _land_events(spark, sf, "events-landing"))
    return bronze_events(landed.drop("_corrupt_record"), LOAD_TS)


def events_variant_q(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose payload grows: the second batch brings a channel and a nested device. Known fields and new ones, from both batches."""
    raw = d.raw_events(d.table(spark, sf, "events"), d.unique_event_id())
    number = F.col("event_id").cast("long")
    plain = raw.filter(number % 2 == 0).select(F.to_json(F.struct(*raw.columns)).alias("value"))
    device = F.struct(F.concat(F.lit("os"), number % 3).alias("os"), F.array(number % 5, number % 7).alias("sizes"))
    grown = raw.filter(number % 2 == 1).withColumns({"channel": F.concat(F.lit("ch"), number % 4), "device": device})
    path, known = scratch_path(spark, "payloads"), T.StructType([f for f in EVENTS.schema if f.name in ("event_id", "event_type")])
    for batch, lines in (("1", plain), ("2", grown.select(F.to_json(F.struct(*grown.columns)).alias("value")))):
        lines.write.text(f"{path}/landing/batch={batch}")
        shredded(read_lines(spark, [f"{path}/landing/batch={batch}"]), known).write.mode("append").parquet(f"{path}/events")
    return spark.read.parquet(f"{path}/events").select(
        "event_id", "event_type", field("$.payload.customer_id", "string").alias("customer_id"), field("$.channel", "string").alias("channel"),
        field("$.device.os", "string").alias("os"), field("$.device.sizes[1]", "bigint").alias("size"), "unreadable",
    )


def customers_silver_q(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_customers(_bronze_customers(spark, sf), assigned_country_codes(spark))


def plans_silver_q(spark: SparkSession, sf: str) -> DataFrame:
    """Parts collide on plan and effective date; the one with the highest key is newest."""
    part = d.table(spark, sf, "part")
    raw = d.part_plans(part).withColumns({
        "plan_id": F.col("tier"),
        "effective_from": F.date_add("effective_from", F.length("plan_name")),
        "last_updated": F.col("last_updated") + F.make_dt_interval(F.col("plan_id").cast("int")),
    })
    return silver.clean_plans(bronze(raw, "plans", LOAD_TS))


def subscriptions_silver_q(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_subscriptions(_bronze_subscriptions(spark, sf))


def invoices_silver_q(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_invoices(_bronze_invoices(spark, sf))


def events_silver_q(spark: SparkSession, sf: str) -> DataFrame:
    raw = d.raw_events(d.table(spark, sf, "events"), d.coarse_event_id())
    return silver.clean_events(bronze_events(raw, LOAD_TS))


# --- dimensions -----------------------------------------------------------------------


def scd2_initial_q(spark: SparkSession, sf: str) -> DataFrame:
    plans = d.part_plans(d.table(spark, sf, "part"))
    return scd2_initial(plans.filter(F.col("plan_name").isin("ECONOMY", "SMALL")), FIRST_LOAD_TS)


def scd2_seed_q(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension begun with its first four keys, as a partial first load."""
    customers = conform(d.customers_raw(d.table(spark, sf, "customer"), _orders(spark, sf)), CUSTOMERS.schema)
    newest = silver.latest_by(customers, ["customer_id"], ["last_updated"])
    return scd2_initial(seed_rows(newest, ["customer_id"], 4), FIRST_LOAD_TS)


def _repriced_plans(spark: SparkSession, sf: str) -> DataFrame:
    plans = d.part_plans(d.table(spark, sf, "part"))
    return conditional_update(plans, F.col("plan_name") == "ECONOMY", {"monthly_price": F.lit(101)})


def conditional_update_q(spark: SparkSession, sf: str) -> DataFrame:
    return _repriced_plans(spark, sf)


def _early_subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_initial(d.current_subscriptions(_orders(spark, sf), "1997-12-31"), "1998-01-01 00:00:00")


def _subscription_changes(spark: SparkSession, sf: str) -> DataFrame:
    source = d.current_subscriptions(_orders(spark, sf), d.AS_OF)
    return scd2_changes(
        source, _early_subscriptions(spark, sf), dimensions.SUBSCRIPTION_KEY, dimensions.SUBSCRIPTION_TRACKED
    )


def scd2_changes_digest_q(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes, from those parts of the stored dimension only whose digest differs from the source's."""
    keys, tracked = dimensions.SUBSCRIPTION_KEY, dimensions.SUBSCRIPTION_TRACKED
    stored = SplitTable(spark, scratch_path(spark, "digests"), keys, max_bytes=16_384, digest_columns=[*keys, *tracked])
    stored.create(_early_subscriptions(spark, sf))
    source = d.current_subscriptions(_orders(spark, sf), d.AS_OF)
    parts = stored.differing(source)
    located = stored.located(source)
    return scd2_changes(located.filter(F.col("part").isin(parts)).drop("part"), stored.read(parts), keys, tracked)


def scd2_changes_q(spark: SparkSession, sf: str) -> DataFrame:
    return _subscription_changes(spark, sf)


def scd2_staged_q(spark: SparkSession, sf: str) -> DataFrame:
    staged = scd2_staged(_subscription_changes(spark, sf), dimensions.SUBSCRIPTION_KEY)
    return staged.select("MERGEKEY", "subscription_id", "plan_id", "status", "sub_start_date")


def scd2_merge_customers_q(spark: SparkSession, sf: str) -> DataFrame:
    """The state after the first load, with one country spoilt, meets the state after both loads."""
    loads = _bronze_customers(spark, sf)
    metadata = ("last_updated", "ingestion_date", "source_file")
    first = silver.clean_customers(loads.filter(F.col("last_updated") <= as_timestamp("2000-01-01")), assigned_country_codes(spark))
    known = scd2_initial(first.drop(*metadata), FIRST_LOAD_TS)
    spoilt = conditional_update(known, F.col("country") == "IN", {"country": "test", "is_valid_country": False})
    return dimensions.merge_customers(spoilt, customers_silver_q(spark, sf).drop(*metadata), LOAD_TS)


def scd2_merge_plans_q(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.merge_plans(scd2_initial_q(spark, sf), _repriced_plans(spark, sf), LOAD_TS)


def scd2_merge_subscriptions_q(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads on top of a first one, so that history from before takes part."""
    orders = _orders(spark, sf)
    dimension = _early_subscriptions(spark, sf)
    for cut, as_of in (("1999-12-31", "2000-01-01 00:00:00"), (d.AS_OF, LOAD_TS)):
        dimension = dimensions.merge_subscriptions(dimension, d.current_subscriptions(orders, cut), as_of)
    return dimension


def scd2_merge_pruned_q(spark: SparkSession, sf: str) -> DataFrame:
    """The same two loads, each by the rows that changed since the one before: only files that may hold their keys are read."""
    orders = _orders(spark, sf)
    stored = PrunedDimension(spark, scratch_path(spark, "pruned"), dimensions.SUBSCRIPTION_KEY, dimensions.SUBSCRIPTION_TRACKED, rows_per_file=500)
    shown = d.current_subscriptions(orders, "1997-12-31")
    stored.create(shown, "1997-12-31", "1998-01-01 00:00:00")
    previous = "1997-12-31"
    for cut, as_of in (("1999-12-31", "2000-01-01 00:00:00"), (d.AS_OF, LOAD_TS)):
        before, shown = shown, d.current_subscriptions(orders, cut)
        stored.merge(shown.subtract(before), previous, cut, as_of)
        previous = cut
    return stored.read(previous)


def scd2_close_missing_q(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that left the price list (the smallest sizes) are closed when asked for."""
    part = d.table(spark, sf, "part")
    target = scd2_initial(d.part_plans(part), FIRST_LOAD_TS)
    remaining = d.part_plans(part.filter(F.col("p_size") > 10))
    return scd2_merge(target, remaining, ["plan_id"], LOAD_TS, dimensions.PLAN_TRACKED, close_missing=True)


def row_hash_q(spark: SparkSession, sf: str) -> DataFrame:
    """Orders grouped by three columns and by the hash of those columns: equal hashes must mean equal values."""
    hashed = row_hash(d.subscriptions_raw(_orders(spark, sf)).select("plan_id", "status", "start_date"), ["plan_id", "status", "start_date"])
    by_value = hashed.groupBy("plan_id", "status", "start_date", "row_hash").agg(F.count(F.lit(1)).alias("n_equal_values"))
    by_hash = by_value.groupBy("row_hash").agg(F.sum("n_equal_values").alias("n_equal_hashes"), F.count(F.lit(1)).alias("n_values"))
    return by_value.join(by_hash, "row_hash").drop("row_hash")


# --- sinks ----------------------------------------------------------------------------


def sink_roundtrip_q(spark: SparkSession, sf: str) -> DataFrame:
    """Landing batch, then an overwritten table, then back."""
    raw = d.invoices_raw(d.table(spark, sf, "lineitem"))
    root = scratch_path(spark, "roundtrip")
    write_landing(raw, root, "invoices", "20010801")
    landed = read_landing(spark, root, "invoices", raw.schema, "20010801")
    write_table(bronze(landed, "invoices", LOAD_TS), f"{root}/bronze/invoices")
    return read_table(spark, f"{root}/bronze/invoices", merge_schema=True)


def partition_overwrite_q(spark: SparkSession, sf: str) -> DataFrame:
    """A table by month whose months from 2000 on are written again with doubled amounts."""
    amounts = with_month(_orders(spark, sf).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("dt"), "o_totalprice"
    ))
    path = scratch_path(spark, "by-month")
    write_table(amounts, path, partition_by=["dt_month"])
    recent = amounts.filter(F.col("dt") >= as_date("2000-01-01"))
    overwrite_partitions(recent.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["dt_month"])
    return read_table(spark, path)


# --- fact and KPIs --------------------------------------------------------------------


def date_spine_q(spark: SparkSession, sf: str) -> DataFrame:
    return fact.date_spine(_versions(spark, sf), d.AS_OF).drop("version_no")


def asof_plan_join_q(spark: SparkSession, sf: str) -> DataFrame:
    windows = fact.subscription_windows(_versions(spark, sf), d.AS_OF).select("subscription_id", "plan_id", "first_day", "last_day")
    return fact.priced_days(windows, _plans(spark, sf))


def asof_merge_join_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of every version with its plan, by one merge of days and price lists; the five plans hold a fifth of the days each."""
    days = fact.date_spine(_versions(spark, sf), d.AS_OF).select("subscription_id", "plan_id", "dt")
    return asof_join(days, _plans(spark, sf), "plan_id", "dt", "effective_from", "effective_to", ["subscription_id"], rows_per_stretch=10_000)


def date_spine_coalesced_q(spark: SparkSession, sf: str) -> DataFrame:
    """The days of versions of which neighbours that say the same were joined first."""
    joined = coalesced(_versions(spark, sf), ["subscription_id"], ["customer_id", "plan_id", "status"])
    return fact.date_spine(joined, d.AS_OF).drop("version_no")


def fact_daily_q(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def fact_daily_inclusive_q(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf, end_rule="inclusive")


def kpi_snapshot_q(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.kpi_snapshot(_fact(spark, sf, for_kpi=True))


def kpi_deltas_q(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.kpi_deltas(kpi_snapshot_q(spark, sf))


def kpi_daily_q(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.kpi_daily(_fact(spark, sf, for_kpi=True))


def kpi_daily_inclusive_q(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.kpi_daily(_fact(spark, sf, end_rule="inclusive", for_kpi=True))


def kpi_daily_window_q(spark: SparkSession, sf: str) -> DataFrame:
    """Recomputing a date window gives the same days as the full computation."""
    return kpi.kpi_daily(_fact(spark, sf, for_kpi=True, from_dt=WINDOW[0], to_dt=WINDOW[1]), *WINDOW)


def kpi_daily_changepoints_q(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.kpi_daily_changepoints(_versions(spark, sf), _plans(spark, sf), d.AS_OF)


# --- cohorts --------------------------------------------------------------------------


def _signups(spark: SparkSession, sf: str) -> DataFrame:
    return d.customer_dates(d.table(spark, sf, "customer"), _orders(spark, sf))


def _cohorts(spark: SparkSession, sf: str, grain: str = "month") -> DataFrame:
    return cohorts.customer_cohorts(_signups(spark, sf), grain)


def customer_cohorts_q(spark: SparkSession, sf: str) -> DataFrame:
    return _cohorts(spark, sf)


def customer_cohorts_week_q(spark: SparkSession, sf: str) -> DataFrame:
    return _cohorts(spark, sf, "week")


def cohort_sizes_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.cohort_sizes(_cohorts(spark, sf))


def cohort_sizes_bitmap_q(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers per cohort, counted in bitmaps that three loads merged."""
    mart, batch = _retention_mart(spark, sf)
    return mart.sizes(batch)


def retention_bitmap_q(spark: SparkSession, sf: str) -> DataFrame:
    """Retention from daily rows that came in three loads, each read once."""
    mart, batch = _retention_mart(spark, sf)
    return mart.read(batch, d.AS_OF)


def _retention_mart(spark: SparkSession, sf: str) -> tuple[RetentionMart, str]:
    mart, previous, low = RetentionMart(spark, scratch_path(spark, "retention")), None, "1995-01-01"
    daily = _fact(spark, sf)
    for high in ("1998-01-01", "2000-01-01", "2001-08-02"):
        known = _signups(spark, sf).filter(F.col("created_at") < as_date(high))
        part = daily.filter((F.col("dt") >= as_date(low)) & (F.col("dt") < as_date(high)))
        days = spark.range(1).select(F.explode(F.sequence(as_date(low), F.date_sub(as_date(high), 1))).alias("dt"))
        mart.update(high, known, part, days, previous)
        previous = low = high
    return mart, previous


def cohort_period_matrix_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.cohort_period_matrix(_cohorts(spark, sf), d.AS_OF)


def retention_cohorts_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.retention_cohorts(_signups(spark, sf), _versions(spark, sf), d.AS_OF)


def retention_from_fact_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.retention_from_fact(_signups(spark, sf), _fact(spark, sf), d.AS_OF)


def retention_engagement_q(spark: SparkSession, sf: str) -> DataFrame:
    events = d.table(spark, sf, "events")
    seen = events.select(F.col("user_id").cast("string").alias("customer_id"), F.col("ts").alias("event_ts"))
    return cohorts.retention_engagement(d.user_dates(events), seen, EVENTS_AS_OF, "week")


def engagement_stream_q(spark: SparkSession, sf: str) -> DataFrame:
    """Engagement cells kept up to date by the event stream, numbered customers beside it."""
    events = d.table(spark, sf, "events")
    own = cohorts.customer_cohorts(d.user_dates(events), "week")
    root = scratch_path(spark, "engagement")
    members = own.join(numbered(own.select("customer_id"), "customer_id", None, f"{root}/numbers"), "customer_id").select("customer_id", "cohort_month", "number")
    write_table(members, f"{root}/members")
    session = stream_session(spark, spark.sparkContext.defaultParallelism)
    engaged = EngagementStream(session, f"{root}/mart", read_table(session, f"{root}/members"))
    engaged.run(event_stream(session, _land_events(spark, sf, "engagement-landing", redeliver=True), EVENTS.schema))
    return engaged.read(EVENTS_AS_OF)


# --- the whole flow -------------------------------------------------------------------

_LAKES: dict[tuple[str, str], Layout] = {}


def _lake(spark: SparkSession, sf: str) -> tuple[Layout, str]:
    """The layers after two loads of the mapped tables, made once per session and scale."""
    made = (spark.sparkContext.applicationId, sf)
    if made not in _LAKES:
        layout = Layout(scratch_path(spark, "lake"))
        previous = None
        for batch, run, extracts in (("b1", d.FIRST_RUN, d.first_load(spark, sf)), ("b2", d.SECOND_RUN, d.second_load(spark, sf))):
            jobs.land(extracts, layout, batch)
            jobs.load_bronze(spark, layout, batch, run, list(extracts))
            jobs.load_silver(spark, layout, batch, tables=list(extracts))
            jobs.load_dimensions(spark, layout, batch, run, previous_batch=previous)
            previous = batch
        _LAKES[made] = layout
    return _LAKES[made], "b2"


BUSINESS = {"valid_from": "sub_start_date", "valid_to": "sub_end_date"}


def job_fact_q(spark: SparkSession, sf: str) -> DataFrame:
    layout, batch = _lake(spark, sf)
    jobs.load_fact(spark, layout, batch, d.JOB_AS_OF)
    return read_table(spark, layout.silver("fact_subscription_daily")).drop("dt_month")


def _job_gold(spark: SparkSession, sf: str, name: str, validity: dict[str, str]) -> DataFrame:
    layout, batch = _lake(spark, sf)
    jobs.load_gold(spark, layout, batch, d.JOB_AS_OF, **validity)
    # Copied, because the next mart of another kind of time takes its place.
    out = scratch_path(spark, name)
    write_table(read_table(spark, layout.gold(name)), out)
    return read_table(spark, out)


def job_kpi_q(spark: SparkSession, sf: str) -> DataFrame:
    return _job_gold(spark, sf, "gold_kpi_daily", {})


def job_kpi_business_q(spark: SparkSession, sf: str) -> DataFrame:
    return _job_gold(spark, sf, "gold_kpi_daily", BUSINESS)


def job_retention_q(spark: SparkSession, sf: str) -> DataFrame:
    return _job_gold(spark, sf, "gold_retention_cohorts", BUSINESS)


def kpi_incremental_q(spark: SparkSession, sf: str) -> DataFrame:
    """The KPIs in load time, kept up to date by what each of the two loads changed."""
    return _kpi_incremental(spark, sf)


def kpi_incremental_business_q(spark: SparkSession, sf: str) -> DataFrame:
    return _kpi_incremental(spark, sf, **BUSINESS)


def _kpi_incremental(spark: SparkSession, sf: str, **validity: str) -> DataFrame:
    layout, last = _lake(spark, sf)
    for batch, previous in (("b1", None), ("b2", "b1")):
        jobs.load_kpi_changes(spark, layout, batch, previous, **validity)
    return jobs.read_kpi_changes(spark, layout, last, d.JOB_AS_OF, **validity)


def silver_rejects_q(spark: SparkSession, sf: str) -> DataFrame:
    """What silver keeps and what it rejects, by rule, after both loads."""
    layout, _ = _lake(spark, sf)
    counts = []
    for name in ("customers", "plans", "subscriptions", "invoices"):
        kept = jobs.current(spark, layout, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit("kept").alias("rule"), "n_rows")
        gone = jobs.rejected(spark, layout, name).groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "rule", "n_rows")
        counts += [kept, gone]
    return reduce(DataFrame.unionByName, counts)


def event_rejects_q(spark: SparkSession, sf: str) -> DataFrame:
    """Events of which errors come without a time, clicks with one that can't be read, and purchases cut off in the middle of their line."""
    layout = Layout(scratch_path(spark, "stream-lake"))
    raw = d.raw_events(d.table(spark, sf, "events"), d.unique_event_id())
    odd = raw.withColumn("event_ts", F.when(F.col("event_type") == "click", "soon").when(F.col("event_type") != "error", F.col("event_ts")))
    line = F.to_json(F.struct(*raw.columns))
    text = F.when(F.col("event_type") == "purchase", F.substring(line, 1, 40)).otherwise(line)
    odd.select(text.alias("value")).write.text(f"{layout.landing}/event_stream")
    jobs.load_event_stream(spark, layout, "40 days", spark.sparkContext.defaultParallelism)
    counts = [
        read_table(spark, layout.silver("event_stream")).select(F.lit("kept").alias("reason")),
        read_table(spark, layout.silver("event_stream_unreadable")).select("reason"),
        read_table(spark, layout.silver("event_stream_late")).select(F.lit("late").alias("reason")),
    ]
    return reduce(DataFrame.unionByName, counts).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))

def event_late_q(spark: SparkSession, sf: str) -> DataFrame:
    """Events in two deliveries, signups of the whole month in the second: those at or before the first one's watermark are late.

    Each run of the stream reads its own files only; every event is in one of the two tables.
    """
    layout = Layout(scratch_path(spark, "late-lake"))
    raw = d.raw_events(d.table(spark, sf, "events"), d.unique_event_id())
    signup = F.col("event_type") == "signup"
    for delivery in (raw.filter(~signup), raw.filter(signup)):
        delivery.write.mode("append").json(f"{layout.landing}/event_stream")
        jobs.load_event_stream(spark, layout, "10 days", spark.sparkContext.defaultParallelism)
    kept, late = (read_table(spark, layout.silver(t)).select("event_id", "event_type", "event_ts", F.lit(k).alias("kind"))
                  for t, k in (("event_stream", "kept"), ("event_stream_late", "late")))
    return kept.unionByName(late)


# --- checks and streams ---------------------------------------------------------------


def fk_orphans_q(spark: SparkSession, sf: str) -> DataFrame:
    """The foreign keys of the given tables: how many values and rows each refers with, and how many of them find no parent."""
    out = []
    for child, column, parent, key in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"), ("events", "user_id", "customer", "c_custkey"),
    ):
        orphans = fk_orphans(d.table(spark, sf, child), column, d.table(spark, sf, parent), key)
        out.append(orphans.agg(F.count(F.lit(1)).alias("n_values"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
                   .select(F.lit(f"{child}.{column}").alias("reference"), "n_values", "n_rows"))
    return reduce(DataFrame.unionByName, out)


def fk_orphans_incremental_q(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without their customer, by counts that three batches changed: all come, customers of ten nations and urgent orders go,
    and of these customers those of five nations come back."""
    orders, customer = _orders(spark, sf), d.table(spark, sf, "customer")
    gone, back = F.col("c_nationkey") < 10, F.col("c_nationkey") < 5
    counts = ReferenceCounts(spark, scratch_path(spark, "references"), max_bytes=65_536)
    counts.apply("b1", deltas(orders, "o_custkey", "child", 1).unionByName(deltas(customer, "c_custkey", "parent", 1)))
    counts.apply("b2", deltas(customer.filter(gone), "c_custkey", "parent", -1).unionByName(
        deltas(orders.filter(F.col("o_orderpriority") == "1-URGENT"), "o_custkey", "child", -1)))
    counts.apply("b3", deltas(customer.filter(back), "c_custkey", "parent", 1))
    return counts.orphans()


def pk_duplicates_q(spark: SparkSession, sf: str) -> DataFrame:
    return pk_duplicates(d.invoices_raw(d.table(spark, sf, "lineitem")), contracts.INVOICES.key)


def contract_violations_q(spark: SparkSession, sf: str) -> DataFrame:
    """All checks over clean customers, uncleaned subscriptions and uncleaned invoices."""
    tables = {
        "customers": customers_silver_q(spark, sf),
        "subscriptions": d.subscriptions_raw(_orders(spark, sf)),
        "invoices": d.invoices_raw(d.table(spark, sf, "lineitem")),
    }
    return contract_violations(
        tables, {"customers": CUSTOMERS, "subscriptions": SUBSCRIPTIONS, "invoices": INVOICES}
    )


def _streamed(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out = scratch_path(spark, name)
    write_available(stream, out, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def events_stream_q(spark: SparkSession, sf: str) -> DataFrame:
    own = stream_session(spark, spark.sparkContext.defaultParallelism)
    stream = event_stream(own, _land_events(spark, sf, "stream-landing"), EVENTS.schema).drop("arrival")
    return _streamed(spark, stream, "stream-out")


def events_stream_dedup_q(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases are delivered twice. The watermark spans the month of events: nothing is late."""
    path = _land_events(spark, sf, "dedup-landing", redeliver=True)
    own = stream_session(spark, spark.sparkContext.defaultParallelism)
    return _streamed(spark, drop_redelivered(event_stream(own, path, EVENTS.schema), "40 days"), "dedup-out")


def _named(query: Query) -> Query:
    return lambda spark, sf_dir: _portable(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    """Every function above that ends in ``_q``, by its name without the suffix."""
    return {
        name[:-2]: _named(f) for name, f in globals().items() if name.endswith("_q") and callable(f)
    }
