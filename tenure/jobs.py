"""The whole flow on files: landing, bronze, silver, dimensions, fact, gold.

Each job reads tables under a root, runs the functions of ``tenure.plans``, and writes its
own tables. Jobs take the batch id and the as-of time of their run and may be run again. No row
is lost on the way: what a job can't use is in a table of rejects beside its result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.contracts import CUSTOMERS, INVOICES, PLANS, SUBSCRIPTIONS, Contract, widened
from tenure.functions.countries import assigned_country_codes, is_country
from tenure.functions.times import as_date, parse_event_ts
from tenure.operators.checks import contract_violations
from tenure.operators.dedup import latest_by_key
from tenure.operators.ranges import overlapping_ranges
from tenure.operators.scd2 import scd2_initial
from tenure.operators.spine import version_windows
from tenure.plans import cohorts, dimensions, kpi, silver
from tenure.plans.bronze import SOURCE_LABELS, bronze, flatten_events
from tenure.plans.fact import fact_daily, one_at_a_time, price_ranges
from tenure.marts import KpiMart, Touched
from tenure.sources.dimension_store import create_dimension, merge_dimension, read_changes, read_dimension
from tenure.sources.extract import WATERMARK_COLUMN, Since, next_watermarks
from tenure.sources.files import exists
from tenure.sources.split_table import MAX_BYTES, SplitTable
from tenure.sources.tables import (
    landing_path,
    overwrite_partitions,
    read_event_files,
    read_table,
    write_landing,
    write_table,
)
from tenure.streaming.arrivals import Arrivals, StreamRun
from tenure.streaming.events import drop_redelivered, late_events, stream_session, write_available

BATCH_TABLES: dict[str, Contract] = {
    "customers": CUSTOMERS,
    "plans": PLANS,
    "subscriptions": SUBSCRIPTIONS,
    "invoices": INVOICES,
}
TABLES = list(SOURCE_LABELS)

#: What makes a row of silver: its key, and the column that tells which of its rows is newest.
SILVER_KEYS = {
    "customers": (["customer_id"], "last_updated"),
    "plans": (["plan_id", "effective_from"], "last_updated"),
    "subscriptions": (["subscription_id", "sub_start_date"], "last_updated"),
    "invoices": (["invoice_id"], "last_updated"),
    "events": (["event_id"], "event_ts"),
}
#: Bytes of files that a part of a silver table may have before it splits. A load writes the parts that its rows touch.
PART_BYTES = MAX_BYTES

#: A price list and a stretch of a subscription are rows of their own in a dimension.
DIMENSION_KEYS = {
    "customers": (dimensions.CUSTOMER_KEY, dimensions.CUSTOMER_TRACKED),
    "plans": (["plan_id", "effective_from"], dimensions.PLAN_TRACKED),
    "subscriptions": (["subscription_id", "sub_start_date"], dimensions.SUBSCRIPTION_TRACKED),
}


@dataclass(frozen=True)
class Layout:
    """Where the layers live."""

    root: str
    fmt: str = "parquet"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def land(extracts: dict[str, DataFrame], layout: Layout, batch_id: str, since: Since | dict[str, Since] = "1900-01-01") -> dict[str, Since]:
    """Write extracts (see ``tenure.sources.extract``) to landing, each in its own batch.

    Gives the next watermark of each source, read from what was landed; give it as ``since`` to the next extracts.
    """
    landed = {}
    for name, df in extracts.items():
        write_landing(df, layout.landing, name, batch_id)
        landed[name] = df.sparkSession.read.schema(df.schema).parquet(landing_path(layout.landing, name, batch_id))
    return next_watermarks(landed, since, WATERMARK_COLUMN)


def load_bronze(spark: SparkSession, layout: Layout, batch_id: str, as_of: str, tables: Iterable[str] = TABLES) -> None:
    """Stamp one landed batch. Earlier batches stay, so an incremental load loses nothing.

    Columns that the contract doesn't know are kept. Rows with values of which the contract's type can't be made keep
    nulls there, and come whole, as JSON, to ``<table>_rejects`` as well. Event lines that are no JSON go to ``events_unreadable``.
    """
    for table in tables:
        if table == "events":
            landed = read_event_files(spark, landing_path(layout.landing, table, batch_id))
            broken = landed.filter("_corrupt_record is not null").select("event_id", "_corrupt_record")
            write_landing(broken, layout.bronze, "events_unreadable", batch_id)
            rows = flatten_events(landed.filter("_corrupt_record is null").drop("_corrupt_record"))
        else:
            # Landing files carry the types of the source system; the contract decides.
            landed = read_table(spark, landing_path(layout.landing, table, batch_id), merge_schema=True)
            whole = F.to_json(F.struct(*landed.columns)) if landed.columns else F.lit(None).cast("string")
            rows = widened(landed.withColumn("__row", whole), BATCH_TABLES[table].schema)
            rejects = rows.filter(F.size("__unusable") > 0).select(F.col("__unusable").alias("columns"), F.col("__row").alias("row"))
            write_landing(rejects, layout.bronze, f"{table}_rejects", batch_id)
            rows = rows.drop("__row", "__unusable")
        write_landing(bronze(rows, table, as_of), layout.bronze, table, batch_id)


def _prepared(table: str, rows: DataFrame, codes: Iterable[str]) -> DataFrame:
    """Bronze rows as silver has them: renamed dates, parsed times, derived columns."""
    if table == "subscriptions":
        return rows.withColumnsRenamed({"start_date": "sub_start_date", "end_date": "sub_end_date"})
    if table == "events":
        return rows.withColumn("event_ts", parse_event_ts(F.col("event_ts")))
    if table == "customers":
        return rows.withColumn("is_valid_country", F.coalesce(is_country(F.col("country"), codes), F.lit(False)))
    return rows


def _judged(table: str, rows: DataFrame, codes: Iterable[str]) -> DataFrame:
    rule = {
        "customers": lambda: silver.customer_rule(codes), "subscriptions": silver.subscription_rule,
        "invoices": silver.invoice_rule, "events": silver.event_rule,
    }.get(table, lambda: F.lit(None).cast("string"))()
    return rows.withColumn("rule", rule).withColumn("is_valid", F.col("rule").isNull())


def load_silver(
    spark: SparkSession,
    layout: Layout,
    batch_id: str | None = None,
    country_codes: Iterable[str] | None = None,
    tables: Iterable[str] = TABLES,
) -> None:
    """Bring silver up to date with one bronze batch, or, without ``batch_id``, rebuild it from all.

    Silver holds the newest row of each key, valid or not, in parts that split as they grow. A batch is merged into the parts
    that its keys fall into; the other parts are neither read nor written. Running a batch again changes nothing.
    """
    codes = frozenset(country_codes or assigned_country_codes(spark))
    for table in tables:
        keys, newest = SILVER_KEYS[table]
        source = f"{layout.bronze}/{table}" if batch_id is None else landing_path(layout.bronze, table, batch_id)
        rows = _prepared(table, read_table(spark, source, merge_schema=True).drop("batch"), codes)
        stored = silver_table(spark, layout, table)
        newest_of = lambda both: _judged(table, latest_by_key(both.drop("is_valid", "rule"), keys, [newest]), codes)  # noqa: E731, B023
        if batch_id is None or not stored.exists():
            stored.create(newest_of(rows), measured=rows)
        else:
            stored.upsert(rows, newest_of)


def silver_table(spark: SparkSession, layout: Layout, table: str) -> SplitTable:
    keys, _ = SILVER_KEYS[table]
    return SplitTable(spark, layout.silver(table), keys, layout.fmt, ["is_valid"], PART_BYTES)


def current(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Valid rows of a silver table."""
    return silver_table(spark, layout, table).read().filter("cast(is_valid as boolean)").drop("is_valid", "rule")


def rejected(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Newest rows of a silver table that break a rule, with its name."""
    return silver_table(spark, layout, table).read().filter("not cast(is_valid as boolean)").drop("is_valid")


def _dimension_schema(spark: SparkSession, layout: Layout, table: str) -> T.StructType:
    return scd2_initial(current(spark, layout, table), "2000-01-01").schema


def load_dimensions(
    spark: SparkSession, layout: Layout, batch_id: str, as_of: str, previous_batch: str | None = None
) -> None:
    """Create the three dimensions, or merge into them after ``previous_batch``.

    A key whose newest row breaks a rule is closed: what was known of it holds no longer.
    """
    for table, (keys, tracked) in DIMENSION_KEYS.items():
        path = layout.silver(f"{table}_scd2")
        if previous_batch is None:
            create_dimension(current(spark, layout, table), path, batch_id, as_of, layout.fmt)
            continue
        source = current(spark, layout, table).withColumn("__withdrawn", F.lit(False)).unionByName(
            rejected(spark, layout, table).drop("rule").withColumn("__withdrawn", F.lit(True))
        )
        merge_dimension(
            spark, source, path, _dimension_schema(spark, layout, table), previous_batch, batch_id,
            keys, as_of, tracked, fmt=layout.fmt, closing="__withdrawn",
        )


def dimension(spark: SparkSession, layout: Layout, table: str, batch_id: str) -> DataFrame:
    """A dimension as it was after a batch."""
    schema = _dimension_schema(spark, layout, table)
    return read_dimension(spark, layout.silver(f"{table}_scd2"), schema, batch_id, layout.fmt)


def subscription_versions(spark: SparkSession, layout: Layout, batch_id: str, valid_from: str = "start_date", valid_to: str = "end_date") -> DataFrame:
    """Versions of which one at most holds on a day of a subscription, in load time or, of open ones, in business time."""
    versions = dimension(spark, layout, "subscriptions", batch_id)
    if valid_from != "start_date":
        versions = versions.filter("active_status = 'Y'")
    return one_at_a_time(versions, valid_from, valid_to)


def _require_one_a_day(versions: DataFrame, as_of: str | date, valid_from: str, valid_to: str) -> None:
    windows = version_windows(versions, as_of, valid_from, valid_to)
    twice = overlapping_ranges(windows, "subscription_id", "first_day", "last_day").limit(3).collect()
    if twice:
        raise ValueError(f"subscriptions with two versions on a day, such as {[r['subscription_id'] for r in twice]}")


def _months(from_dt: str | date, as_of: str | date) -> list[tuple[str]]:
    first, last = (date.fromisoformat(str(x)[:10]) for x in (from_dt, as_of))
    return [(f"{n // 12:04d}-{n % 12 + 1:02d}",) for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


def load_fact(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    as_of: str | date,
    from_dt: str | date | None = None,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
) -> None:
    """The daily fact by month. From the first of a month given as ``from_dt``, only later months are
    rewritten; those that have no rows any more are removed."""
    if from_dt is not None and str(from_dt)[8:10] != "01":
        raise ValueError("from_dt must be the first of a month, because whole months are replaced")
    subscriptions = subscription_versions(spark, layout, batch_id, valid_from, valid_to)
    _require_one_a_day(subscriptions, as_of, valid_from, valid_to)
    fact = fact_daily(
        subscriptions, price_ranges(dimension(spark, layout, "plans", batch_id)), as_of, valid_from, valid_to,
        from_dt=from_dt, by_month=True,
    )
    path = layout.silver("fact_subscription_daily")
    if from_dt is None:
        write_table(fact, path, layout.fmt, partition_by=["dt_month"], placed=True)
    else:
        overwrite_partitions(fact, path, ["dt_month"], layout.fmt, every=_months(from_dt, as_of), placed=True)
    windows = windows_without_days(subscriptions, valid_from, valid_to)
    write_table(windows, layout.silver("fact_rejects"), layout.fmt)


def windows_without_days(subscriptions: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """Versions that cover no day: they end on or before the day they begin, or have no beginning."""
    start, end = F.col(valid_from).cast("date"), F.col(valid_to).cast("date")
    return subscriptions.filter(start.isNull() | F.coalesce(end <= start, F.lit(False)))


def _events(spark: SparkSession, layout: Layout) -> DataFrame:
    """Dated events of known customers, from batches and from the stream."""
    columns = ["customer_id", "event_ts"]
    sources = [current(spark, layout, "events").select(*columns)] if exists(spark, layout.silver("events")) else []
    if exists(spark, layout.silver("event_stream")):
        sources.append(read_table(spark, layout.silver("event_stream")).select(*columns))
    if not sources:
        return spark.createDataFrame([], "customer_id string, event_ts timestamp")
    every = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    return every.filter(F.col("customer_id").isNotNull())


def load_gold(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    as_of: str | date,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
) -> None:
    """The KPI and retention marts. Both are small, and come from versions rather than from days."""
    subscriptions = subscription_versions(spark, layout, batch_id, valid_from, valid_to)
    _require_one_a_day(subscriptions, as_of, valid_from, valid_to)
    daily = kpi.kpi_daily_changepoints(
        subscriptions, price_ranges(dimension(spark, layout, "plans", batch_id)), as_of, valid_from, valid_to,
    )
    write_table(daily.repartition(1), layout.gold("gold_kpi_daily"), layout.fmt)
    customers = dimension(spark, layout, "customers", batch_id)
    retained = cohorts.retention_cohorts(customers, subscriptions, as_of, valid_from, valid_to)
    engaged = cohorts.retention_engagement(customers, _events(spark, layout).filter(F.col("event_ts").cast("date") <= as_date(as_of)), as_of)
    write_table(
        retained.unionByName(engaged).repartition(1), layout.gold("gold_retention_cohorts"), layout.fmt
    )


def load_kpi_changes(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    previous_batch: str | None = None,
    valid_from: str = "start_date",
    valid_to: str = "end_date",
    max_bytes: int = MAX_BYTES,
) -> Touched:
    """The KPI mart by what a batch changed; see ``KpiMart``. Call it after ``load_dimensions`` of each batch."""
    path = layout.silver("subscriptions_scd2")
    changed = read_changes(spark, path, _dimension_schema(spark, layout, "subscriptions"), batch_id, layout.fmt)
    return _kpi_mart(spark, layout, valid_from, valid_to, max_bytes).update(
        batch_id, changed, price_ranges(dimension(spark, layout, "plans", batch_id)), previous_batch,
    )


def _kpi_mart(spark: SparkSession, layout: Layout, valid_from: str, valid_to: str, max_bytes: int = MAX_BYTES) -> KpiMart:
    return KpiMart(spark, layout.gold(f"kpi_changes_{valid_from}"), valid_from, valid_to, max_bytes)


def read_kpi_changes(
    spark: SparkSession, layout: Layout, batch_id: str, as_of: str | date, valid_from: str = "start_date", valid_to: str = "end_date",
) -> DataFrame:
    """The KPIs of every day up to ``as_of``, as of a batch."""
    return _kpi_mart(spark, layout, valid_from, valid_to).read(batch_id, as_of)


def load_event_stream(
    spark: SparkSession,
    layout: Layout,
    delay: str = "1 day",
    state_partitions: int | None = None,
) -> StreamRun:
    """Event files that arrived in ``landing/event_stream`` since the last run, without repeated
    deliveries, appended to silver. The checkpoint lives beside the table.

    New files are read once, others not at all. Lines that are no JSON and events without a readable time are appended to
    ``event_stream_unreadable``, deliveries later than the watermark to ``event_stream_late``.
    """
    own = stream_session(spark, state_partitions)
    out = layout.silver("event_stream")
    arrivals = Arrivals(
        own, f"{layout.landing}/event_stream", layout.silver("event_stream_arrivals"),
        layout.silver("event_stream_late"), layout.silver("event_stream_unreadable"), delay,
    )
    arrivals.run()
    query = write_available(drop_redelivered(arrivals.admitted(), delay), out, f"{out}_checkpoint")
    arrivals.forget()
    return StreamRun(query, arrivals.n_late())


def events_come_too_late(spark: SparkSession, layout: Layout) -> DataFrame:
    """Late events of the stream of which no other delivery came in time; copies of kept events are not among them."""
    late = read_table(spark, layout.silver("event_stream_late"))
    return late_events(late.drop("batch"), read_table(spark, layout.silver("event_stream"))).dropDuplicates(["event_id"])


def violations(spark: SparkSession, layout: Layout) -> DataFrame:
    """Contract checks over the silver tables."""
    renamed = {"start_date": "sub_start_date", "end_date": "sub_end_date"}
    as_stored = T.StructType([T.StructField(renamed.get(f.name, f.name), f.dataType, f.nullable) for f in SUBSCRIPTIONS.schema])
    contracts = {
        **BATCH_TABLES,
        # Silver keeps one row per plan and effective date, and per subscription and start.
        "plans": replace(PLANS, key=("plan_id", "effective_from")),
        "subscriptions": replace(SUBSCRIPTIONS, schema=as_stored, key=("subscription_id", "sub_start_date")),
    }
    tables = {name: current(spark, layout, name) for name in contracts}
    return contract_violations(tables, contracts)


def read_kpis(spark: SparkSession, layout: Layout) -> DataFrame:
    """The KPI mart in order of days."""
    return read_table(spark, layout.gold("gold_kpi_daily"), layout.fmt).orderBy("dt")


def read_retention(spark: SparkSession, layout: Layout) -> DataFrame:
    """The retention mart in order of cohorts and periods."""
    cells = read_table(spark, layout.gold("gold_retention_cohorts"), layout.fmt)
    return cells.orderBy("cohort_type", "cohort_month", "period_number")
