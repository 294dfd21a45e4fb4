"""Marts kept up to date by what a load changed, in place of rebuilding them from the whole dimension.

KPIs: a load's closed and opened versions name the subscriptions it touched. What these contributed to each day before is
subtracted from the stored changes, what they contribute now is added (see ``kpi_changes``, a sum over subscriptions). Their earlier
versions lie in a table hashed by subscription, of which only the parts of touched subscriptions are read.

Retention: customers have dense numbers, and each cohort and period has a bitmap of those retained, merged across loads. A
daily row is read by the load that brings it only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.functions.rules import ACTIVE
from tenure.operators.bitmaps import bit_counts, bitmaps, merged_bitmaps, numbered
from tenure.operators.dedup import latest_by
from tenure.plans import cohorts, kpi
from tenure.plans.fact import one_at_a_time
from tenure.sources.files import delete, exists
from tenure.sources.split_table import MAX_BYTES, SplitTable

#: What makes a row of the stored versions: a version of a stretch of a subscription.
VERSION_KEY = ["subscription_id", "sub_start_date", "start_date"]
PRICE = ["plan_id", "effective_from", "effective_to", "monthly_price"]


@dataclass(frozen=True)
class Touched:
    """What an update of the KPIs read: subscriptions, stored versions, parts of all parts."""

    subscriptions: int
    versions_read: int
    parts_read: int
    parts: int


class KpiMart:
    """Daily KPIs under a path, in load time (``start_date``) or in business time (``sub_start_date``)."""

    def __init__(self, spark: SparkSession, path: str, valid_from: str = "start_date", valid_to: str = "end_date", max_bytes: int = MAX_BYTES):
        self.spark, self.path = spark, path.rstrip("/")
        self.valid_from, self.valid_to = valid_from, valid_to
        self.versions = SplitTable(spark, f"{self.path}/versions", ["subscription_id"], max_bytes=max_bytes)

    def _at(self, name: str, batch: str) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def _done(self, name: str, batch: str) -> bool:
        return exists(self.spark, f"{self._at(name, batch)}/_SUCCESS")

    def _contributions(self, versions: DataFrame, prices: DataFrame) -> DataFrame:
        used = versions if self.valid_from == "start_date" else versions.filter("active_status = 'Y'")
        plans = prices.select("*", F.lit("").alias("plan_name"), F.lit("").alias("tier"))
        return kpi.kpi_changes(one_at_a_time(used, self.valid_from, self.valid_to), plans, valid_from=self.valid_from, valid_to=self.valid_to)

    def _keep(self, df: DataFrame, name: str, batch: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(name, batch))
        return self.spark.read.schema(df.schema).parquet(self._at(name, batch))

    def update(self, batch: str, changed: DataFrame, prices: DataFrame, previous: str | None = None) -> Touched:
        """Bring the mart from ``previous`` to ``batch``.

        ``changed`` are the versions that the batch opened or closed, as they are after it; ``prices`` the price ranges in force after it
        (see ``price_ranges``). Where a plan's ranges changed, all subscriptions that ever had it are touched, which
        reads one column of the stored versions. Running a batch again, also one that stopped in the middle, changes nothing.
        """
        if self._done("applied", batch):
            return Touched(0, 0, 0, len(self.versions.parts()))
        prices = self._keep(prices.select(PRICE), "prices", batch)
        changed = self._keep(changed.withColumn("changed_in", F.lit(batch)), "changed", batch)
        newest = lambda both: latest_by(both, VERSION_KEY, ["changed_in"])
        if previous is None:
            if not self._done("changes", batch):
                self._keep(self._contributions(changed, prices), "changes", batch)
            self.versions.create(newest(changed))
            touched = Touched(changed.select("subscription_id").distinct().count(), 0, 0, len(self.versions.parts()))
        else:
            touched = self._apply(batch, changed, prices, previous, newest)
        self._keep(self.spark.createDataFrame([(batch,)], "batch_id string"), "applied", batch)
        return touched

    def _apply(self, batch: str, changed: DataFrame, prices: DataFrame, previous: str, newest) -> Touched:
        before = self.spark.read.parquet(self._at("prices", previous))
        repriced = before.exceptAll(prices).unionByName(prices.exceptAll(before)).select("plan_id").distinct()
        keys = changed.select("subscription_id")
        if not repriced.isEmpty():
            keys = keys.unionByName(self.versions.read().join(repriced, "plan_id", "left_semi").select("subscription_id"))
        keys = self._keep(keys.distinct(), "touched", batch)
        parts = self.versions.touched(keys)
        n_keys, n_parts = keys.count(), len(self.versions.parts())
        if not self._done("changes", batch):
            # Of a batch that stopped before its end, the stored versions are still those of the one before.
            stored = self.versions.read(parts).join(keys, "subscription_id", "left_semi")
            n_read = stored.count()
            now = newest(stored.unionByName(changed, allowMissingColumns=True))
            names = [*kpi.LEVELS, *kpi.ONCE]
            gone = self._contributions(stored, before).select("dt", *((-F.col(c)).alias(c) for c in names))
            sums = self.spark.read.parquet(self._at("changes", previous)).unionByName(gone).unionByName(self._contributions(now, prices))
            self._keep(sums.groupBy("dt").agg(*(F.sum(c).alias(c) for c in names)).repartition(1), "changes", batch)
        else:
            n_read = 0
        self.versions.upsert(changed, newest)
        return Touched(n_keys, n_read, len(parts), n_parts)

    def read(self, batch: str, as_of: str | date) -> DataFrame:
        """The KPIs of every day up to ``as_of``."""
        return kpi.kpi_from_changes(self.spark.read.parquet(self._at("changes", batch)), as_of)

    def forget(self, batch: str) -> None:
        """Delete what only earlier batches need."""
        for name in ("prices", "changed", "touched", "changes"):
            delete(self.spark, self._at(name, batch))


class RetentionMart:
    """Subscription retention under a path, from daily rows that arrive load by load.

    A day's rows come whole: ``update`` replaces the bitmaps of the days it is given, so a day that is stated anew counts as it then is.
    Customers and their cohorts are added to; a customer that is known keeps its number and cohort.
    """

    def __init__(self, spark: SparkSession, path: str, grain: str = "month"):
        self.spark, self.path, self.grain = spark, path.rstrip("/"), grain

    def _at(self, name: str, batch: str) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def _keep(self, df: DataFrame, name: str, batch: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(name, batch))
        return self.spark.read.schema(df.schema).parquet(self._at(name, batch))

    def update(self, batch: str, customers: DataFrame, fact: DataFrame, days: DataFrame, previous: str | None = None) -> None:
        """Add a load: all customers known by now, its daily rows, and the days (``dt``) that these stand for."""
        read = lambda name: self.spark.read.parquet(self._at(name, previous)) if previous is not None else None
        own = cohorts.customer_cohorts(customers, self.grain).groupBy("customer_id").agg(F.min("cohort_month").alias("cohort_month"))
        numbers = numbered(own.select("customer_id"), "customer_id", read("numbers"), self._at("fresh", batch))
        numbers = self._keep(numbers, "numbers", batch)
        members = own.join(numbers, "customer_id").select("customer_id", "cohort_month", "number")
        known = read("members")
        if known is not None:
            members = known.unionByName(members.join(known, "customer_id", "left_anti"))
        members = self._keep(members, "members", batch)
        self._keep(bitmaps(members, ["cohort_month"], "number"), "sizes", batch)

        # Only days that are some cohort's period date are looked at: a few per calendar month.
        due = cohorts.period_dates(members.select("cohort_month").distinct())
        dates = due.select(F.col("period_date").alias("dt")).distinct()
        seen = fact.filter(F.col("status_at_day") == ACTIVE).join(F.broadcast(dates), "dt", "left_semi").select("customer_id", "dt").distinct()
        hits = seen.join(members, "customer_id").join(
            F.broadcast(due.withColumnRenamed("period_date", "dt")), ["cohort_month", "dt"]
        )
        fresh = bitmaps(hits, ["cohort_month", "period_number", "dt"], "number")
        old = read("retained")
        if old is not None:
            fresh = merged_bitmaps([old.join(F.broadcast(days.select("dt").distinct().join(dates, "dt", "left_semi")), "dt", "left_anti"), fresh], ["cohort_month", "period_number", "dt"])
        self._keep(fresh, "retained", batch)

    def sizes(self, batch: str) -> DataFrame:
        """Distinct customers per cohort."""
        return bit_counts(self.spark.read.parquet(self._at("sizes", batch)), ["cohort_month"]).withColumnRenamed("n", "cohort_size")

    def read(self, batch: str, as_of: str | date) -> DataFrame:
        """The cells of all cohorts and reached periods."""
        retained = bit_counts(self.spark.read.parquet(self._at("retained", batch)), ["cohort_month", "period_number"]).withColumnRenamed("n", "retained_users")
        return cohorts.retention_cells(self.sizes(batch), retained, as_of, "subscription")
