"""Engagement retention as the events arrive.

Each micro-batch is reduced to bitmaps of the customers that it shows engaged, per cohort and period, and merged into those of
the batches before it. A state belongs to its batch id and is made from that of the id before, so a batch that is replayed after a failure
writes the same state again. Bits are set once however often and however late an event comes, so nothing is dropped as late.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenure.operators.bitmaps import bit_counts, bitmaps, merged_bitmaps
from tenure.plans import cohorts
from tenure.sources.files import delete, exists, folders

BY = ["cohort_month", "period_number", "period_date"]


class EngagementStream:
    """State under a path; ``members`` are the customers (customer_id, cohort_month, number), numbered without gaps."""

    def __init__(self, spark: SparkSession, path: str, members: DataFrame):
        self.spark, self.path, self.members = spark, path.rstrip("/"), members

    def _state(self, batch: int) -> str:
        return f"{self.path}/state/batch={batch}"

    def hits(self, events: DataFrame) -> DataFrame:
        """The members that dated events show engaged: cohort_month, period_number, period_date, number."""
        due = cohorts.period_dates(self.members.select("cohort_month").distinct())  # five rows per calendar month or week
        day = events.filter(F.col("event_ts").isNotNull()).select("customer_id", F.col("event_ts").cast("date").alias("event_day"))
        near = F.datediff("event_day", "period_date").between(0, cohorts.ENGAGEMENT_DAYS - 1)
        return day.join(self.members, "customer_id").join(F.broadcast(due), "cohort_month").filter(near).select(*BY, "number")

    def _merge(self, batch_hits: DataFrame, batch_id: int) -> None:
        fresh = bitmaps(batch_hits, BY, "number")
        if batch_id and exists(self.spark, f"{self._state(batch_id - 1)}/_SUCCESS"):
            before = batch_hits.sparkSession.read.parquet(self._state(batch_id - 1))
            fresh = merged_bitmaps([before, fresh], BY)
        fresh.write.mode("overwrite").parquet(self._state(batch_id))
        if batch_id > 1:
            delete(self.spark, self._state(batch_id - 2))  # only the last batch can be replayed

    def run(self, events: DataFrame) -> StreamingQuery:
        """Take in all events of the stream that have arrived, then stop. A restart goes on where the last run ended."""
        query = (
            self.hits(events).writeStream.foreachBatch(self._merge)
            .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    def read(self, as_of: str | date) -> DataFrame:
        """The cells of all cohorts and reached periods, from the last state."""
        sizes = self.members.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))  # a row per customer
        batches = [int(f.split("=")[1]) for f in folders(self.spark, f"{self.path}/state") if exists(self.spark, f"{self.path}/state/{f}/_SUCCESS")]
        if not batches:
            none = self.spark.createDataFrame([], "cohort_month date, period_number int, retained_users long")
            return cohorts.retention_cells(sizes, none, as_of, "engagement")
        state = self.spark.read.parquet(self._state(max(batches)))
        retained = bit_counts(state, ["cohort_month", "period_number"]).withColumnRenamed("n", "retained_users")
        return cohorts.retention_cells(sizes, retained, as_of, "engagement")
