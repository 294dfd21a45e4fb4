"""One pass over arriving event files that tells admitted, late and unreadable rows apart.

Each micro-batch reads its new files once and writes its rows by kind. A row is late if its time is not after the watermark, which is the
greatest time of all batches before less the delay. The watermark belongs to its batch id and everything a batch writes
is overwritten when it is replayed, so a run that breaks off leaves no row out and none twice. No file of an earlier batch and no stored event is read again.

The stream that drops repeated deliveries reads the admitted rows. It sees batches in their order and no finer, so its own
watermark is never ahead of the one here and it drops nothing as late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tenure.contracts import EVENTS
from tenure.functions.times import parse_event_ts
from tenure.plans.bronze import flatten_events
from tenure.sources.files import delete, exists, folders

ADMITTED, LATE, UNREADABLE = "admitted", "late", "unreadable"


@dataclass(frozen=True)
class StreamRun:
    """A finished run of a stream with the number of rows that came too late for it."""

    query: StreamingQuery
    n_late: int


def told_apart(lines: DataFrame, watermark: DataFrame | None = None, schema: T.StructType = EVENTS.schema) -> DataFrame:
    """Flattened events of JSON lines (column ``value``) with their ``kind``.

    A line may hold an array of events, each a row of its own. Blank lines are nothing. Lines that are no JSON and events without a
    readable time have the ``reason`` and keep their line. ``watermark`` is a row with the column ``mark``; without one, or with a null, nothing is late.
    """
    event = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    rows = lines.select("value").filter(F.trim("value") != "")
    # An object where an array is asked for is an array of one.
    parsed = rows.select("value", F.explode_outer(F.from_json("value", T.ArrayType(event))).alias("event"))
    flat = flatten_events(parsed.select("value", "event.*")).withColumn("event_ts", parse_event_ts(F.col("event_ts")))
    is_json = F.coalesce(F.try_parse_json("value").isNotNull(), F.lit(False))
    reason = F.when(~is_json, "not_json").when(F.col("event_ts").isNull(), "timestamp")
    judged = flat.withColumn("reason", reason)
    judged = judged.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    late = F.lit(False)
    if watermark is not None:
        judged = judged.crossJoin(F.broadcast(watermark.select(F.col("mark").alias("__mark"))))  # one row
        late = F.coalesce(F.col("event_ts") <= F.col("__mark"), F.lit(False))
    kind = F.when(F.col("reason").isNotNull(), UNREADABLE).when(late, LATE).otherwise(ADMITTED)
    return judged.withColumn("kind", kind).drop("__mark")


class Arrivals:
    """``landing`` receives files of JSON lines. State lies under ``path``; ``late`` and ``unreadable`` are the tables of what isn't admitted."""

    def __init__(self, spark: SparkSession, landing: str, path: str, late: str, unreadable: str, delay: str, schema: T.StructType = EVENTS.schema):
        self.spark, self.landing, self.path, self.delay, self.schema = spark, landing, path.rstrip("/"), delay, schema
        self.tables = {LATE: late.rstrip("/"), UNREADABLE: unreadable.rstrip("/")}
        self._ran: list[int] = []

    def _rows(self, batch_id: int) -> str:
        return f"{self.path}/rows/{batch_id:010d}"

    def _mark(self, batch_id: int) -> str:
        return f"{self.path}/marks/{batch_id:010d}"

    def _marked(self) -> list[int]:
        return [int(n) for n in folders(self.spark, f"{self.path}/marks") if exists(self.spark, f"{self.path}/marks/{n}/_SUCCESS")]

    def _take(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        before = max((n for n in self._marked() if n < batch_id), default=None)
        known = None if before is None else spark.read.parquet(self._mark(before))
        watermark = None if known is None else known.select((F.col("latest") - F.expr(f"interval {self.delay}")).alias("mark"))
        apart = told_apart(lines, watermark, self.schema)
        apart.write.mode("overwrite").partitionBy("kind").parquet(self._rows(batch_id))

        written = T.StructType([*(f for f in apart.schema if f.name != "kind"), T.StructField("kind", T.StringType())])
        rows = spark.read.schema(written).parquet(self._rows(batch_id))
        columns = {LATE: [c for c in apart.columns if c not in ("kind", "reason", "value")], UNREADABLE: ["event_id", "reason", "value"]}
        for kind, table in self.tables.items():
            if exists(spark, f"{self._rows(batch_id)}/kind={kind}") or not exists(spark, table):
                rows.filter(F.col("kind") == kind).select(*columns[kind]).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")
        latest = rows.agg(F.max("event_ts").alias("latest"))
        if known is not None:
            latest = latest.unionByName(known).agg(F.max("latest").alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(self._mark(batch_id))
        for old in (n for n in self._marked() if n < batch_id - 1):
            delete(spark, self._mark(old))  # only the last batch can be replayed
        self._ran.append(batch_id)

    def run(self, max_files_per_trigger: int | None = None) -> StreamingQuery:
        """Tell apart what has arrived, then stop. A restart goes on where the last run ended."""
        self._ran.clear()
        reader = self.spark.readStream
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        query = (
            reader.text(self.landing).writeStream.foreachBatch(self._take)
            .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    def n_late(self) -> int:
        """Late rows of the last run."""
        found = [f"{self.tables[LATE]}/batch={n}" for n in self._ran if exists(self.spark, f"{self.tables[LATE]}/batch={n}")]
        return self.spark.read.parquet(*found).count() if found else 0

    def admitted(self) -> DataFrame:
        """The admitted rows as a stream, with where they arrived."""
        flat = flatten_events(self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in self.schema])))
        stored = flat.withColumn("event_ts", F.col("event_ts").cast("timestamp")).schema
        arrival = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
        reader = self.spark.readStream.schema(stored).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.path}/rows/*/kind={ADMITTED}").select("*", arrival.alias("arrival"))

    def forget(self) -> None:
        """Delete rows that the stream of admitted ones has taken in. Call it when that stream has stopped without an error."""
        for name in folders(self.spark, f"{self.path}/rows"):
            delete(self.spark, f"{self.path}/rows/{name}")
