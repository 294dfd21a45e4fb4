"""Event files as a stream: flatten, parse, and drop repeated deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tenure.contracts import EVENTS
from tenure.functions.times import parse_event_ts
from tenure.plans.bronze import flatten_events
from tenure.streaming.arrivals import StreamRun

#: Spreads the copies of one event over this many first-level states.
DEDUP_SALTS = 16


def event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENTS.schema,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Flattened events with a parsed ``event_ts`` from a folder that receives JSON files.

    ``arrival`` tells which piece of which file a row came from.
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    reader = spark.readStream.schema(nullable)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrival = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    raw = reader.json(path).select("*", arrival.alias("arrival"))
    return flatten_events(raw).withColumn("event_ts", parse_event_ts(F.col("event_ts")))


def drop_redelivered(events: DataFrame, delay: str, salts: int = DEDUP_SALTS) -> DataFrame:
    """One row per ``event_id`` among deliveries within ``delay`` of each other.

    State is bounded by the watermark; rows later than it are dropped and counted in the
    query progress (see ``late_rows``). Two levels: first within (event_id, salt), then per
    event_id. The salt comes from where a copy arrived, so an event delivered very many
    times spreads over tasks and the second level sees at most ``salts`` rows of it.

    Rows without a readable timestamp have no place in a watermark; take them from the
    stream with ``undated`` instead.
    """
    return (
        events.filter(F.col("event_ts").isNotNull())
        .withWatermark("event_ts", delay)
        .withColumn("salt", F.pmod("arrival", F.lit(salts)))
        .dropDuplicatesWithinWatermark(["event_id", "salt"])
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("salt", "arrival")
    )


def undated(events: DataFrame) -> DataFrame:
    """The rows ``drop_redelivered`` leaves out."""
    return events.filter(F.col("event_ts").isNull()).drop("arrival")


def late_events(delivered: DataFrame, kept: DataFrame) -> DataFrame:
    """Dated events that were delivered and are not among those kept: they came later than the watermark.

    Of late deliveries (see ``tenure.streaming.arrivals``) these are the events of which no other delivery came in time.
    """
    dated = delivered.filter(F.col("event_ts").isNotNull())
    return dated.join(kept.select("event_id").distinct(), "event_id", "left_anti")


#: Progress reports a run keeps, so that ``late_rows`` adds up all of them.
PROGRESS_KEPT = 100_000


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for a stream: its settings change nothing for queries of other sessions.

    ``state_partitions`` sets how many partitions state is kept in. A checkpoint keeps the
    number it began with, so choose it for the expected volume.
    """
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_KEPT))
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def write_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived into Parquet, then stop. Restarts go on from ``checkpoint``."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def late_rows(run: StreamingQuery | StreamRun) -> int:
    """Rows that were later than the watermark: dropped by the query, or told apart before it."""
    query, before = (run.query, run.n_late) if isinstance(run, StreamRun) else (run, 0)
    reports = query.recentProgress
    if len(reports) >= PROGRESS_KEPT:
        raise RuntimeError("the run made more reports than are kept")
    return before + sum(state.get("numRowsDroppedByWatermark", 0) for r in reports for state in r["stateOperators"])
