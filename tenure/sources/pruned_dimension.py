"""A versioned dimension of which a merge reads and rewrites only files that may hold its keys.

Open versions lie in files ordered by the hash of their key. Each file has a Bloom filter in words of 64 bits: the first bits of a key's hash
name its word, four bits of a second hash are set in it. Filters are rows (depth, word, file, mask) without empty words, so a
batch's keys find the files that may hold them by an equality join, whose pairs are keys times the files that share a stretch of hashes, and
a file's bounds need no test of their own. A key never misses its file; one in some hundred reads a file in vain. A batch of
new keys alone rewrites nothing old.

Each batch lists the files of open versions that are live after it. It writes its own folder only, so running a batch again replaces
that batch, and earlier states can still be read. A batch counts from when its list stands; batches follow one another in one line. Small files are folded into the next batch when they become many. Batch ids sort as text.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.operators.scd2 import scd2_initial, scd2_step
from tenure.sources.files import delete, exists, folders

#: Keys to a word of 64 bits on average: four bits each leave about three quarters of the word empty.
KEYS_PER_WORD = 4
BITS_PER_KEY = 4
MAX_DEPTH = 40
#: Files that a batch writes, at most: beyond that they hold more rows, so that their number does not grow with the table.
MAX_FILES = 512
LIVE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("columns", T.StringType()),
])


@dataclass(frozen=True)
class Merged:
    """What a merge read: files of open versions, out of those that were live."""

    files_read: int
    files_live: int


def word_of(keys: Sequence[str], depth: int) -> Column:
    """The first ``depth`` bits of the key's hash, as a number."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - depth) if depth else F.lit(0).cast("long")


def mask_of(keys: Sequence[str]) -> Column:
    """The bits that a key sets in its word."""
    other = F.xxhash64(F.lit(7), *keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(other, 6 * i).bitwiseAND(63).cast("int")) for i in range(BITS_PER_KEY)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return mask


class PrunedDimension:
    """``keys`` and ``tracked`` as in ``scd2_step``. A file of open versions holds about ``rows_per_file``, or more in a batch of over
    ``MAX_FILES`` times that; those of less than a quarter are folded when there are more than ``max_small``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], tracked: Sequence[str], rows_per_file: int = 1_000_000, max_small: int = 64):
        self.spark, self.path, self.keys, self.tracked = spark, path.rstrip("/"), list(keys), list(tracked)
        self.rows_per_file, self.max_small = rows_per_file, max_small

    # --- places ---------------------------------------------------------------------------

    def _open(self, batch_id: str) -> str:
        return f"{self.path}/open/{batch_id}"

    def _closed(self, batch_id: str) -> str:
        return f"{self.path}/closed/{batch_id}"

    def _filters(self, batch_id: str) -> str:
        return f"{self.path}/filters/{batch_id}"

    def _live(self, batch_id: str) -> list:
        """The directory of a batch: a row per file."""
        path = f"{self.path}/live/{batch_id}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            raise FileNotFoundError(f"no batch {batch_id!r} at {self.path}")
        return self.spark.read.schema(LIVE).parquet(path).collect()

    # --- reading --------------------------------------------------------------------------

    def _schema(self, live: list) -> T.StructType:
        return T.StructType.fromJson(json.loads(next(r["columns"] for r in live if r["columns"])))

    def _versions(self, files: Sequence[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/open/{f}" for f in files))

    def read(self, batch_id: str) -> DataFrame:
        """The dimension after a batch: its open versions, and all versions closed so far."""
        live = self._live(batch_id)
        schema = self._schema(live)
        done = [b for b in folders(self.spark, f"{self.path}/closed") if b <= batch_id and exists(self.spark, f"{self.path}/live/{b}/_SUCCESS")]
        closed = [self._closed(b) for b in done]
        rows = self._versions([r["file"] for r in live if r["file"]], schema)
        return rows.unionByName(self.spark.read.schema(schema).parquet(*closed)) if closed else rows

    def files_of(self, keys: DataFrame, batch_id: str) -> list[str]:
        """Live files that may hold some of the keys; all others hold none of them."""
        live = [r for r in self._live(batch_id) if r["file"]]
        return self._files_of(keys, live)

    def _files_of(self, keys: DataFrame, live: list) -> list[str]:
        if not live:
            return []
        depths = {r["depth"] for r in live}
        writers = sorted({r["file"].split("/")[0] for r in live})
        wanted = keys.select(*self.keys).distinct().select(
            mask_of(self.keys).alias("key_mask"),
            F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), word_of(self.keys, d).alias("word")) for d in sorted(depths)))).alias("place"),
        ).select("key_mask", "place.depth", "place.word")
        filters = self.spark.read.parquet(*(self._filters(b) for b in writers))
        hits = filters.join(wanted, ["depth", "word"]).filter(F.col("mask").bitwiseAND(F.col("key_mask")) == F.col("key_mask"))
        found = {r["file"] for r in hits.select("file").distinct().collect()}  # no more than there are files
        return sorted(r["file"] for r in live if r["file"] in found)

    # --- writing --------------------------------------------------------------------------

    def _publish(self, batch_id: str, step: DataFrame, carried: list, schema: T.StructType) -> None:
        """Write the rows of a step, open and closed ones, and the directory of the batch."""
        staged = f"{self.path}/staged/{batch_id}"
        step.write.mode("overwrite").partitionBy("active_status").parquet(staged)
        both = self.spark.read.schema(T.StructType([*(f for f in schema if f.name != "active_status"), schema["active_status"]])).parquet(staged)
        both = both.select([f.name for f in schema])
        both.filter("active_status = 'N'").write.mode("overwrite").parquet(self._closed(batch_id))
        rows = both.filter("active_status = 'Y'")
        n = rows.count()
        depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, n) / KEYS_PER_WORD))))
        place = F.xxhash64(*self.keys).bitwiseXOR(F.lit(-(2**63)))  # in the order of the words
        ordered = rows.withColumn("__place", place).repartitionByRange(min(MAX_FILES, max(1, math.ceil(n / self.rows_per_file))), "__place")
        ordered.sortWithinPartitions("__place").drop("__place").write.mode("overwrite").parquet(self._open(batch_id))

        file = F.concat(F.lit(f"{batch_id}/"), F.col("_metadata.file_name"))
        stored = self.spark.read.schema(schema).parquet(self._open(batch_id)).select("*", file.alias("__file"))
        words = stored.groupBy(F.lit(depth).alias("depth"), word_of(self.keys, depth).alias("word"), F.col("__file").alias("file")).agg(
            F.bit_or(mask_of(self.keys)).alias("mask"), F.count(F.lit(1)).alias("n"))
        words.sortWithinPartitions("word").write.mode("overwrite").parquet(self._filters(batch_id))
        sizes = self.spark.read.parquet(self._filters(batch_id)).groupBy("file").agg(F.sum("n").alias("n")).collect()
        listed = [*((r["file"], r["n_rows"], r["depth"], None) for r in carried), *((r["file"], r["n"], depth, None) for r in sizes)]
        listed.append((None, 0, None, schema.json()))
        self.spark.createDataFrame(listed, LIVE).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/live/{batch_id}")
        delete(self.spark, staged)

    def create(self, df: DataFrame, batch_id: str, as_of: str | datetime) -> None:
        """First load: one row per key."""
        first = scd2_initial(df, as_of)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in first.schema])
        self._publish(batch_id, first, [], schema)

    def merge(self, changes: DataFrame, previous_batch: str, batch_id: str, as_of: str | datetime, closing: str | None = None) -> Merged:
        """Merge rows that may have changed; keys that are not among them stay as they are. ``closing`` as in ``scd2_step``."""
        if batch_id <= previous_batch:
            raise ValueError(f"batch {batch_id!r} must sort after {previous_batch!r}")
        listed = self._live(previous_batch)
        schema, live = self._schema(listed), [r for r in listed if r["file"]]
        # Kept, since they are read twice: for the files that may hold their keys, and for the merge.
        kept = f"{self.path}/staged/{batch_id}-changes"
        changes.write.mode("overwrite").parquet(kept)
        changes = self.spark.read.schema(changes.schema).parquet(kept)
        read = set(self._files_of(changes, live))
        small = {r["file"] for r in live if 4 * r["n_rows"] < self.rows_per_file}
        if len(small - read) > self.max_small:
            read |= small
        target = self._versions(sorted(read), schema)
        step = scd2_step(target, changes, self.keys, as_of, self.tracked, closing=closing)
        self._publish(batch_id, step, [r for r in live if r["file"] not in read], schema)
        delete(self.spark, kept)
        return Merged(len(read), len(live))
