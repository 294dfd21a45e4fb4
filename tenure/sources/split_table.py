"""A keyed table in parts that split (extendible hashing), on plain files.

A directory lists the parts: each holds the rows whose key hash begins with its bits, and no prefix begins another one, so
every key has one part. A batch rewrites the parts that its keys fall into, and a part that
grows over a size is split by its next bits. So what a batch of k keys rewrites is bounded by k parts of that size, however large
the table is, up to MAX_PARTS parts; beyond that, parts grow, so that directories and folders don't.

Parts are written to a new generation of folders and then listed by a new directory; until that stands, readers see the last one. What
a directory no longer lists is deleted when the next one is made, so a reader has until then. One writer at a time.

Every part has a digest of its rows, which is the same in whatever order they are. ``differing`` compares them with the digests of a
wanted state, so that parts without a change are told from others by the directory alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.operators.ranges import is_flat, measured_bytes
from tenure.sources.files import delete, exists, folders, size

#: Bytes of files that a part may have.
MAX_BYTES = 256 * 1024 * 1024
#: Parts that a table may have: a table of more than MAX_PARTS times a part's size has larger parts.
MAX_PARTS = 1024
#: The root's name; bits of the hash follow it. A letter keeps the names text.
ROOT = "p"

DIRECTORY = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("folder", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("retired", T.ArrayType(T.StringType())), T.StructField("columns", T.StringType()),
])


@dataclass(frozen=True)
class Part:
    """An entry of the directory; a part without rows has no folder."""

    part: str
    folder: str | None
    n_rows: int
    digest: str


def key_bits(keys: Sequence[str]) -> Column:
    """The 64 bits of a key's hash, as text after the root's name."""
    return F.concat(F.lit(ROOT), F.lpad(F.bin(F.xxhash64(*keys)), 64, "0"))


def rows_digest(columns: Sequence[str]) -> Column:
    """An aggregate over rows that does not depend on their order: count and sums of two hashes."""
    sums = (F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)


def _hashable(rows: DataFrame) -> list[str]:
    return sorted(f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.VariantType)))


class SplitTable:
    """Rows hashed by ``keys``; several rows may share a key. ``partition_by`` splits the files of each part."""

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet",
        partition_by: Sequence[str] = (), max_bytes: int = MAX_BYTES, digest_columns: Sequence[str] = (),
    ):
        self.spark, self.path, self.keys, self.fmt = spark, path.rstrip("/"), list(keys), fmt
        self.partition_by, self.max_bytes, self.digest_columns = list(partition_by), max_bytes, list(digest_columns)

    # --- the directory ------------------------------------------------------------------

    def _directories(self) -> list[int]:
        root = f"{self.path}/_directory"
        return sorted(int(n) for n in folders(self.spark, root) if exists(self.spark, f"{root}/{n}/_SUCCESS"))

    def exists(self) -> bool:
        return bool(self._directories())

    def _listed(self) -> tuple[int, list]:
        found = self._directories()
        if not found:
            raise FileNotFoundError(f"no table at {self.path}")
        rows = self.spark.read.schema(DIRECTORY).parquet(f"{self.path}/_directory/{found[-1]:010d}").collect()
        return found[-1], rows

    def parts(self) -> list[Part]:
        """The directory: one entry per part, so its size is that of a list of files."""
        return sorted((Part(r["part"], r["folder"], r["n_rows"], r["digest"]) for r in self._listed()[1]), key=lambda p: p.part)

    def _publish(self, generation: int, parts: Iterable[Part], retired: Sequence[str], schema: T.StructType) -> None:
        rows = [(p.part, p.folder, p.n_rows, p.digest, [], None) for p in parts]
        first = min(range(len(rows)), key=lambda i: rows[i][0])
        rows[first] = (*rows[first][:4], list(retired), schema.json())
        listed = self.spark.createDataFrame(rows, DIRECTORY).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/_directory/{generation:010d}")

    # --- reading ------------------------------------------------------------------------

    def _load(self, names: Sequence[str]) -> DataFrame:
        reader = self.spark.read.format(self.fmt).option("basePath", self.path).option("mergeSchema", "true")
        return reader.load([f"{self.path}/{n}" for n in names]).drop("generation", "part")

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """All rows, or those of some parts: files of others are not listed."""
        _, rows = self._listed()
        wanted = None if parts is None else set(parts)
        names = [r["folder"] for r in rows if r["folder"] and (wanted is None or r["part"] in wanted)]
        if names:
            return self._load(names)
        schema = next(r["columns"] for r in rows if r["columns"])
        return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(schema)))

    def located(self, rows: DataFrame, name: str = "part") -> DataFrame:
        """The rows, each with its part."""
        known = [p.part for p in self.parts()]
        depths = sorted({len(p) for p in known})
        bits = key_bits(self.keys)
        if len(depths) == 1:
            return rows.withColumn(name, F.substring(bits, 1, depths[0]))
        listed = self.spark.createDataFrame([(p,) for p in known], "__part string")
        tried = rows.withColumn("__tried", F.explode(F.array(*(F.substring(bits, 1, d) for d in depths))))
        return tried.join(listed, F.col("__tried") == F.col("__part")).drop("__part").withColumnRenamed("__tried", name)

    def touched(self, rows: DataFrame) -> list[str]:
        """The parts that hold the keys of rows: no more than there are rows or parts."""
        return sorted(r["part"] for r in self.located(rows.select(*self.keys).distinct()).select("part").distinct().collect())

    # --- writing ------------------------------------------------------------------------

    def create(self, rows: DataFrame, measured: DataFrame | None = None) -> None:
        """The table anew, with as many parts as the measured size of rows asks for: of these, or, where they take long to make, of
        ``measured``, which are no fewer."""
        counted = rows if measured is None else measured
        n_bytes = measured_bytes(counted) if is_flat(counted) else 1024 * counted.count()
        depth = min(max(0, math.ceil(math.log2(max(1, n_bytes) / self.max_bytes))), int(math.log2(MAX_PARTS)))
        generation = max(self._directories(), default=-1) + 1
        retired = [p.folder for p in self.parts() if p.folder] if generation else []
        names = [ROOT + (f"{i:0{depth}b}" if depth else "") for i in range(2 ** depth)]
        made = self._write(rows.withColumn("part", F.substring(key_bits(self.keys), 1, 1 + depth)), generation, names)
        self._publish(generation, made, retired, self._schema(rows))

    def upsert(self, rows: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Rewrite the parts that the rows' keys fall into as ``merge`` of what they hold and the rows; gives their names."""
        last, listed = self._listed()
        for gone in next((r["retired"] for r in listed if r["retired"]), []):
            delete(self.spark, f"{self.path}/{gone}")
        touched = set(self.touched(rows))
        if not touched:
            return []
        merged = merge(self.read(touched).unionByName(rows, allowMissingColumns=True))
        made = self._write(self.located(merged), last + 1, sorted(touched), len(listed) - len(touched))
        known = [Part(r["part"], r["folder"], r["n_rows"], r["digest"]) for r in listed]
        retired = [p.folder for p in known if p.part in touched and p.folder]
        self._publish(last + 1, [*(p for p in known if p.part not in touched), *made], retired, self._schema(merged))
        return sorted(touched)

    def _sizes(self, root: str, names: Sequence[str]) -> dict[str, int]:
        """Bytes of parts of a generation, 0 of those without files."""
        there = set(folders(self.spark, f"{self.path}/{root}"))
        return {n: size(self.spark, f"{self.path}/{root}/part={n}") if f"part={n}" in there else 0 for n in names}

    def _schema(self, rows: DataFrame) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])

    def _reader(self, root: str, names: Iterable[str]) -> DataFrame:
        reader = self.spark.read.format(self.fmt).option("basePath", f"{self.path}/{root}").option("mergeSchema", "true")
        return reader.load([f"{self.path}/{root}/part={n}" for n in names])

    def _write(self, rows: DataFrame, generation: int, names: Sequence[str], others: int = 0) -> list[Part]:
        """Rows, whose ``part`` is one of ``names``, as folders of a generation; parts over the size are split, the largest first, while
        these and the ``others`` are no more than MAX_PARTS. Gives all parts."""
        root = f"generation={generation}"
        delete(self.spark, f"{self.path}/{root}")
        by = ["part", *self.partition_by]

        def save(df: DataFrame) -> None:
            df.hint("rebalance", *[F.col(c) for c in by]).write.format(self.fmt).mode("append").partitionBy(*by).save(f"{self.path}/{root}")

        save(rows)
        made: list[str] = []
        while names:
            sizes = self._sizes(root, names)
            over = [n for n in names if sizes[n] > self.max_bytes]
            if over:
                # A part of one key can't be split: nothing tells its rows apart.
                hashed = F.xxhash64(*self.keys)
                several = self._reader(root, over).groupBy("part").agg(F.min(hashed).alias("low"), F.max(hashed).alias("high")).where("low < high")
                over = [r["part"] for r in several.select("part").collect()]
            deeper, room = {}, MAX_PARTS - others - len(made) - len(names)
            for n in sorted(over, key=lambda n: -sizes[n]):
                depth = min(math.ceil(math.log2(sizes[n] / self.max_bytes)), int(math.log2(max(0, room) + 1)))
                if depth:
                    deeper[n] = depth
                    room -= 2 ** depth - 1
            over = list(deeper)
            made += [n for n in names if n not in deeper]
            if not over:
                break
            place = F.coalesce(*(F.when(F.col("part") == n, F.substring(key_bits(self.keys), 1, len(n) + d)) for n, d in deeper.items()))
            save(self._reader(root, over).withColumn("part", place))
            for n in over:
                delete(self.spark, f"{self.path}/{root}/part={n}")
            names = [f"{n}{i:0{d}b}" for n, d in deeper.items() for i in range(2 ** d)]
        return self._described(root, made)

    def _described(self, root: str, names: Sequence[str]) -> list[Part]:
        """Directory entries of written parts."""
        there = set(folders(self.spark, f"{self.path}/{root}"))
        filled = [n for n in names if f"part={n}" in there]
        found = {}
        if filled:
            rows = self._reader(root, filled)
            columns = self.digest_columns or _hashable(rows.drop("part"))
            entries = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), rows_digest(columns).alias("digest")).collect()  # a row per part
            found = {r["part"]: Part(r["part"], f"{root}/part={r['part']}", r["n"], r["digest"]) for r in entries}
        return [found.get(n, Part(n, None, 0, "")) for n in names]

    # --- change detection ---------------------------------------------------------------

    def differing(self, wanted: DataFrame) -> list[str]:
        """The parts whose rows differ from those of a wanted state in the digest columns. No part is read."""
        columns = self.digest_columns or _hashable(wanted)
        there = {r["part"]: r["digest"] for r in self.located(wanted).groupBy("part").agg(rows_digest(columns).alias("digest")).collect()}
        return sorted(p.part for p in self.parts() if (p.digest or "") != there.get(p.part, ""))
