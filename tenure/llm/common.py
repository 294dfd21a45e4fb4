"""What the operators of this folder share: reading tables, cutting lineage, components of a graph."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A folder of this process, where the session names none and runs in one process (tests).
_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column with null counted as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. A folder of its own only in one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _OWN.setdefault("path", tempfile.mkdtemp(prefix="tenure-llm-"))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tenure-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a frame made by cut() that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tenure-llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that a Python task turns into Python values at a time: texts may be long.
SLICE = 500


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def computed(df: DataFrame, source: str, work: Callable[[], Callable[[list], dict[str, pa.Array]]], fields: str) -> DataFrame:
    """``df`` without the column ``source``, and with columns computed from it: names and types in ``fields``.

    ``work`` is called once a task and gives a function from a list of values to the new columns. All other columns pass as
    Arrow arrays, so that nulls and large integers stay what they are.
    """
    kept = df.drop(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = work()
        for batch in slices(batches):
            at = batch.schema.get_field_index(source)
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if i != at} | compute(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return df.mapInArrow(run, own + fields)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): one row (node, root) per node, root the smallest node.

    Alternates large-star and small-star steps: each round hangs every node's larger neighbours,
    then its smaller ones, on its smallest neighbour. Groups are only ever reduced to their minimum,
    so no node's neighbours are gathered in one place. Loops and repeated edges are ignored; no
    edges give no rows.
    """
    stars = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _fingerprint(stars)
    for _ in range(max_rounds):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        after = cut(small, "edges")
        before, stars = stars, after
        drop_cut(before)
        now = _fingerprint(stars)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
