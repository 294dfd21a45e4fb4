"""Near-dedup by SimHash with deletion-variant signatures.

A fingerprint has 64 bits over the words' shingles. Fingerprints that differ in at most two bits
are linked. Each is cut into two segments of 32 bits: of two linked ones, some segment differs by at most one bit,
so both share that segment with the same position left out. The index holds, for every fingerprint,
the 2 x 32 segment variants with one wildcard position; an equality join finds candidates, and
the distance is verified.

Copies meet first in one row per fingerprint. Where a variant holds more than a few fingerprints, its
pairs are not listed: those fingerprints are keyed by all fingerprints within one bit of them. At most 65 share
such a key, any two of them differ by at most two bits, and every two that do share one, so
linking each to the smallest of its key gives the same components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.columns import nested
from tenure.llm.common import components, computed, cut, table, text_of

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints a variant may hold for its pairs to be listed; beyond, the exact way by neighbours.
LISTED = 8
#: Fingerprints whose variants one task lists: 64 rows each, which bounds its memory.
FPS_PER_TASK = 20_000
_BLOCK = 65_536


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit b is 1 if set in more than half of the shingles' XXH64; no words: 0. Unsigned."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and \x20\x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    n, ones, digest = len(first), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(first[at:at + _BLOCK], last[at:at + _BLOCK], strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and text_key (a hash of the text); null text counts as empty."""
    text = text_of(text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))

    def work():
        return lambda texts: {"fp": pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))}

    return computed(own, "text", work, "fp long")


def variants(fps: DataFrame) -> DataFrame:
    """fp once per one-wildcard segment variant; key holds segment, position and the segment without it."""
    numbered = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    return numbered.select("fp", F.expr(
        "(cast(v as bigint) << 32) | (((fp >>> (32 * (v >> 5))) & 4294967295L) & ~(1L << (v & 31)))"
    ).alias("key"))


def members(fps: DataFrame, keys: DataFrame) -> DataFrame:
    """key, fp for the fingerprints that hold these variants.

    A variant stands for two segments, with the wildcard bit 0 or 1; looking these up among the two
    segments of each fingerprint moves 2 rows per fingerprint instead of its 64 variants.
    """
    segments = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg")).select(
        "fp", "seg", F.expr("(fp >>> (32 * seg)) & 4294967295L").alias("part")
    )
    place = F.expr("cast(key >> 32 as int)")
    base = F.expr("key & 4294967295L")
    wanted = keys.select("key", place.alias("v"), base.alias("base")).select(
        "key", F.expr("v >> 5").alias("seg"), F.explode(F.array("base", F.expr("base | (1L << (v & 31))"))).alias("part")
    )
    return segments.join(wanted, ["seg", "part"]).select("key", "fp")


def links(fps: DataFrame) -> DataFrame:
    """Edges u, v between distinct fingerprints, enough to join all that are linked by pairs of two bits at most.

    Every link of a listed variant is there; in crowded variants, each fingerprint hangs on the
    smallest within reach of the same neighbour, from which all links follow.
    """
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS
    keyed = variants(fps)
    shared = cut(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1"), "variants"
    )
    pairs = shared.where("n = 2").select("u", "v").where(close)
    listed = members(fps, shared.where(f"n > 2 and n <= {LISTED}"))
    pairs = pairs.unionByName(
        listed.select("key", F.col("fp").alias("u")).join(listed.select("key", F.col("fp").alias("v")), "key").where("u < v")
        .select("u", "v").where(close)
    )
    crowded = members(fps, shared.where(f"n > {LISTED}")).select("fp").distinct()
    near = crowded.select("fp", F.explode(F.concat(
        F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    )).alias("z"))
    lowest = near.groupBy("z").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1").select("z", "u")
    hung = near.join(lowest, "z").where("u <> fp").select("u", F.col("fp").alias("v"))
    return pairs.unionByName(hung).distinct()


def _spread(fps: DataFrame) -> DataFrame:
    """The few bytes of the fingerprints over so many tasks that their variants fit."""
    return fps.repartition(max(1, -(-fps.count() // FPS_PER_TASK)))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    found = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = cut(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(_spread(distinct.select("fp"))))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return found.join(rooted.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (smallest doc_id of its component).

    Null text counts as empty; texts without words have fingerprint zero and are linked like others.
    Null ids count only where a component has no other. Rows that repeat an id each get a row.
    Other columns are not read. No rows give no rows.
    """
    return _classes(docs, id_col, text_col, shingle).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, whole rows, one of each component: that of the smallest id.

    Of rows that repeat that id in a component, one stays, also where the id is null because the component has no
    other. Components are told apart by their root fingerprint, so an id on unrelated texts, or none, keeps a row of each.
    Extra columns pass unchanged.
    """
    marked = cut(_classes(docs, id_col, text_col, SHINGLE), "near")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    key = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"))
    own = nested(docs, key=key)
    pair = F.struct("doc_id", "text_key")
    gone = marked.where(~first).select(pair.alias("gone")).distinct()
    kept = own.join(gone, F.col("key").eqNullSafe(F.col("gone")), "left_anti")
    # Ids that stand on several rows of their component: one of those rows stays.
    again = marked.where(first).groupBy("root", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("text_key").alias("low")).where("n > 1")
    again = cut(again, "again")
    if again.isEmpty():
        return kept.select("row.*")
    # Equal texts have one fingerprint, so an id and a text stand in one component only.
    repeated = marked.where(first).join(again.select("root", "low"), "root").select(pair.alias("again"), "doc_id", "text_key", "low")
    repeated = cut(repeated.distinct(), "repeated")
    single = kept.join(repeated.select("again"), F.col("key").eqNullSafe(F.col("again")), "left_anti")
    low = repeated.where("text_key = low").select(F.col("again").alias("low"))
    rest = kept.join(low, F.col("key").eqNullSafe(F.col("low")), "left_semi").dropDuplicates(["key"])
    return single.select("row.*").unionByName(rest.select("row.*"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
