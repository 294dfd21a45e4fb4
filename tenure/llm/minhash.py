"""Near-dedup by b-bit MinHash.

A document's set are the 64-bit hashes of its distinct word shingles. Of each of 128 minima only the two lowest bits of its mix are
kept, packed into four longs; how many of them agree, corrected for those that agree by chance, estimates the similarity by
bit counts. Candidates share a band of five whole minima. A candidate is confirmed on the full sets, so links are exact;
of pairs at just the similarity asked for, three in a million share no band or are estimated too low.

Documents of equal sets are one class. Within a band's bucket no pairs are listed: first all members meet the bucket's smallest
class, and what is linked becomes a component. Members of buckets that still hold several components then meet each other
in cells of bounded size: a cell gets each member's text once, estimates all pairs of different components by bit counts, confirms those
that are estimated high enough on the spot, each in the first band that both share, and gives only links that join
components. Two classes already in one component need no test, since components are what is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.common import components, computed, cut, slices, table, text_of

SHINGLE = 3
#: Hundredths of the union that the intersection must hold.
SIMILARITY = 85
#: Minima, their bands and the minima of a band (three of them are in none), and low bits kept of each.
MINIMA, BANDS, BAND = 128, 25, 5
BITS = 2
LONGS = MINIMA * BITS // 64
#: The estimate's standard deviation at similarity 0.85 is 0.037; candidates estimated so far below it go untested.
MARGIN = 0.17
SEED = 42
STAR_ROUNDS = 1
#: Members of a block of a bucket, and bytes of their texts, at most (but for a single longer text). A cell holds two blocks.
CELL_ROWS, CELL_BYTES = 1_024, 32 * 1024 * 1024
#: Sets up to this size are compared as Python sets, which is faster, larger ones as sorted arrays.
SMALL_SET = 2_000
#: Texts that are compared with one other in a task.
COMPARED = 512
_BLOCK = 8_192
_LOW = 0x5555555555555555
_FACTORS = np.random.default_rng(13).integers(0, 2 ** 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- sets and signatures ----------------------------------------------------------------


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted XXH64 of the distinct shingles of A-Z lower-cased words; fewer words are one shingle, none give none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and \x20\x09-\x0D only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    first, last, digest = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(first, last, strict=True)), np.uint64, len(first)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minima(found: np.ndarray) -> np.ndarray:
    """Per multiplier the smallest product (modulo 2^64) over a set that is not empty."""
    low = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _BLOCK):
        np.minimum(low, (found[at:at + _BLOCK, None] * _FACTORS).min(axis=0), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The lowest bits of the minima's mixes, as longs."""
    bits = (mixed(low) & np.uint64((1 << BITS) - 1)).reshape(LONGS, -1)
    return (bits << (np.arange(bits.shape[1], dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def bands(low: np.ndarray) -> np.ndarray:
    """One hash per band, of its number and its minima."""
    parts = low[: BANDS * BAND].reshape(BANDS, BAND)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (null without words), s0.. (the packed bits), bands."""
    text = text_of(text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))

    def work():
        def signed(texts: list) -> dict[str, pa.Array]:
            sizes, keys = np.zeros(len(texts), np.int64), []
            packs, banded = np.zeros((len(texts), LONGS), np.int64), np.zeros((len(texts), BANDS), np.int64)
            for i, t in enumerate(texts):
                found = shingles(t, shingle)
                sizes[i] = len(found)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                if len(found):
                    low = minima(found)
                    packs[i], banded[i] = packed(low), bands(low)
            offsets = np.arange(0, (len(texts) + 1) * BANDS, BANDS, dtype=np.int32)
            return {
                "n_shingles": pa.array(sizes), "set_key": pa.array(keys, pa.binary()), **{f"s{i}": pa.array(packs[:, i]) for i in range(LONGS)},
                "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(banded.ravel())),
            }
        return signed

    return computed(own, "text", work, f"n_shingles long, set_key binary, {', '.join(f's{i} long' for i in range(LONGS))}, bands array<long>")


# --- the estimate -----------------------------------------------------------------------


def least_matches(similarity: int) -> int:
    """Minima whose bits must agree: chance makes 1 in 2^BITS of those that differ agree."""
    chance = 1 / 2 ** BITS
    return int(np.ceil(MINIMA * (chance + (1 - chance) * max(0.0, similarity / 100 - MARGIN))))


def may_link(a: dict[str, Column], b: dict[str, Column], similarity: int) -> Column:
    """Are the sizes near enough, and do enough of the packed bits agree?"""
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[f"s{i}"].bitwiseXOR(b[f"s{i}"])
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW)))
    sized = F.least(a["n_shingles"], b["n_shingles"]) * 100 >= F.greatest(a["n_shingles"], b["n_shingles"]) * similarity
    return sized & (MINIMA - differ >= least_matches(similarity))


_INFO = ["n_shingles", *(f"s{i}" for i in range(LONGS))]


def _side(prefix: str) -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in _INFO}


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("key", *(F.col(c).alias(prefix + c) for c in df.columns if c != "key"))


# --- candidates -------------------------------------------------------------------------


def _open(members: DataFrame, info: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The members (key, c, root, info) of buckets that hold more than one component, and how many (size)."""
    rooted = info.withColumn("root", F.col("c")) if roots is None else info.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    state = cut(members.join(rooted, "c"), "members")
    several = state.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high")
    return cut(state.join(several.select("key", "size"), "key"), "open")


def _stars(state: DataFrame, similarity: int) -> DataFrame:
    """Pairs (center, other): each member with its bucket's smallest class, if of another component."""
    center = state.groupBy("key").agg(F.min_by(F.struct("c", "root", *_INFO), F.struct("root", "c")).alias("x")).select("key", "x.*")
    met = state.join(_renamed(center, "o_"), "key").where("root <> o_root").where(may_link(_side(""), _side("o_"), similarity))
    return met.select(F.col("o_c").alias("center"), F.col("c").alias("other")).distinct()


# --- confirmation -----------------------------------------------------------------------


def linked(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similarity * (len(a) + len(b) - both)


class _Cell:
    """Two blocks of a bucket, or one twice: their links that join components."""

    def __init__(self, key: int, rows: list[tuple], shingle: int, similarity: int):
        self.key, self.shingle, self.similarity = key, shingle, similarity
        self.blocks = [r[0] for r in rows]
        self.ids, self.roots, self.sizes = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        self.bits = np.array([r[4] for r in rows], np.int64).view(np.uint64)
        self.bands = np.array([r[5] for r in rows], np.int64)
        self.texts = [r[6] for r in rows]
        self.sets: dict[int, tuple[np.ndarray, frozenset | None]] = {}
        self.parent: dict[int, int] = {}

    def _find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def _set(self, i: int) -> tuple[np.ndarray, frozenset | None]:
        if i not in self.sets:
            found = shingles(self.texts[i], self.shingle)
            self.sets[i] = found, (frozenset(found.tolist()) if len(found) <= SMALL_SET else None)
        return self.sets[i]

    def _linked(self, i: int, j: int) -> bool:
        (a, small_a), (b, small_b) = self._set(i), self._set(j)
        if small_a is None or small_b is None:
            return linked(a, b, self.similarity)
        both = len(small_a & small_b)
        return 100 * both >= self.similarity * (len(a) + len(b) - both)

    def links(self, i_block: int, j_block: int) -> Iterator[tuple[int, int]]:
        least = least_matches(self.similarity)
        band = int(np.flatnonzero((self.bands == self.key).all(axis=0))[0])  # the key names its band
        blocks = np.array(self.blocks)
        left, right = np.flatnonzero(blocks == i_block), np.flatnonzero(blocks == j_block)
        for i in left.tolist():
            x = self.bits[right] ^ self.bits[i]
            same = MINIMA - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LOW)).sum(axis=1, dtype=np.int64)
            near = (same >= least) & (self.roots[right] != self.roots[i])
            near &= 100 * np.minimum(self.sizes[right], self.sizes[i]) >= self.similarity * np.maximum(self.sizes[right], self.sizes[i])
            if i_block == j_block:
                near &= self.ids[right] > self.ids[i]
            others = right[near]
            if band and len(others):
                others = others[~(self.bands[others, :band] == self.bands[i, :band]).any(axis=1)]
            for j in others.tolist():
                u, v = self._find(int(self.roots[i])), self._find(int(self.roots[j]))
                if u != v and self._linked(i, j):
                    self.parent[max(u, v)] = min(u, v)
                    yield int(self.ids[i]), int(self.ids[j])


def met_in_cells(state: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Links u, v that join different components within buckets, confirmed on full sets."""
    own = state.select("key", "c", "root", "n_shingles", F.array(*(f"s{i}" for i in range(LONGS))).alias("bits"))
    lengths = texts.select("c", F.octet_length("text").alias("bytes"))
    sizes = own.select("key", "c").join(lengths, "c").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    blocks = sizes.select("key", F.ceil(F.greatest(F.col("n") / CELL_ROWS, F.col("bytes") / CELL_BYTES)).cast("int").alias("n_blocks"))
    rows = own.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("c"), F.col("n_blocks")).cast("int"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "k")).withColumn("j", F.greatest("block", "k")).drop("k", "n_blocks")
    whole = rows.join(classes.select("c", "bands"), "c").join(texts, "c")
    columns = ["key", "i", "j", "block", "c", "root", "n_shingles", "bits", "bands", "text"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

        cell, held = None, []
        for batch in batches:
            for part in slices([batch]):
                for row in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns), strict=True):
                    if row[:3] != cell:
                        if len(held) > 1:
                            yield out(list(_Cell(cell[0], held, shingle, similarity).links(*cell[1:])))
                        cell, held = row[:3], []
                    held.append(row[3:])
        yield out(list(_Cell(cell[0], held, shingle, similarity).links(*cell[1:])) if len(held) > 1 else [])

    sorted_rows = whole.select(columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return cut(sorted_rows.mapInArrow(meet, "u long, v long").distinct(), "links")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Of pairs (center, other), those whose full sets are similar enough, as u and v.

    A task holds one center's set at a time; a center with many others is sent to several tasks.
    """
    pairs = cut(pairs, "candidates")
    fan = pairs.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / COMPARED).cast("int").alias("parts"))
    others = pairs.join(fan, "center").select("center", F.pmod(F.xxhash64("other"), F.col("parts")).cast("int").alias("part"), "other")
    others = others.join(texts, others["other"] == texts["c"]).select("center", "part", "other", "text")
    centers = fan.join(texts, fan["center"] == texts["c"]).select(
        "center", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("other"), "text"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, own = None, None
        for batch in batches:
            for part in slices([batch]):
                u, v = [], []
                for c, o, text in zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in ("center", "other", "text")), strict=True):
                    if o is None:
                        center, own = c, shingles(text, shingle)
                    elif c == center and linked(own, shingles(text, shingle), similarity):
                        u.append(c)
                        v.append(o)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    rows = others.unionByName(centers).repartition("center", "part").sortWithinPartitions("center", "part", F.asc_nulls_first("other"))
    return cut(rows.mapInArrow(check, "u long, v long"), "links")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """c and text, one row for each wanted class (c, rep: the id and text hash of one of its documents)."""
    text = text_of(text_col)
    own = docs.select(F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key")).alias("rep"), text.alias("text"))
    found = cut(own.join(wanted, own["rep"].eqNullSafe(wanted["rep"])).select("c", "text"), "texts")
    if found.groupBy("c").count().where("count > 1").isEmpty():
        return found
    return cut(found.dropDuplicates(["c"]), "texts")


# --- components -------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    component_id is the smallest id of those reachable over links; kept is whether it is the document's own. Null text
    counts as empty; texts without words have no shingles and are linked with nothing. Null ids count
    only where a component has no other, and are kept there. Rows that repeat an id each get a row. Extra columns are not read.
    No rows give no rows.
    """
    found = cut(signatures(docs, id_col, text_col, shingle), "signatures")
    rep = F.struct("doc_id", "text_key")
    classes = found.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"), F.min(rep).alias("rep"), *(F.any_value(c).alias(c) for c in (*_INFO, "bands"))
    )
    classes = cut(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    info = classes.select("c", *_INFO)
    keyed = classes.select("c", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = cut(keyed.join(shared, "key"), "shared")

    roots = None
    if not members.isEmpty():
        involved = members.select("c").distinct().join(classes.select("c", "rep"), "c")
        texts = _texts(docs, involved, id_col, text_col)
        links = None
        for _ in range(STAR_ROUNDS):
            new = confirmed(_stars(_open(members, info, roots), similarity), texts, shingle, similarity)
            links = new if links is None else links.unionByName(new)
            roots = cut(components(links), "roots")
        new = met_in_cells(_open(members, info, roots), classes, texts, shingle, similarity)
        links = new if links is None else links.unionByName(new)
        roots = cut(components(links), "roots")

    own = classes.select("c", "set_key", "first_id")
    own = own.withColumn("root", F.col("c")) if roots is None else own.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = own.groupBy("root").agg(F.min("first_id").alias("low"))
    placed = own.join(lowest, "root").select("set_key", "low")
    out = found.select("doc_id", "n_shingles", "set_key").join(placed, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
