"""Exact dedup by a cuckoo-filter index of text digests.

The index is split by digest into buckets. Each bucket holds a cuckoo filter and, in lists of the
same addresses, the digests it stands for. A lookup asks the filter first; a hit is verified
against the stored digests of its address; a miss is proof of a new text. When an insertion
overflows, the filter is rebuilt twice as large from the stored digests. Digests can be deleted.

Only digests travel: each task first joins its own copies to one row per digest, so that a text
with a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.llm.columns import nested
from tenure.llm.common import cut, table, text_of

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Buckets of the index. A task works bucket by bucket, so this bounds its memory: at 25 billion
#: distinct texts a bucket holds 380,000 digests.
BUCKETS = 65_536
SLOTS = 4
MAX_KICKS = 200
#: Digests a map task holds before it passes them on.
COMBINE_ROWS = 100_000

ENTRY = T.StructType([
    T.StructField("bucket", T.IntegerType()),
    T.StructField("digest", T.BinaryType()),
    T.StructField("keep_id", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_first", T.LongType()),
])


class CuckooIndex:
    """Live digests of one bucket, each with a value: a cuckoo filter over content kept by address."""

    def __init__(self, width: int = 4):
        self.width = width  # addresses, a power of two
        self.filter = [[] for _ in range(width)]
        self.content: list[list[list]] = [[] for _ in range(width)]
        self.size = 0
        self.resizes = 0

    @staticmethod
    def _print(digest: bytes) -> int:
        return int.from_bytes(digest[4:6], "little") or 1

    def _addresses(self, digest: bytes) -> tuple[int, int, int]:
        mark = self._print(digest)
        first = int.from_bytes(digest[8:16], "little") & (self.width - 1)
        return mark, first, self._other(first, mark)

    def _other(self, address: int, mark: int) -> int:
        return address ^ ((mark * 0x5BD1E995) & (self.width - 1))

    def find(self, digest: bytes) -> list | None:
        """The stored [digest, value], or None. A hit of the filter counts only if the digest is stored."""
        mark, first, second = self._addresses(digest)
        if mark in self.filter[first] or mark in self.filter[second]:
            for entry in self.content[first]:
                if entry[0] == digest:
                    return entry
        return None

    def insert(self, digest: bytes, value: object) -> list:
        """Store a digest that is not stored yet."""
        entry = [digest, value]
        self.content[self._addresses(digest)[1]].append(entry)
        self.size += 1
        if not self._place(digest):
            self._grow()
        return entry

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out; False if it is not stored."""
        entry = self.find(digest)
        if entry is None:
            return False
        mark, first, second = self._addresses(digest)
        self.content[first].remove(entry)
        (self.filter[first] if mark in self.filter[first] else self.filter[second]).remove(mark)
        self.size -= 1
        return True

    def _place(self, digest: bytes) -> bool:
        mark, address, second = self._addresses(digest)
        for place in (address, second):
            if len(self.filter[place]) < SLOTS:
                self.filter[place].append(mark)
                return True
        for kick in range(MAX_KICKS):
            slots = self.filter[address]
            slots.append(mark)
            mark = slots.pop(kick % SLOTS)
            address = self._other(address, mark)
            if len(self.filter[address]) < SLOTS:
                self.filter[address].append(mark)
                return True
        return False

    def _grow(self) -> None:
        entries = list(self)
        while True:
            self.width *= 2
            self.resizes += 1
            self.filter = [[] for _ in range(self.width)]
            self.content = [[] for _ in range(self.width)]
            for entry in entries:
                self.content[self._addresses(entry[0])[1]].append(entry)
            if all(self._place(entry[0]) for entry in entries):
                return

    def __iter__(self) -> Iterator[list]:
        return (entry for entries in self.content for entry in entries)


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, WHITE_SPACE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the SHA-256 of each normalised text."""
    digest = F.unhex(F.sha2(normalised(text_of(text_col)).cast("binary"), 256))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"))


def _joined(keep_id: int | None, n_rows: int, n_first: int, value: list) -> None:
    """Add rows of the same text to a value [keep_id, n_rows, n_first]; null ids come last."""
    value[1] += n_rows
    if keep_id == value[0]:
        value[2] += n_first
    elif keep_id is not None and (value[0] is None or keep_id < value[0]):
        value[0], value[2] = keep_id, n_first


_ARROW = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("n_rows", pa.int64()), ("n_first", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([],) * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _combine(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per digest of a task's own rows."""
    def rows() -> pa.RecordBatch:
        return _batch([(int.from_bytes(d[:4], "big") % n_buckets, d, *v) for d, v in held.items()])

    held: dict[bytes, list] = {}
    for batch in batches:
        for doc_id, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            value = held.setdefault(digest, [doc_id, 0, 0])
            _joined(doc_id, 1, 1, value)
        if len(held) >= COMBINE_ROWS:
            yield rows()
            held = {}
    yield rows()


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of each bucket, by probing and filling its cuckoo index; rows come sorted by bucket."""
    bucket, index, done = None, CuckooIndex(), []
    for batch in batches:
        for b, digest, keep_id, n_rows, n_first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket:
                done += [(bucket, d, *v) for d, v in index]
                bucket, index = b, CuckooIndex()
                if len(done) >= 10_000:
                    yield _batch(done)
                    done = []
            entry = index.find(digest)
            if entry is None:
                index.insert(digest, [keep_id, n_rows, n_first])
            else:
                _joined(keep_id, n_rows, n_first, entry[1])
    yield _batch(done + [(bucket, d, *v) for d, v in index])


def build_index(found: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """Entries of the index over ``digests()``: bucket, digest, keep_id, n_rows, n_first (rows with keep_id)."""
    combined = found.select("doc_id", "digest").mapInArrow(lambda batches: _combine(batches, n_buckets), ENTRY)
    return combined.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_index, ENTRY)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """The index after documents came and went (both as ``digests()`` gives them).

    A digest whose last document goes is deleted. keep_id is the smallest id ever added that is not
    among the removed of its digest's rows in this call; it is null if that can't be told from the
    index, and then comes from the live documents. Removing an unknown digest changes nothing.
    """
    changes = (
        added.select("digest", "doc_id", F.lit(1).alias("n")).unionByName(removed.select("digest", "doc_id", F.lit(-1).alias("n")))
        .groupBy("digest").agg(
            F.min(F.when(F.col("n") > 0, F.col("doc_id"))).alias("add_id"), F.sum((F.col("n") > 0).cast("long")).alias("n_add"),
            F.min(F.when(F.col("n") < 0, F.col("doc_id"))).alias("gone_id"), F.sum((F.col("n") < 0).cast("long")).alias("n_gone"),
        )
        .withColumn("bucket", F.expr(f"cast(cast(conv(hex(substring(digest, 1, 4)), 16, 10) as bigint) % {n_buckets} as int)"))
    )

    def apply(stored: pa.Table, change: pa.Table) -> pa.Table:
        live, bucket = CuckooIndex(), None
        for r in stored.to_pylist():
            bucket = r["bucket"]
            live.insert(r["digest"], [r["keep_id"], r["n_rows"], r["n_first"]])
        for r in change.to_pylist():
            bucket, digest, add_id, n_add, gone_id, n_gone = (r[c] for c in ("bucket", "digest", "add_id", "n_add", "gone_id", "n_gone"))
            entry = live.find(digest)
            if n_add:
                if entry is None:
                    entry = live.insert(digest, [add_id, 0, 0])
                _joined(add_id, n_add, 1, entry[1])
            if n_gone and entry is not None:
                entry[1][1] -= n_gone
                if entry[1][1] <= 0:
                    live.delete(digest)
                elif entry[1][0] is not None and gone_id is not None and gone_id <= entry[1][0]:
                    entry[1][0] = None
        return pa.Table.from_batches([_batch([(bucket, d, *v) for d, v in live])])

    return index.groupBy("bucket").cogroup(changes.groupBy("bucket")).applyInArrow(apply, ENTRY)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are equal. A null id comes after every other and stays
    only where its group has no other. Rows that repeat an id in a group are copies: one of them is
    kept. Other columns are not read. No rows give no rows.
    """
    found = cut(digests(docs, id_col, text_col), "digests")
    index = cut(build_index(found), "index")
    # A group's rows may be many, its entry is one: a plain join, whose large side Spark can split.
    marked = found.join(index.select("digest", "keep_id", "n_rows", "n_first"), "digest")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = marked.select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"), first.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_first",
    )
    if index.where("n_first > 1").isEmpty():
        return out.drop("n_first")
    repeated = F.col("kept") & (F.col("n_first") > 1)
    numbered = out.where(repeated).groupBy("doc_id", "keep_id", "group_size", "text_sha256").count()
    one_each = numbered.select(
        "doc_id", "keep_id", "group_size",
        F.explode(F.transform(F.sequence(F.lit(1), F.col("count")), lambda i: i == 1)).alias("kept"), "text_sha256",
    )
    return out.where(~repeated).drop("n_first").unionByName(one_each)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, whole rows, without those whose text a document of smaller id has."""
    found = cut(digests(docs, id_col, text_col), "digests")
    index = cut(build_index(found), "index")
    gone = found.join(index, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_rows") > 1))
    # By id and digest: the same id may also stand on another text. The rows travel as one column, so that no name of theirs clashes.
    sha = F.sha2(normalised(text_of(text_col)).cast("binary"), 256)
    own = nested(docs, key=F.struct(F.col(id_col).cast("long").alias("doc_id"), sha.alias("sha")))
    gone = gone.select(F.struct("doc_id", F.lower(F.hex("digest")).alias("sha")).alias("gone")).distinct()
    kept = own.join(gone, F.col("key").eqNullSafe(F.col("gone")), "left_anti")
    if index.where("n_first > 1").isEmpty():
        return kept.select("row.*")
    again = index.where("n_first > 1").select(F.lower(F.hex("digest")).alias("again"))
    single = kept.join(again, F.col("key.sha") == F.col("again"), "left_anti")
    rest = kept.join(again, F.col("key.sha") == F.col("again"), "left_semi").withColumn("sha", F.col("key.sha")).dropDuplicates(["sha"])
    return single.select("row.*").unionByName(rest.select("row.*"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
