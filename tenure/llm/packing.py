"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Documents are tokenised and cut into pieces of at most one sequence. Then, from large pieces to small:
pieces and the gaps of open sequences are sorted together into ranges of size; each range is swept
once, from large to small, and each piece takes its successor, the smallest gap that holds it. Where pieces of one range find
no gap left, they are ranked and take, rank by rank, the smallest left gaps of the ranges above, each gap as many successive
pieces as surely fit. Gaps shrink, and the sweep is repeated until it places nothing; what is left opens new sequences. The driver
sees two counts and two sizes per range.

Very small pieces are first bundled into small bundles, which are then packed as pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenure.llm.common import cut, slices, table, text_of

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 2048
END = 0
#: Words a worker remembers at most, and the longest that it remembers.
REMEMBERED, LONGEST = 500_000, 64
#: Characters on which str.split or str.lower differs from the tokenizer's own.
_OWN_WAY = re.compile("[\x1c-\x1fΣ]")
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokenizer:
    """The vocabulary's ids of a text as little-endian unsigned 32-bit integers.

    The tokenizer drops white space, lower-cases, and never joins across white space, so words are encoded
    once and remembered. Texts where lower-casing or white space is special go to the tokenizer whole. With ``added``, so do
    texts that hold an added token (such as <|endoftext|>), which has its own id as the library sets it; else it is text like other.
    """

    def __init__(self, path: str = VOCABULARY, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = tuple(t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()) if added else ()
        self.words: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """A word not in memory. Letters and the signs after them are encoded apart, so those are not remembered together."""
        letters = word.rstrip(_SIGNS)
        if len(letters) < len(word) and letters.isalpha():
            signs = word[len(letters):]
            return (self.words.get(letters) or self._word(letters)) + (self.words.get(signs) or self._word(signs))
        packed = self._ids(word)
        if len(word) <= LONGEST:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if _OWN_WAY.search(text) or not unicodedata.is_normalized("NFC", text):
            return self._ids(text)
        known, lower = self.words.get, text.lower()
        if any(t in lower for t in self.added):
            return self._ids(text)
        return b"".join([known(w) or self._word(w) for w in lower.split()])


@lru_cache(maxsize=2)
def tokenizer(path: str = VOCABULARY) -> WordTokenizer:
    return WordTokenizer(path, added=True)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32: each document's ids and an end mark, cut where longer than a sequence.

    Null text counts as empty: one piece, the end mark. uid numbers the rows of one run: cut() them before use.
    """
    end = np.array([END], "<u4").tobytes()

    names = ("uid", "doc_id", "piece", "start", "length", "ids_crc32")
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, uid = tokenizer(path), TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = own.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((uid, doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    uid += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _sorted(df: DataFrame, *order) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


SWEPT = "piece boolean, id long, size long, free long, seq long, ofs long, left boolean, part int, rank long, total boolean"


def _sweep(batches: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """One range, from large to small: each piece into the smallest gap that holds it.

    Gives every piece (left: no gap found), every gap (left: as large as any later range asks for) and, marked as
    total, a row with how many pieces (size) and gaps (free) are left, how many pieces found one (rank), the largest left
    piece (seq) and the smallest left gap (ofs).
    rank orders the left pieces as swept, and the left gaps from the smallest.
    """
    gaps: list[tuple[int, int]] = []  # free, sequence; by size
    part, low, n_left, n_placed, largest, rows = TaskContext.get().partitionId(), capacity, 0, 0, 0, []
    for batch in batches:
        for piece, uid, size in zip(batch["piece"], batch["id"], batch["size"], strict=True):
            low = size
            if not piece:
                insort(gaps, (size, uid))
                continue
            at = bisect_left(gaps, (size, -1))
            if at == len(gaps):
                rows.append((True, uid, size, 0, 0, 0, True, part, n_left, False))
                n_left, largest = n_left + 1, max(largest, size)
                continue
            free, seq = gaps.pop(at)
            rows.append((True, uid, size, free - size, seq, capacity - free, False, part, 0, False))
            n_placed += 1
            insort(gaps, (free - size, seq))
        if len(rows) >= 50_000:
            yield _swept(rows)
            rows = []
    first = bisect_left(gaps, (low, -1))
    for i, (free, seq) in enumerate(gaps):
        rows.append((False, seq, free, free, seq, 0, i >= first, part, i - first, False))
    if n_left or n_placed or gaps:
        rows.append((False, -1, n_left, len(gaps) - first, largest, gaps[first][0] if first < len(gaps) else 0, False, part, n_placed, True))
    yield _swept(rows)


def _swept(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in SWEPT.split(", ")]).astype(
        {"piece": bool, "left": bool, "total": bool, "part": "int32"} | dict.fromkeys(("id", "size", "free", "seq", "ofs", "rank"), "int64")
    )


def _segments(totals: list[tuple[int, int, int]], each: Callable[[int, int], int] | None = None) -> list[tuple[int, int, int, int, int]]:
    """Which left pieces take which left gaps: (pieces' range, first rank, gaps' range, first rank, how many pieces).

    totals: range, left pieces, left gaps. Pieces of a range take the smallest gaps of the ranges above it, so many
    successive ones a gap as ``each`` says of the two ranges (else one).
    """
    found, stack = [], []  # the stack holds ranges above with what they have left: [range, next rank, how many]
    for part, wanted, n_gaps in sorted(totals):
        taken = 0
        while taken < wanted and stack:
            top = stack[-1]
            k = each(part, top[0]) if each else 1
            n = min(wanted - taken, k * top[2])
            found.append((part, taken, top[0], top[1], n))
            n_used = -(-n // k)
            taken, top[1], top[2] = taken + n, top[1] + n_used, top[2] - n_used
            if not top[2]:
                stack.pop()
        if n_gaps:
            stack.append([part, 0, n_gaps])
    return found


def _crossed(swept: DataFrame, segments: list, each: Callable[[int, int], int], capacity: int) -> DataFrame:
    """Left pieces with the left gaps that their ranks give them: id, seq, ofs, and free, what stays, at a gap's last piece (else -1)."""
    spark = swept.sparkSession
    rows_ = [(i, *s, each(s[0], s[2])) for i, s in enumerate(segments)]
    table_ = F.broadcast(spark.createDataFrame(rows_, "seg int, p int, p0 long, g int, g0 long, n long, k long"))  # two per range
    rows = swept.where("left")
    taking = rows.where("piece").join(table_, (F.col("part") == F.col("p")) & (F.col("rank") >= F.col("p0")) & (F.col("rank") < F.col("p0") + F.col("n")))
    giving = rows.where("not piece").join(table_, (F.col("part") == F.col("g")) & (F.col("rank") >= F.col("g0")) & (F.expr("(rank - g0) * k < n")))
    taking = taking.select("seg", F.expr("(rank - p0) div k").alias("nth"), "id", "size")
    giving = giving.select("seg", (F.col("rank") - F.col("g0")).alias("nth"), F.col("seq"), F.col("free").alias("gap"))
    before = Window.partitionBy("seg", "nth").orderBy(F.desc("size"), "id").rowsBetween(Window.unboundedPreceding, 0)  # a gap's few pieces
    last = F.lead("id").over(Window.partitionBy("seg", "nth").orderBy(F.desc("size"), "id")).isNull()
    taking = taking.withColumns({"upto": F.sum("size").over(before), "last": last})
    left = F.col("gap") - F.col("upto")
    return taking.join(giving, ["seg", "nth"]).select(
        "id", F.when(F.col("last"), left).otherwise(-1).alias("free"), "seq", (capacity - left - F.col("size")).alias("ofs")
    )


def _used(swept: DataFrame, segments: list, each: Callable[[int, int], int]) -> DataFrame:
    """The swept rows with __used: how many of the range's left pieces, or left gaps, the segments take, which are the first by rank."""
    used: dict[tuple[int, bool], int] = {}
    for p, p0, g, g0, n in segments:
        used[p, True], used[g, False] = p0 + n, g0 - (-n // each(p, g))
    table_ = swept.sparkSession.createDataFrame([(p, piece, n) for (p, piece), n in used.items()], "u_part int, u_piece boolean, u_n long")
    joined = swept.join(F.broadcast(table_), (F.col("part") == F.col("u_part")) & (F.col("piece") == F.col("u_piece")), "left")
    return joined.withColumn("__used", F.coalesce("u_n", F.lit(0)))


def _fill(batches: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Pieces in order into new sequences, each named after its first piece; id, seq, ofs, and free where it is the last one."""
    rows, seq, used = [], None, 0
    for batch in batches:
        for uid, size in zip(batch["id"], batch["size"], strict=True):
            if seq is None or used + size > capacity:
                if rows:
                    rows[-1][3] = capacity - used
                seq, used = uid, 0
            rows.append([uid, seq, used, -1])
            used += size
        if len(rows) > 50_000:
            yield pd.DataFrame(rows[:-1], columns=["id", "seq", "ofs", "free"]).astype("int64")
            rows = rows[-1:]
    if rows:
        rows[-1][3] = capacity - used
    yield pd.DataFrame(rows, columns=["id", "seq", "ofs", "free"]).astype("int64")


def _new_sequences(items: DataFrame, capacity: int) -> DataFrame:
    order = (F.desc("size"), F.asc("id"))
    return cut(_sorted(items, *order).mapInPandas(lambda b: _fill(b, capacity), "id long, seq long, ofs long, free long"), "opened")


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """id, seq, ofs for items (id, size), 1 <= size <= capacity: into few sequences, gapless from 0."""
    small = max(1, capacity // 32)
    bundles = _new_sequences(items.where(F.col("size") <= small // 2), small)  # seq: the bundle
    bundled = bundles.where("free >= 0").select(F.col("seq").alias("id"), (small - F.col("free")).alias("size"))
    items = cut(items.where(F.col("size") > small // 2).unionByName(bundled), "items")
    half = items.where(F.col("size") > capacity // 2)
    placed = [half.select("id", F.col("id").alias("seq"), F.lit(0).cast("long").alias("ofs"))]
    gaps = half.where(F.col("size") < capacity).select(F.col("id").alias("seq"), (capacity - F.col("size")).alias("free"))
    for high, low in ((capacity // 2, capacity // 3), (capacity // 3, capacity // 6), (capacity // 6, 0)):
        pending = items.where((F.col("size") <= high) & (F.col("size") > low))
        small_gaps, large_gaps = gaps.where(F.col("free") <= low), gaps.where(F.col("free") > low)
        while True:
            events = pending.select(F.lit(True).alias("piece"), "id", "size").unionByName(
                large_gaps.select(F.lit(False).alias("piece"), F.col("seq").alias("id"), F.col("free").alias("size"))
            )
            order = (F.desc("size"), F.asc("piece"), F.asc("id"))
            swept = cut(_sorted(events, *order).mapInPandas(lambda b: _sweep(b, capacity), SWEPT), "swept")
            totals = swept.where("total").select("part", "size", "free", "rank", "seq", "ofs").collect()  # a row per range
            rows = swept.where("not total")
            largest, least = {r["part"]: r["seq"] for r in totals}, {r["part"]: r["ofs"] for r in totals}
            each = lambda p, g, m=largest, f=least: f[g] // m[p]
            segments = _segments([(r["part"], r["size"], r["free"]) for r in totals], each)
            n_placed = sum(r["rank"] for r in totals) + sum(s[4] for s in segments)
            left = sum(r["size"] for r in totals) - sum(s[4] for s in segments)
            placed.append(rows.where("piece and not left").select("id", "seq", "ofs"))
            pending = rows.where("piece and left").select("id", "size")
            open_ = rows.where("not piece").select("seq", "free")
            if segments:
                crossed = cut(_crossed(rows, segments, each, capacity), "crossed")
                placed.append(crossed.select("id", "seq", "ofs"))
                marked = _used(rows, segments, each)
                pending = marked.where("piece and left and rank >= __used").select("id", "size")
                open_ = marked.where("not piece and (not left or rank >= __used)").select("seq", "free").unionByName(crossed.where("free >= 0").select("seq", "free"))
            small_gaps = small_gaps.unionByName(open_.where((F.col("free") <= low) & (F.col("free") > 0)))
            large_gaps = open_.where(F.col("free") > low)
            if not left or not n_placed:
                break
        gaps = small_gaps.unionByName(large_gaps)
        if left:
            opened = _new_sequences(pending, capacity)
            placed.append(opened.select("id", "seq", "ofs"))
            gaps = gaps.unionByName(opened.where("free > 0").select("seq", "free"))
        gaps = cut(gaps, "gaps")
    whole = placed[0]
    for p in placed[1:]:
        whole = whole.unionByName(p)
    member = bundles.select("id", F.col("seq").alias("bundle"), F.col("ofs").alias("inner"))
    return whole.join(member, F.col("bundle") == whole["id"], "left").select(
        F.coalesce(member["id"], whole["id"]).alias("id"), "seq", (F.col("ofs") + F.coalesce("inner", F.lit(0))).alias("ofs")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one token, the end mark. Null and repeated ids are packed
    like others. Only documents longer than a sequence are cut. Extra columns are not read. No rows give no rows.
    """
    cut_up = cut(pieces(docs, capacity, path, id_col, text_col), "pieces")
    placed = place(cut_up.select(F.col("uid").alias("id"), F.col("length").alias("size")), capacity)
    return cut_up.join(placed, cut_up["uid"] == placed["id"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), F.col("ofs").alias("offset")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
