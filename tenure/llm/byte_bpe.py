"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: the product of two encodings is the encoding of the joined
string. It is found by re-encoding a window around the boundary, which grows until it has settled: a token sequence
is the encoding of its bytes exactly if each two neighbours are the encoding of theirs. So once the pairs at both ends of
the window hold, no token outside can change. A string is encoded by halves, recursively; decoding
joins the bytes of the ids up the same tree.

Texts are split by the pattern first, and each match is encoded alone. Matches are looked up in a bounded
memory of each Python worker: words repeat, and what is not in memory is encoded again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.common import computed, table, text_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes below which a string is encoded in one go.
LEAF = 24
#: Matches and chunks a worker remembers at most, and the longest that it remembers (bytes or characters).
REMEMBERED, LONGEST = 300_000, 64
#: What the pattern's \s matches: the characters of Unicode's White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A chunk that no match of the pattern crosses: non-spaces with one blank before, or white space.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class Codec:
    """Encodes and decodes by the ranks in a file of base64 tokens and ranks."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern.replace(r"\s", f"[{SPACE}]").replace(f"[^[{SPACE}]", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]"))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._chunks: dict[str, bytes] = {}
        self._matches: dict[str, bytes] = {}

    def leaf(self, data: bytes) -> list[int]:
        """By the merge of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        parts = [data[i:i + 1] for i in range(len(data))]
        found = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, rank in enumerate(found):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at] += parts.pop(at + 1)
            found.pop(at)
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def settled(self, left: int, right: int) -> bool:
        """Do two tokens stay apart when they meet?"""
        known = self._pairs.get((left, right))
        if known is None:
            known = self.leaf(self.tokens[left] + self.tokens[right]) == [left, right]
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The product of two encodings."""
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        a = b = 1  # tokens of the window on each side
        while True:
            window = self.leaf(b"".join(self.tokens[t] for t in left[len(left) - a:] + right[:b]))
            left_holds = a == len(left) or self.settled(left[-a - 1], window[0])
            right_holds = b == len(right) or self.settled(window[-1], right[b])
            if left_holds and right_holds:
                return left[:len(left) - a] + window + right[b:]
            a = a if left_holds else min(2 * a, len(left))
            b = b if right_holds else min(2 * b, len(right))

    def encode_bytes(self, data: bytes) -> list[int]:
        """The encoding of one match: a reduction over a balanced tree of leaves."""
        level = [self.leaf(data[i:i + LEAF]) for i in range(0, len(data), LEAF)]
        while len(level) > 1:
            level = [self.join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0] if level else []

    def _match(self, text: str) -> bytes:
        packed = np.array(self.encode_bytes(text.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(text) <= LONGEST:
            if len(self._matches) >= REMEMBERED:
                self._matches.clear()
            self._matches[text] = packed
        return packed

    def _chunk(self, text: str) -> bytes:
        known, matches = self._matches.get, self.pattern.findall(text)
        packed = b"".join([known(m) or self._match(m) for m in matches])
        if len(text) <= LONGEST:
            if len(self._chunks) >= REMEMBERED:
                self._chunks.clear()
            self._chunks[text] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known = self._chunks.get
        return b"".join([known(c) or self._chunk(c) for c in CHUNK.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids, joined pairwise up the tree."""
        level = list(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        while len(level) > 1:  # 256 children to a node: each byte is copied once a level
            level = [b"".join(level[i:i + 256]) for i in range(0, len(level), 256)]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def codec(path: str = RANKS) -> Codec:
    """One codec for each worker and vocabulary."""
    return Codec(path)


def encode(docs: DataFrame, path: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit), one row per document; null text counts as empty.

    Empty texts have no ids. Null and repeated doc_ids pass. Extra columns are not read.
    """
    def work():
        own = codec(path)
        return lambda texts: {"ids": pa.array([own.encode(t) for t in texts], pa.binary())}

    return computed(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), "text", work, "ids binary")


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, ids and bytes (binary) of encoded documents."""
    def work():
        own = codec(path)
        return lambda ids: {"bytes": pa.array([own.decode(x) for x in ids], pa.binary())}

    return computed(encoded.select("doc_id", "ids", F.col("ids").alias("__ids")), "__ids", work, "bytes binary")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id", F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def expected(text: str, path: str = RANKS) -> tuple[int, str, str]:
    """What the tiktoken library gives for a text: for tests."""
    import tiktoken

    own = codec(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    ids = library.encode_ordinary(text)
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()
