"""b-bit MinHash: estimates, candidates and components against brute force over full sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenure.llm import minhash as mh

SCHEMA = "doc_id long, text string"


def slow_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [slow_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                parent[find(i)] = find(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[find(i)] = min((x for x in (lowest.get(find(i)), doc_id) if x is not None), default=None)
    return sorted((doc_id, len(sets[i]), lowest[find(i)], doc_id == lowest[find(i)]) for i, (doc_id, _) in enumerate(rows))


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def family(rng, n, words, edits):
    """Texts that each differ from a base in some words, so that some pairs are just linked and some just not."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(5000)}"
        out.append(" ".join(own))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [t for words, edits, n in ((60, 6, 40), (200, 20, 40), (30, 2, 30), (400, 12, 20)) for t in family(rng, n, words, edits)]
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 50))) for _ in range(60)]
    texts += rng.sample(texts, 20) + [t.upper().replace(" ", " \n") for t in rng.sample(texts, 10)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("settings", [{}, {"STAR_ROUNDS": 0, "CELL_ROWS": 5, "SMALL_SET": 50}, {"STAR_ROUNDS": 2, "COMPARED": 3, "CELL_BYTES": 900}])
def test_components_against_full_sets(spark, frame, settings, monkeypatch):
    """By stars and cells, and by cells alone, of few rows or bytes."""
    for name, value in settings.items():
        monkeypatch.setattr(mh, name, value)
    rows = corpus(1)
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 60
    assert got(mh.near_duplicates(frame(rows, SCHEMA).repartition(3))) == want


def test_just_linked_and_just_not(spark, frame):
    """100 shingles each; 92 shared of 108 are linked (0.852), 91 of 109 are not (0.835)."""
    words = [f"w{i}" for i in range(102)]
    rows = [(5, " ".join(words)), (3, " ".join(words[8:] + [f"n{i}" for i in range(8)])), (9, " ".join(words[:-9] + [f"m{i}" for i in range(9)]))]
    assert brute(rows) == [(3, 100, 3, True), (5, 100, 3, False), (9, 100, 9, True)]
    assert got(mh.near_duplicates(frame(rows, SCHEMA))) == brute(rows)


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    for shared in (0, 500, 900):
        estimates = []
        for _ in range(60):
            x = rng.integers(0, 2 ** 64, 2000 - shared, dtype=np.uint64)
            a, b = mh.packed(mh.minima(x[:1000])), mh.packed(mh.minima(x[1000 - shared:]))
            diff = (a ^ b).view(np.uint64)
            same = mh.MINIMA - int(np.bitwise_count((diff | (diff >> np.uint64(1))) & np.uint64(mh._LOW)).sum())
            estimates.append((same / mh.MINIMA - 0.25) / 0.75)
        assert abs(np.mean(estimates) - shared / (2000 - shared)) < 0.03
        assert np.std(estimates) < 0.08


def test_bit_counts_in_sql_and_numpy_agree(spark, frame):
    rows = corpus(4)[:80]
    found = mh.signatures(frame(rows, SCHEMA), "doc_id", "text", 3).select("doc_id", *mh._INFO)
    rename = lambda p: found.select(*(F.col(c).alias(p + c) for c in found.columns))
    pairs = rename("a_").join(rename("b_"), F.col("a_doc_id") < F.col("b_doc_id")).where(mh.may_link(mh._side("a_"), mh._side("b_"), 85))
    own = {r["doc_id"]: (r["n_shingles"], np.array([r[f"s{i}"] for i in range(mh.LONGS)], np.int64).view(np.uint64)) for r in found.collect()}
    want = set()
    for i, (n, a) in own.items():
        for j, (m, b) in own.items():
            x = a ^ b
            same = mh.MINIMA - int(np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(mh._LOW)).sum())
            if i < j and same >= mh.least_matches(85) and 100 * min(n, m) >= 85 * max(n, m):
                want.add((i, j))
    assert want and {(r["a_doc_id"], r["b_doc_id"]) for r in pairs.collect()} == want


def test_edge_rows(spark, frame):
    long = " ".join(f"w{i % 30_000}" for i in range(120_000))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "one"), (5, "one two"), (6, "TWO one"), (7, "a b c"), (7, "a  b\tc"), (8, long), (9, long + " end"), (9, "a b c"), (10, "é É"), (11, "É é")]
    docs = frame(rows, SCHEMA).withColumn("c", F.lit(1)).withColumn("key", F.lit(2)).withColumn("root", F.lit(3)).withColumn("rep", F.lit("x"))
    want = brute(rows)
    assert got(mh.near_duplicates(docs)) == want
    assert mh.near_duplicates(frame([], SCHEMA)).count() == 0
    nulls = mh.near_duplicates(frame([(None, "a b c d"), (None, "a b c d"), (None, "")], SCHEMA)).collect()
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in nulls) == [(0, None, True), (2, None, True), (2, None, True)]
    mixed = mh.near_duplicates(frame([(None, "a b c d"), (4, "a b c d")], SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in mixed) == [(False, 4, True), (True, 4, False)]


def test_query_against_full_sets(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(mh.op13_minhash(spark, sf)) == brute(rows)
