"""Exact dedup against a plain count, the index under insertion, deletion and overflow."""

import hashlib
import random
import re

from tenure.llm.exact_dedup import (
    CuckooIndex,
    build_index,
    digests,
    drop_copies,
    mark_copies,
    update_index,
)


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_index_inserts_finds_deletes_and_grows():
    index = CuckooIndex(width=2)
    for i in range(5000):
        assert index.find(digest(i)) is None
        index.insert(digest(i), i)
    assert index.resizes > 0 and index.size == 5000
    assert all(index.find(digest(i)) == [digest(i), i] for i in range(5000))
    assert all(index.delete(digest(i)) for i in range(0, 5000, 2))
    assert not index.delete(digest(0))
    assert [i for i in range(5000) if index.find(digest(i))] == list(range(1, 5000, 2))
    assert sum(map(len, index.filter)) == 2500


def test_a_hit_of_the_filter_is_verified():
    index = CuckooIndex()
    index.insert(digest(1), "x")
    same_print = digest(1)[:16] + b"\0" * 16
    assert index.find(same_print) is None


ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (1, " a b"), (None, "a b"), (None, None), (7, ""), (8, "a b "),
    (11, "x" * 100_000), (12, "x" * 100_000), (20, "q"), (20, "q"), (21, "q"), (22, "a b"),
]


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[ \t-\r]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not kept, hashlib.sha256(t.encode()).hexdigest()))
            kept |= i == keep
    return sorted(out, key=repr)


def test_marks(spark, frame):
    docs = frame([(i, t, "z") for i, t in ROWS], "doc_id long, text string, keep_id string")
    assert sorted((tuple(r) for r in mark_copies(docs).collect()), key=repr) == expected(ROWS)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in expected(ROWS))
    assert {r[0] for r in kept.collect()} == {r[0] for r in expected(ROWS) if r[3]}


def test_no_rows(spark, frame):
    docs = frame([], "doc_id long, text string")
    assert mark_copies(docs).count() == 0 and drop_copies(docs).count() == 0


def test_many_copies_in_many_tasks(spark, frame):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(300)}") for i in range(3000)]
    docs = frame(rows, "doc_id long, text string").repartition(13)
    assert sorted((tuple(r) for r in mark_copies(docs).collect()), key=repr) == expected(rows)


def test_updates(spark, frame):
    old = digests(frame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "doc_id long, text string"))
    index = build_index(old, n_buckets=8)
    added = digests(frame([(9, "c"), (10, "d")], "doc_id long, text string"))
    removed = digests(frame([(3, "b"), (1, "a"), (50, "never")], "doc_id long, text string"))
    after = {bytes(r.digest): (r.keep_id, r.n_rows) for r in update_index(index, added, removed, n_buckets=8).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    assert after == {sha("a"): (None, 1), sha("c"): (4, 2), sha("d"): (10, 1)}
