"""The pipeline on planted cases and on whole test tables: each stage against a plain account of what it must do."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tests.conftest import TESTDATA
from tests.llm.test_pii import base
from tests.llm.test_simhash import roots, slow_fingerprint


def test_order():
    assert [name for name, _ in p.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


def test_planted_cases(spark, tmp_path):
    words = [f"w{i}x" for i in range(400)]
    clean = {i: " ".join(words[(i * 37 + j * (i + 3)) % 400] for j in range(120)) for i in range(60)}
    rows = {i: t for i, t in clean.items()}
    rows |= {100 + i: clean[i] + " moron" + " moron loser" * (i % 3) for i in range(30)}
    rows |= {200: clean[5], 201: clean[5].replace(" ", "  "), 202: clean[6] + " extra", 203: clean[7] + " mail me@site.example now", 204: None, 205: ""}
    labels = [(i, 1, 0) for i in clean] + [(100 + i, 0, 1) for i in range(30)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            seen[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(seen["toxicity"]) == set(rows) - set(range(100, 130))
    assert set(seen["exact_dedup"]) == set(seen["toxicity"]) - {200, 201, 205}
    fps = {i: slow_fingerprint(t or "") for i, t in seen["exact_dedup"].items()}
    keep = set(roots(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2).values())
    assert set(seen["near_dedup"]) == keep
    assert not any(base(t or "") for t in seen["pii"].values())
    assert {r.doc_id for r in docs.collect()} == keep


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="needs the driver's test tables")
def test_whole_tables(spark):
    got = p.run(spark, TESTDATA).collect()
    assert got and all(r.length <= 2048 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r["offset"], r.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_large_ids_beside_null_ids(spark, frame):
    """Ids beyond what a double holds stay whole where others are null."""
    from tenure.llm import byte_bpe, exact_dedup, html_text, packing, simhash, toxicity

    big = 2**53 + 1
    docs = frame([(big, "a b c", "x"), (None, "a b d", "x"), (big + 2, "q", "x")], "doc_id long, text string, fp string")
    ids = lambda df, c="doc_id": sorted((r[c] for r in df.collect()), key=str)
    want = sorted([big, None, big + 2], key=str)
    model = toxicity.LanguageModel([])
    fitted = toxicity.Score({}, [], -5.0)
    pages = docs.selectExpr("doc_id AS page_id", "text AS html", "fp AS url")
    for df in (exact_dedup.mark_copies(docs), exact_dedup.drop_copies(docs), simhash.near_copies(docs), byte_bpe.decode(byte_bpe.encode(docs)),
               toxicity.score(docs, model, fitted), packing.pack(docs)):
        assert ids(df) == want
    assert ids(html_text.extract(pages), "page_id") == want


def test_columns_named_like_helpers_pass_unchanged(spark, tmp_path):
    """Documents with columns of every name that a stage uses inside."""
    import re

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = set()
    for module in ("toxicity", "exact_dedup", "simhash", "pii", "packing", "common", "columns"):
        with open(f"{root}/tenure/llm/{module}.py") as f:
            names |= set(re.findall(r"[\"']([A-Za-z_]\w{0,14})[\"']", f.read()))
    names |= {"__base", "__ends", "__gone", "__again", "__low", "__key", "__sha", "__text", "__all", "__new", "__voted"}
    names = sorted({n.lower() for n in names} - {"doc_id", "text", "lang", "source", "n_chars"})
    base_text = "plain words that say nothing and mail me@site.example about it number"
    rows = [(i, f"{base_text} {i} " + " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(40)), "en", "s", 1) for i in range(12)]
    rows += [(20, rows[3][1], "en", "s", 1), (20, rows[3][1], "en", "s", 1), (None, rows[4][1], "en", "s", 1), (None, "other words", "en", "s", 1), (None, "other words", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in p.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert out.count() >= 12
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        for r in docs.collect():
            assert all(r[n] == f"own {n}" for n in names)
    assert docs.count() == 13 and all("[EMAIL]" in r.text for r in docs.where("doc_id is not null").collect())
