"""Personal data: base spans against plain matching, estimated reliabilities, added spans, redaction."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tenure.llm import pii
from tests.conftest import plan_text

DOCS = "doc_id long, text string, spans string"
#: The base patterns as the contract has them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


def base(text):
    found = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            s, number = m.group(0), re.sub("[^0-9]", "", m.group(0))
            holds = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in s.split(".")),
                     "card": lambda: 14 <= len(number) <= 19 and luhn(number), "phone": lambda: 10 <= len(number) <= 15}[kind]
            if holds():
                found.append((m.start(), n, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


HOSTILE = [
    "", "a@b.c", "a@b", "x@y.z@w.v.u", "a@b.com_c@d.org", "..@-.-", "é@b.com ü", "😀😀 me@host.example 😀 1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 001.02.3.0255",
    "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111111111111111", "+1 (826) 555-4081 190.137.223.204", "+49 30 1234567", "+1", "++123456789012", "+1-234-567-8901.",
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "1" * 30_000, "a" * 30_000 + "@", "a@" + "b." * 20_000 + "c", "+" + "1 " * 20_000, "x" * 20_000 + " 4111111111111111 " + "y" * 20_000, "1." * 20_000 + "1",
    "call +1 212 555 0100 or mail bob@example.com\nfrom 10.0.0.1", None,
]


def test_base_spans(spark, frame):
    rng = random.Random(1)
    parts = ["a", "@", ".", "b.com", "1", "23", "4111111111111111", " ", "-", "+", "(", ")", "_", "%", "é", "255", "256", "\n", "😀", "4", "0"]
    texts = HOSTILE + ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(600)]
    docs = frame([(i, t, "") for i, t in enumerate(texts)], DOCS)
    for r in pii.find(docs).collect():
        want = base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(w.startswith(k) for w in want) for k in PLAIN]


def test_reliabilities_are_recovered():
    """Votes drawn with known rates: the likelihoods separate data from none, and the classifier follows them."""
    rng, counts, truth = random.Random(2), {}, {}
    for _ in range(4000):
        y = rng.random() < 0.4
        votes = tuple(rng.choices((1, -1, 0), ((0.7, 0.1, 0.2) if y else (0.1, 0.5, 0.4)))[0] for _ in pii.LABELERS)
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    patterns = [pii.Pattern(3, v, n) for v, n in sorted(counts.items())]
    likely = pii.estimate(patterns)
    right = sum(sum((q > 0.5) == y for y in truth[p.votes]) for p, q in zip(patterns, likely, strict=True))
    assert right >= 0.95 * 4000
    weights = pii.fit_classifier(patterns, likely)
    agree = 0
    for p, q in zip(patterns, likely, strict=True):
        total = weights["kind:3"] + sum(weights[f"{name}:{v}"] for name, v in zip(pii.LABELERS, p.votes, strict=True) if v)
        agree += p.n * ((total > 0) == (q > 0.5))
    assert agree >= 0.95 * 4000


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"call +1 (212) 555-{i:04d} now or mail u{i}@example.com from 10.0.{i % 250}.1 with card 4111111111111111 thanks", "") for i in range(120)]
    rows += [(1000 + i, f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}" version 12{i:03d}', "") for i in range(40)]
    rows += [(2000, "phone +1 (826) 555-4081 190.137.223.204 here", ""), (2001, None, ""), (2002, "", ""), (2000, "plain words", ""), (None, "mail a@b.com", "")]
    return spark.createDataFrame(rows, DOCS)


def test_added_spans(corpus):
    got = {}
    for r in pii.find(corpus).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all("secret:9:49" in got[1000 + i][0].spans for i in range(40))
    assert {r.spans for r in got[2000]} == {"phone:6:23,ip:24:39", ""} and got[2001][0].spans == got[2002][0].spans == ""
    assert len(got[2000]) == 2 and got[None][0].n_email == 1


def test_redaction(corpus):
    wide = corpus.withColumn("n_chars", F.length("text"))
    out = pii.redact(wide)
    assert out.columns == wide.columns and out.schema == wide.schema
    texts = {r.doc_id: r for r in out.where("doc_id <> 2000").collect()}
    assert texts[3].text == "call [PHONE] now or mail [EMAIL] from [IP] with card [CARD] thanks" and texts[3].n_chars == len(texts[3].text)
    assert texts[1000].text == 'token = "[SECRET]" version 12000' and texts[2001].text is None and texts[2002].text == ""
    assert sorted(r.text for r in out.where("doc_id = 2000").collect()) == ["phone [PHONE] [IP] here", "plain words"]


def test_overlaps_and_empty(spark, frame):
    docs = frame([(1, "+4111 1111 1111 111 1", ""), (2, "4111111111111111@example.com é", "")], DOCS)
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()}[2] == "[EMAIL] é"
    assert pii.find(docs.where("doc_id > 5")).count() == 0 and pii.redact(docs.where("doc_id > 5")).count() == 0
    assert "Python" not in plan_text(pii.find(docs)) and "Python" not in plan_text(pii.redact(docs))


def test_work_follows_the_text_and_its_spans(spark, frame):
    """A text with ten times the phones takes about ten times as long, at any place of them."""
    import time

    def seconds(n):
        text = "é".join(f" call +1 (212) 555-{i % 10_000:04d} or 212-555-{i % 10_000:04d} and a{i}@b.com" for i in range(n))
        docs = frame([(1, text, "")], DOCS)
        started = time.time()
        r = pii.find(docs).collect()[0]
        assert r.n_phone == n and r.n_email == n
        assert pii.redact(docs).collect()[0].text.count("[PHONE]") >= n
        return time.time() - started

    seconds(100)
    small, large = seconds(1_000), seconds(10_000)
    assert large < 25 * small + 20
