"""Deobfuscation against exhaustive reading, counts against a plain count, held-out accuracy."""

import itertools
import os
import random
import time

import numpy as np
import pytest

from tenure.llm import toxicity as x
from tests.conftest import TESTDATA

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, quality int, toxic int"


def counts(texts):
    out = np.zeros(x.N ** 3, int)
    for t in texts:
        s = [x.CODE.get(c, x.OTHER) if c.isalpha() else 0 for c in f" {t.lower()} "]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            out[(a * x.N + b) * x.N + c] += 1
    return out


@pytest.fixture(scope="module")
def model():
    words = ["idiot", "stupid", "trash", "loser", "pathetic", "worthless", "moron", "scum", "the", "apple", "letter", "butter", "house", "people", "cooking", "street"]
    rng = random.Random(1)
    n = counts([" ".join(rng.choices(words, k=400))])
    return x.LanguageModel(enumerate(n))


def test_counts_of_whole_texts(spark, frame):
    texts = [None, "", "a", "Été", "ab c" * 700_000, "日本 x", "ab", "ab"]
    got = {r.place: r.n for r in x.trigram_counts(frame([(i, t, "") for i, t in enumerate(texts)], DOCS)).collect()}
    # Blocks of a very long text read two boundary symbols more at each seam.
    want = counts([t or "" for t in texts])
    for place, n in enumerate(want):
        assert abs(got.get(place, 0) - n) <= 6
    short = {r.place: r.n for r in x.trigram_counts(frame([(1, "Été à l'eau", ""), (2, "bb", "")], DOCS)).collect()}
    assert short == {i: n for i, n in enumerate(counts(["Été à l'eau", "bb"])) if n}


@pytest.mark.parametrize("raw, clean", [
    ("1d10t", "idiot"), ("stuuupid", "stupid"), ("s t u p i d", "stupid"), ("tr@sh", "trash"), ("l.o.s.e.r", "loser"), ("p4th3t1c", "pathetic"), ("worthle$$", "worthless"),
    ("M0R0N!!", "moron!!"), ("letter", "letter"), ("apple,", "apple,"), ("12.5", "12.5"), ("", ""), ("the s c u m", "the scum")])
def test_restored(model, raw, clean):
    assert x.Reader(model).restore(raw) == clean


@pytest.mark.parametrize("raw, clean", [
    ("iidiioott", "idiot"), ("stuupid", "stupid"), ("sstupid", "stupid"), ("id-iot", "idiot"), ("st.up.id", "stupid"), ("tr_ash", "trash"), ("lo--ser", "loser"),
    ("s  t  u  p  i  d", "stupid"), ("m\to\tr\to\tn", "moron"), ("the s\nc\nu\nm", "the scum"), ("letter  butter", "letter  butter"), ("the  1", "the  1")])
def test_restored_wherever_there_is_another_reading(model, raw, clean):
    assert x.Reader(model).restore(raw) == clean


def test_viterbi_is_the_best_of_all_readings(model):
    def total(pairs):
        a, b, score = 0, 0, 0.0
        for c, p in pairs:
            score += p
            if c is not None:
                s = x.CODE.get(c, x.OTHER) if c.isalpha() else 0
                score += 0.0 if s == 0 and b == 0 else float(model.log[a, b, s])
                a, b = b, s
        return score + (float(model.log[a, b, 0]) if b else 0.0)

    rng = random.Random(2)
    for _ in range(60):
        raw = "".join(rng.choices("idot1034$. l", k=rng.randrange(1, 8)))
        best = max(total(p) for p in itertools.product(*x.readings(raw)))
        read = x.viterbi(raw, model)
        assert any("".join(c for c, _ in p if c) == read and abs(total(p) - best) < 1e-4 for p in itertools.product(*x.readings(raw)))


def test_learned_from_labels(spark, frame):
    rng = random.Random(3)
    plain = ["the", "house", "street", "apple", "letter", "people"]
    rows, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        words = rng.choices(plain, k=20) + (["moron"] if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words) + f" {i}", "clash"))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, "the house m0r0n people", ""), (2001, "the house m o r o n people", ""), (2002, None, ""), (2003, "", ""), (2004, "house " * 50_000, ""), (None, "the moron", ""), (5, rows[5][1], "")]
    docs = frame(rows, DOCS)
    model, fitted = x.fit(docs, frame([*labels, (9, 0, None), (None, 0, 1)], LABELS))
    got = x.score(docs, model, fitted).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    assert all(by[i] == t for i, _, t in labels) and by[2000] == by[2001] == by[None] == 1 and by[2002] == by[2003] == by[2004] == 0
    kept = x.drop_toxic(docs, frame(labels, LABELS))
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_no_rows_or_labels(spark, frame):
    docs, none = frame([(1, "a b", "")], DOCS), frame([], LABELS)
    model, fitted = x.fit(docs, none)
    assert [r.predicted for r in x.score(docs, model, fitted).collect()] == [0]
    assert x.drop_toxic(docs.limit(0), none).count() == 0


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="needs the driver's test tables")
def test_held_out_accuracy(spark):
    sf = TESTDATA.replace("sf0.001", "sf0.1")
    got = x.op6_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit >= 0.85 * sum(r.toxic for r in got) and hit >= 0.9 * sum(r.predicted for r in got)


def test_long_words_take_linear_time(model):
    """A million characters of each kind that once took quadratic time."""
    rng = random.Random(4)
    reader = x.Reader(model)
    for text in ("abc" * 350_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "a" + "." * 1_000_000 + "b", "日本語" * 350_000, "a" * 1_000_000, "!" * 1_000_000 + "a", "a.-" * 2 + "-_" * 500_000):
        started = time.process_time()
        reader.restore(text)
        assert time.process_time() - started < 3, text[:10]


def test_every_character_counts_in_long_runs(model):
    """The short cuts for runs find what the lattice character by character finds."""
    rng = random.Random(5)

    def slow(raw):
        states = {(0, 0): 0.0}
        for options in x.readings(raw):
            after = {}
            for (a, b), score in states.items():
                for c, channel in options:
                    s = None if c is None else x._code(c)
                    key = (a, b) if s is None else (b, s)
                    step = 0.0 if s is None or (s == 0 and b == 0) else float(model.log[a, b, s])
                    after[key] = max(after.get(key, -1e9), score + channel + step)
            states = after
        return max(v + (float(model.log[a, b, 0]) if b else 0.0) for (a, b), v in states.items())

    def score_of(raw, read):
        """The best score of those readings of raw that give ``read``."""
        states = {(0, 0, 0): 0.0}
        for options in x.readings(raw):
            after = {}
            for (n, a, b), score in states.items():
                for c, channel in options:
                    if c is None:
                        key, value = (n, a, b), score + channel
                    elif n < len(read) and read[n] == c:
                        s = x._code(c)
                        key, value = (n + 1, b, s), score + channel + (0.0 if s == 0 and b == 0 else float(model.log[a, b, s]))
                    else:
                        continue
                    after[key] = max(after.get(key, -1e9), value)
            states = after
        return max(v + (float(model.log[a, b, 0]) if b else 0.0) for (n, a, b), v in states.items() if n == len(read))

    for _ in range(300):
        raw = "".join(rng.choice("aaaeeissttd10$..-- ,") * rng.choice((1, 1, 1, 2, 3, 5)) for _ in range(rng.randrange(1, 9)))
        assert score_of(raw, x.viterbi(raw, model)) == pytest.approx(slow(raw), abs=1e-3), raw
