"""Toxicity by noisy-channel deobfuscation.

A written word is read as a noisy copy of a clean one: letters swapped for digits and signs, set apart
by white space or separators, or repeated. Its lattice holds, at each character, what it may stand for; Viterbi finds
the reading that is likeliest under the channel and a character trigram model counted over all documents. A
word with one reading stands for itself, and so does one without letters, as numbers have none. The restored text is scored by logistic regression on its words
and their beginnings, learned from labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.common import computed, cut, slices, table, text_of

#: Letters of the model; every other letter is one more symbol, and what is no letter is the boundary, 0.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœ"
N = len(LETTERS) + 2
OTHER = N - 1
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
#: What a sign may stand for (besides itself).
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SEPARATORS = " .-_*~'"
#: Log probabilities of the channel: a sign for a letter, a sign meant as such in a word, a letter written again, a separator put in.
SWAP, MEANT, AGAIN, APART = -1.2, -8.0, -0.7, -0.7
#: Labelled rows that the score is fitted on, at most (those of the smallest hash), and words kept as features.
TRAIN_ROWS = 12_000
FEATURES = 3_000
LEAST_Z = 4.0
PREFIXES = (3, 4, 5, 6)
#: A beginning counts twice over where at least two words of a text have it, and this share of its distinct words.
OFTEN = 0.015
THRESHOLD = 0.3
#: Rows of label 1 count so many times in the fit: they are the rarer ones.
WEIGHT = 3.0
REMEMBERED, LONGEST = 200_000, 64

_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S)+(?!\S)")
#: What gives a word more than one reading: letters with signs for letters, with separators between them, or with an equal one next to them.
_LETTER, _SIGN = re.compile(r"[^\W\d_]"), re.compile(r"[0-9@$!|+€]")
_APART, _TWICE = re.compile(r"[^\W\d_][.\-_*~']++[^\W\d_]"), re.compile(r"([^\W\d_])\1")
#: Where a lattice has more than one way: a sign, separators, a letter several times in a row.
_FORKS = re.compile(r"[0-9@$!|+€]|[ .\-_*~']++|([^\W\d_])\1++")
_BLANKS = re.compile(r"\s+")
_LEAD, _TAIL = re.compile(r"[^\w@$|+€]*+"), re.compile(r"[^\w@$]*+")
_WORD = re.compile(r"[^\W\d_]+")


# --- the language model -----------------------------------------------------------------


def _code_table() -> np.ndarray:
    codes = np.zeros(0x3000, np.int32)
    for c in range(len(codes)):
        if chr(c).isalpha():
            codes[c] = CODE.get(chr(c), OTHER)
    return codes


def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """place (of three symbols), n: how often they follow one another in all texts, lower-cased; at most N^3 rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, total = _code_table(), np.zeros(N ** 3, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for at in range(0, len(text), 1 << 20):  # blocks overlap by the two symbols of the context
                    raw = np.frombuffer(f" {text[max(0, at - 1):at + (1 << 20)].lower()} ".encode("utf-32-le", "replace"), np.uint32)
                    s = np.where(raw < len(codes), codes[np.minimum(raw, len(codes) - 1)], OTHER).astype(np.int64)
                    total += np.bincount((s[:-2] * N + s[1:-1]) * N + s[2:], minlength=N ** 3)
        place = np.flatnonzero(total)
        yield pd.DataFrame({"place": place, "n": total[place]})

    counted = docs.select(text_of(text_col).alias("text")).mapInPandas(run, "place long, n long")
    return counted.groupBy("place").agg(F.sum("n").alias("n"))


class LanguageModel:
    """log P(c | a, b), by trigrams smoothed with bigrams and letters."""

    def __init__(self, counts: Iterable[tuple[int, int]]):
        n3 = np.zeros(N ** 3)
        for place, n in counts:
            n3[place] = n
        n3 = n3.reshape(N, N, N)
        n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
        p1 = (n1 + 1) / (n1.sum() + N)
        p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
        p3 = (n3 + 20 * p2) / (n3.sum(axis=2, keepdims=True) + 20)
        self.log = np.log(p3).astype(np.float32)

    @cached_property
    def flat(self) -> list[float]:
        """The same as a list, which is read faster one by one; made anew in each process."""
        return self.log.ravel().tolist()

    def __getstate__(self) -> dict:
        return {"log": self.log}


# --- the channel ------------------------------------------------------------------------


def readings(raw: str) -> list[list[tuple[str | None, float]]]:
    """The lattice: per character what it may be read as (None: nothing) and the channel's log probability."""
    out = []
    for i, c in enumerate(raw):
        if c.isalpha():
            options = [(c, 0.0)]
            before = raw[i - 1] if i else ""
            if c == before or (i > 1 and before in SEPARATORS and c == raw[i - 2]):
                options.append((None, AGAIN))
        elif c in SIGNS:
            options = [(c, MEANT), *((x, SWAP) for x in SIGNS[c])]
        elif c in SEPARATORS:
            options = [(c, 0.0), (None, APART)]
        else:
            options = [(c, 0.0)]
        out.append(options)
    return out


def has_readings(raw: str) -> bool:
    """May a word be read in more than one way?"""
    return bool(_LETTER.search(raw) and (_SIGN.search(raw) or _APART.search(raw) or _TWICE.search(raw)))


def core(raw: str) -> tuple[int, int]:
    """Where in a word its signs may stand for letters: without what opens and closes it, and without three or more equal @ or $ at its end."""
    start = _LEAD.match(raw).end()
    end = max(start, len(raw) - _TAIL.match(raw[::-1]).end())
    if end == len(raw) and raw and raw[-1] in "@$":
        before = len(raw.rstrip(raw[-1]))
        if len(raw) - before >= 3 and before and _LETTER.match(raw[before - 1]):
            end = before
    return start, end


def _code(c: str) -> int:
    return CODE.get(c, OTHER) if c.isalpha() else 0


def viterbi(raw: str, model: LanguageModel) -> str:
    """The likeliest clean reading of a lower-case string; ties keep more of what is written.

    The same lattice as ``readings``, in time linear in the string. Separators in a row are kept, kept once or dropped
    together, and of a letter n times in a row n, two, one or (after the same letter and a separator) none are kept: whatever lies between
    scores no better. Where one state is left, characters with one reading pass as they are.
    """
    log = model.flat
    # A state is the last two symbols; its value the log probability and the way there, as a chain of pieces.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}

    def fork(options: list[tuple[str, int, int, float]]) -> None:
        """Options: what is written, its symbol, how many times, the channel's log probability."""
        nonlocal states
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, way) in states.items():
            for text, s, n, channel in options:
                value = score + channel
                key = (a, b)
                if n:
                    if s or b:  # boundaries in a row count once, as between words of the model
                        value += log[(a * N + b) * N + s]
                    key = (b, s)
                    if n > 1:
                        key = (s, s)
                        if s:
                            value += log[(b * N + s) * N + s] + (n - 2) * log[(s * N + s) * N + s]
                known = after.get(key)
                if known is None or value > known[0]:
                    after[key] = (value, (way, text) if n else way)
        states = after

    def plain(text: str) -> None:
        nonlocal states
        at = 0
        while len(states) > 1 and at < len(text):
            fork([(text[at], _code(text[at]), 1, 0.0)])
            at += 1
        if at < len(text):
            ((a, b), (score, way)), = states.items()
            a, b = (b, _code(text[-1])) if len(text) - at == 1 else (_code(text[-2]), _code(text[-1]))
            states = {(a, b): (score, (way, text[at:]))}

    def letters(c: str, n: int, at: int) -> None:
        droppable = at > 1 and raw[at - 1] in SEPARATORS and raw[at - 2] == c
        s = _code(c)
        kept = [n, *(k for k in (2, 1) if k < n), *([0] if droppable else [])]
        fork([(c * k, s, k, (n - k) * AGAIN) for k in kept])

    def between(start: int, end: int) -> None:
        if start < end and start > 1 and raw[start - 1] in SEPARATORS and raw[start] == raw[start - 2] and raw[start].isalpha():
            letters(raw[start], 1, start)
            start += 1
        plain(raw[start:end])

    done = 0
    for m in _FORKS.finditer(raw):
        c, n = m.group(0)[0], len(m.group(0))
        if m.group(1) and not c.isalpha():
            continue
        between(done, m.start())
        if m.group(1):
            letters(c, n, m.start())
        elif c in SIGNS:
            fork([(c, 0, 1, MEANT), *((x, _code(x), 1, SWAP) for x in SIGNS[c])])
        else:
            fork([(m.group(0), 0, n, 0.0), *([(c, 0, 1, (n - 1) * APART)] if n > 1 else []), ("", 0, 0, n * APART)])
        done = m.end()
    between(done, len(raw))
    best = max(states.items(), key=lambda x: x[1][0] + (log[(x[0][0] * N + x[0][1]) * N] if x[0][1] else 0.0))[1][1]
    pieces = []
    while best:
        best, text = best
        pieces.append(text)
    return "".join(reversed(pieces))


class Reader:
    """Restores words, remembering some; and what a word counts as."""

    def __init__(self, model: LanguageModel, features: dict[str, int] | None = None):
        self.model, self.features = model, features
        self._words: dict[str, str] = {}
        self._ids: dict[str, tuple[int, ...]] = {}
        # Beginnings that count only where often met have places below zero.
        self.places = dict(features or {})
        self.often = {}
        for f, i in (features or {}).items():
            if f[-1] == "+":
                place = self.places.setdefault(f[:-1], -1 - i)
                self.often[place] = i

    def word(self, raw: str) -> str:
        """One word, without blanks, as restored."""
        if not has_readings(raw):
            return raw
        known = self._words.get(raw)
        if known is None:
            start, end = core(raw)
            known = self._remember(raw, raw[:start] + viterbi(raw[start:end], self.model) + raw[end:])
        return known

    def spaced(self, lower: str) -> list[tuple[int, int, str]]:
        """Runs of single characters set apart by white space: where, and as read."""
        return [(m.start(), m.end(), self.word_run(m.group(0))) for m in _SPACED.finditer(lower)]

    def word_run(self, raw: str) -> str:
        """A run, its stretches of white space read as one blank each; as written where the reading joins nothing."""
        even = _BLANKS.sub(" ", raw)
        known = self._words.get(even)
        if known is None:
            known = self._remember(even, viterbi(even, self.model))
        return raw if known == even else known

    def _remember(self, raw: str, read: str) -> str:
        if len(raw) <= LONGEST:
            if len(self._words) >= REMEMBERED:
                self._words.clear()
            self._words[raw] = read
        return read

    def restore(self, text: str) -> str:
        """The lower-cased text with each word as restored; white space stays."""
        lower, parts, at = text.lower(), [], 0
        for start, end, read in self.spaced(lower):
            parts += [self._plain(lower[at:start]), read]
            at = end
        return "".join([*parts, self._plain(lower[at:])])

    def _plain(self, text: str) -> str:
        return re.sub(r"\S+", lambda m: self.word(m.group(0)), text)

    def _words_of(self, text: str, known: dict, found_in) -> Counter:
        """How many distinct words of a text have each feature, and at None how many distinct words there are."""
        lower, counts = text.lower(), Counter()
        words = set(lower.split())
        for _, _, read in self.spaced(lower):
            counts.update(found_in(read))
        for w in words:
            got = known.get(w)
            if got is None:
                got = found_in(self.word(w))
                if len(w) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = got
            if got:
                counts.update(got)
        counts[None] = len(words)
        return counts

    def names(self, text: str) -> set[str]:
        """Features of a text: its restored words, their beginnings, and which beginnings are often met."""
        counts = self._words_of(text, {}, names)
        often = max(2, OFTEN * counts.pop(None))
        return {*counts, *(f + "+" for f, n in counts.items() if n >= often and f[0] == "^")}

    def ids(self, text: str) -> set[int]:
        """Of ``names``, the ids of those that count."""
        counts = self._words_of(text, self._ids, self._known)
        often = max(2, OFTEN * counts.pop(None))
        found = {i for i in counts if i >= 0}
        found.update(self.often[i] for i, n in counts.items() if n >= often and i in self.often)
        return found

    def _known(self, restored: str) -> tuple[int, ...]:
        return tuple({i for f in names(restored) if (i := self.places.get(f)) is not None})


def names(restored: str) -> set[str]:
    """Words of restored text, and their beginnings marked by a caret."""
    found = set()
    for w in _WORD.findall(restored):
        found.add(w)
        found.update("^" + w[:n] for n in PREFIXES if len(w) > n)
    return found


# --- the score --------------------------------------------------------------------------


class Score:
    """Weights of features and a bias."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def of(self, ids: Iterable[int]) -> float:
        # summed in one order, so that equal texts score equally everywhere
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + math.fsum(self.weights[i] for i in ids)))))


def fit_logistic(ids: list, labels: np.ndarray, n: int, rounds: int = 300, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of ids with a quadratic penalty, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    col = np.fromiter((i for x in ids for i in x), np.int64, len(row))
    size = 1 + max(1, max((len(x) for x in ids), default=1))
    share = np.where(labels > 0, WEIGHT, 1.0)
    share /= share.sum()
    weights = np.zeros(n + 1)
    weights[-1] = math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    ahead, momentum, rate = weights.copy(), 1.0, 8.0 / size ** 0.5
    for _ in range(rounds):
        z = np.bincount(row, ahead[col], len(ids)) + ahead[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        error *= share
        gradient = np.append(np.bincount(col, error[row], n), error.sum())
        gradient[:-1] += decay * ahead[:-1]
        after = ahead - rate * gradient
        nextm = (1 + math.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = after + (momentum - 1) / nextm * (after - weights)
        weights, momentum = after, nextm
    return weights[:-1], float(weights[-1])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, model: LanguageModel) -> Score:
    """A score from labelled documents that are not held out, at most TRAIN_ROWS of them, equal texts once.

    Of several labels of one id the largest counts; null labels and labels of unknown ids don't. Without documents
    of both labels, every text scores the share of label 1 (0 without any).
    """
    known = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("labelled"), "labelled").limit(TRAIN_ROWS)  # small enough to send to every task
    rows = docs.select(F.col("doc_id"), text_of().alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    rows = cut(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, seen = Reader(model), (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(toxic)].update(reader.names(text))
        every = list({*seen[0], *seen[1]})
        for at in range(0, len(every), 50_000):
            part = every[at:at + 50_000]
            yield pd.DataFrame({"feature": part, "n0": [seen[0][f] for f in part], "n1": [seen[1][f] for f in part]})

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Score({}, np.zeros(0), 30.0 if n1 else -30.0)
    counted = rows.mapInPandas(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = (F.col("n0") + F.col("n1")) / (n0 + n1)
    spread = F.greatest(share * (1 - share) * (1 / n0 + 1 / n1), F.lit(1e-12))  # a feature of all documents has none
    z = (F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(spread)
    kept = counted.where(F.abs(z) >= LEAST_Z).orderBy(F.desc(F.abs(z)), "feature").limit(FEATURES).select("feature").collect()
    features = {r["feature"]: i for i, r in enumerate(kept)}

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model, features)
        for batch in batches:
            yield pd.DataFrame({"ids": [sorted(reader.ids(t)) for t in batch["text"]], "toxic": batch["toxic"], "key": batch["key"]})

    marked = rows.withColumn("key", F.xxhash64("text")).mapInPandas(mark, "ids array<int>, toxic int, key long").toPandas()  # at most TRAIN_ROWS
    marked = marked.sort_values("key", kind="stable")
    weights, bias = fit_logistic([list(x) for x in marked["ids"]], marked["toxic"].to_numpy(float), len(features))
    return Score(features, weights, bias)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[LanguageModel, Score]:
    counts = trigram_counts(docs).toPandas()  # at most N^3 rows, whatever the corpus
    model = LanguageModel(zip(counts["place"], counts["n"], strict=True))
    return model, train(docs, labels, model)


def score(docs: DataFrame, model: LanguageModel, fitted: Score, columns: tuple[str, ...] = ("doc_id",), restored: bool = False) -> DataFrame:
    """The columns of each document, its score (0 to 1) and predicted (1 from THRESHOLD on); the restored text if asked for.

    Null text counts as empty; texts without known words score the bias. Repeated rows each get a row. Only the text counts.
    """
    def work():
        reader = Reader(model, fitted.features)

        def judged(texts: list) -> dict[str, pa.Array]:
            scores = [fitted.of(sorted(reader.ids(t))) for t in texts]
            out = {"score": pa.array(scores, pa.float64()), "predicted": pa.array([int(x >= THRESHOLD) for x in scores], pa.int32())}
            return out | ({"restored": pa.array([reader.restore(t) for t in texts], pa.string())} if restored else {})
        return judged

    return computed(docs.select(*columns, text_of().alias("__text")), "__text", work, "score double, predicted int" + ", restored string" * restored)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, whole rows, whose text is not predicted toxic."""
    model, fitted = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model, fitted.features)
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([fitted.of(sorted(reader.ids(t or ""))) < THRESHOLD for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, fitted = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.withColumn("held_out", held_out()), model, fitted, ("doc_id", "held_out"))
