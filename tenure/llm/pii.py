"""Personal data by weak supervision, in DataFrame functions only.

Base patterns (e-mail, ip, card, phone) find spans that always count. Wider patterns find candidates
besides. On every span, base or candidate, labelers vote for, against or not at all: patterns and check digits, gazetteers
of codes and endings, and the words around it. Expectation-maximisation over the vote patterns of all documents
estimates how reliable each labeler is and how likely each pattern is personal data; on these likelihoods a logistic span
classifier is trained, and candidates that it accepts are added to the base spans.

Vote patterns are counted on Spark; there are at most 3^labelers of them per kind, however large the
corpus, so their counts fit the driver.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.columns import chunks, cut_out, let, nested, running
from tenure.llm.common import cut, table, text_of

#: Kinds in the order in which spans of one start are listed; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4
#: The base patterns, written so that a long run of characters is read once: possessive where nothing that follows could
#: use what they give back, and begun only where a run begins or the last match ended.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Where a base pattern can't match, it is not tried.
NEEDED = (r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){13}", r"\+[0-9]")
#: Wider patterns: number of the kind, what must occur, pattern.
WIDER = (
    (0, r"(?i)[\[( ]at[\]) ]", r"(?i)(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{2,63}+){1,5}"),
    (2, r"[0-9](?:[\x20-]?[0-9]){11}", r"(?<![0-9])[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{1,4}(?![0-9])"),
    (3, r"[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}", r"(?<![A-Za-z0-9+])(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![A-Za-z0-9])"),
    (4, r"(?i)(?:token|secret|passw|key)", r"(?i)(?<=(?:token|secret|password|passwd|key)[\x20]{0,3}[=:][\x20]{0,3}[\"']{0,1})[A-Za-z0-9_-]{16,}"),
)
#: Gazetteers, fixed values: endings of hosts, country codes of phones, first digits of cards.
ENDINGS = "com net org edu gov info io de fr es it uk eu ch at nl be pl ru cn jp br in us ca au"
DIAL = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
#: Words nearby that speak for a kind, and against any.
NEAR = (r"(?i)(?:e-?mail|contact|write|reach)", r"(?i)(?:\bip\b|host|server|address|from|login)", r"(?i)(?:card|visa|credit|payment|iban|konto)",
        r"(?i)(?:call|phone|tel|mobile|fax|ring|sms)", r"(?i)(?:token|secret|passw|key|auth)")
AGAINST = r"(?i)(?:version|isbn|page|section|figure|order|invoice|serial|uuid|hash|sum|total|\bno\.)"
#: Characters looked at on either side.
AROUND = 40
LABELERS = ("base", "check", "shape", "gazetteer", "context", "against", "border")
ACCEPT = 0.5

_EMPTY = "array<struct<start:int,end:int,kind:int,s:string>>"


def matches(text: Column, pattern: str, kind: int, holds) -> Column:
    """Spans (start, end, kind, s) of the leftmost non-overlapping matches, by code points, of which ``holds`` is true.

    The pieces between matches, from a split at the same pattern, tell where each match begins: running
    totals of lengths, so that work follows the text and its matches.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def spans(s: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(s))
        ends = running(F.zip_with(s, between, lambda x, gap: F.length(x) + F.length(gap)), lambda a, b: a + b)
        every = F.zip_with(s, ends, lambda x, end: F.struct((end - F.length(x)).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x.alias("s")))
        return F.filter(every, lambda x: holds(x["s"]))

    return let(found, spans)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Do the digits of s pass the check of card numbers?"""
    d = F.split(F.reverse(digits(s)), "")
    value = F.transform(d, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(F.pmod(x.cast("int") * 2, F.lit(10)) + F.floor(x.cast("int") * 2 / 10)).cast("int"))
    return F.pmod(F.aggregate(value, F.lit(0), lambda a, x: a + x), F.lit(10)) == 0


def _sized(s: Column, low: int, high: int) -> Column:
    return F.length(digits(s)).between(low, high)


def valid_card(s: Column) -> Column:
    return F.when(_sized(s, 14, 19), luhn(s)).otherwise(False)


def valid_ip(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


HOLDS = (lambda s: F.lit(True), valid_ip, valid_card, lambda s: _sized(s, 10, 15))


def _spans(text: Column, kind: int, need: str, pattern: str, holds) -> Column:
    return F.when(text.rlike(need), matches(text, pattern, kind, holds)).otherwise(F.lit([]).cast(_EMPTY))


def base_spans(text: Column) -> list[Column]:
    """Spans of the base patterns, an array for each kind."""
    return [_spans(text, k, need, p, h) for k, (p, need, h) in enumerate(zip(PATTERNS, NEEDED, HOLDS, strict=True))]


def wider_spans(text: Column) -> dict[int, Column]:
    return {k: _spans(text, k, need, p, lambda s: F.lit(True)) for k, need, p in WIDER}


def apart(wider: Column, base: Column) -> Column:
    """The spans of ``wider`` that overlap none of ``base``.

    Both in one list, wider spans by their end and base spans by their start: of the base spans before a wider one in it, none
    may end after that begins.
    """
    places = F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("is_base"), b["end"].alias("end"), F.struct(b["start"], b["end"], b["kind"], b["s"]).alias("x"))),
        F.transform(wider, lambda w: F.struct(w["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(0).alias("end"), F.struct(w["start"], w["end"], w["kind"], w["s"]).alias("x"))),
    )

    def free(both: Column) -> Column:
        latest = running(F.transform(both, lambda e: e["end"]), F.greatest)
        kept = F.filter(F.zip_with(both, latest, lambda e, top: F.struct(e.alias("e"), top.alias("top"))), lambda p: (p["e"]["is_base"] == 0) & (p["top"] <= p["e"]["x"]["start"]))
        return F.array_sort(F.transform(kept, lambda p: p["e"]["x"])).cast(_EMPTY)

    some = (F.size(wider) > 0) & (F.size(base) > 0)
    return F.when(some, let(F.array_sort(places), free)).otherwise(wider)


def votes(parts: Column, span: Column, is_base: Column) -> Column:
    """What each labeler says of a span of a text in chunks: 1 for, -1 against, 0 nothing."""
    around = F.struct(cut_out(parts, span["start"] - AROUND, F.lit(AROUND)).alias("before"), cut_out(parts, span["end"], F.lit(1)).alias("after"))
    return let(around, lambda x: _says(span, is_base, x["before"], x["after"]))


def _says(span: Column, is_base: Column, before: Column, after: Column) -> Column:
    s, kind = span["s"], span["kind"]
    say = lambda yes, no=None: F.when(yes, 1).when(F.lit(False) if no is None else no, -1).otherwise(0)
    by_kind = lambda *says: F.coalesce(*(F.when(kind == k, x) for k, x in enumerate(says)), F.lit(0))
    near = F.coalesce(*(F.when(kind == k, before.rlike(p)) for k, p in enumerate(NEAR)))
    last = F.lower(F.regexp_extract(s, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    code = F.regexp_extract(s, r"^\+([0-9]{1,3})", 1)
    return F.struct(
        say(is_base).alias("base"),
        by_kind(F.lit(0), say(valid_ip(s), ~valid_ip(s)), say(valid_card(s), ~valid_card(s)), say(_sized(s, 10, 15), ~_sized(s, 10, 15)),
                say(s.rlike("[0-9]") & s.rlike("[A-Za-z]"), ~s.rlike("[0-9]"))).alias("check"),
        by_kind(say(s.rlike(r"^[A-Za-z0-9][^@]*@[^@]+\.[A-Za-z]{2,}$"), s.rlike(r"\.[0-9]+$")), say(~s.rlike(r"^0|\.0[0-9]"), s.rlike(r"^0|\.0[0-9]")),
                say(s.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})$")), say(s.rlike(r"^\+|\(|[.-]"), s.rlike("^[0-9]+$")), say(s.rlike("^[0-9A-Fa-f]{32,}$"))).alias("shape"),
        by_kind(say(last.isin(ENDINGS.split()), ~last.isin(ENDINGS.split())), say(s.rlike(r"^(?:10|127|172|192)\.")), say(digits(s).rlike(ISSUERS), ~digits(s).rlike(ISSUERS)),
                say(code.isin(DIAL.split()) | F.substring(code, 1, 1).isin("1", "7") | F.substring(code, 1, 2).isin(DIAL.split())), F.lit(0)).alias("gazetteer"),
        say(near).alias("context"),
        say(F.lit(False), before.rlike(AGAINST)).alias("against"),
        say(F.lit(False), before.rlike(r"[A-Za-z0-9_]$") & (kind != 0) | after.rlike("[A-Za-z0-9_]")).alias("border"),
    )


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents as one column row, their text, base (spans) and voted (spans with their votes): base spans first, then candidates that no base span of their kind overlaps."""
    found = nested(docs, text=text_of(text_col))
    text = F.col("text")
    found = found.withColumns({f"base{k}": x for k, x in enumerate(base_spans(text))} | {f"wider{k}": x for k, x in wider_spans(text).items()})
    base = F.concat(*(F.col(f"base{k}") for k in range(BASE)))
    wider = F.concat(*(apart(F.col(f"wider{k}"), F.col(f"base{k}")) if k < BASE else F.col(f"wider{k}") for k, _, _ in WIDER))
    found = found.select("row", "text", base.alias("base"), wider.alias("wider"))
    voted = lambda parts, is_base: lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(is_base).alias("is_base"), votes(parts, s, F.lit(is_base)).alias("votes"))
    every = let(chunks(text), lambda parts: F.concat(F.transform("base", voted(parts, True)), F.transform("wider", voted(parts, False))))
    # The other branch only gives the type of an empty list.
    return found.select("row", "text", "base", F.when((F.size("base") > 0) | (F.size("wider") > 0), every).otherwise(F.slice(every, F.lit(1), F.lit(0))).alias("voted"))


# --- reliabilities and the classifier ----------------------------------------------------


class Pattern(NamedTuple):
    kind: int
    votes: tuple[int, ...]
    n: int


def estimate(patterns: list[Pattern], rounds: int = 60) -> list[float]:
    """How likely each vote pattern is personal data, by expectation-maximisation.

    Labelers are taken as independent given the truth; each has its rates of votes given data and given none, for all kinds
    together, each kind its share of data. Begins from the majority of the votes; rates are smoothed by one vote each.
    """
    likely = [1 / (1 + math.exp(-sum(p.votes))) for p in patterns]
    for _ in range(rounds):
        rate = {(j, v, y): 1.0 for j in range(len(LABELERS)) for v in (-1, 0, 1) for y in (0, 1)}
        share = {k: [1.0, 1.0] for k in range(len(KINDS))}
        for p, q in zip(patterns, likely, strict=True):
            for y, w in ((1, q * p.n), (0, (1 - q) * p.n)):
                share[p.kind][y] += w
                for j, v in enumerate(p.votes):
                    rate[j, v, y] += w
        total = {(j, y): sum(rate[j, v, y] for v in (-1, 0, 1)) for j in range(len(LABELERS)) for y in (0, 1)}
        after = []
        for p in patterns:
            odds = math.log(share[p.kind][1] / share[p.kind][0])
            odds += math.fsum(math.log(rate[j, v, 1] / total[j, 1]) - math.log(rate[j, v, 0] / total[j, 0]) for j, v in enumerate(p.votes))
            after.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        likely = after
    return likely


def fit_classifier(patterns: list[Pattern], likely: list[float], rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> dict[str, float]:
    """Logistic weights of ``kind:k``, ``labeler:vote`` features on the estimated likelihoods, each span counting once."""
    names = [[f"kind:{p.kind}", *(f"{LABELERS[j]}:{v}" for j, v in enumerate(p.votes) if v)] for p in patterns]
    weights = dict.fromkeys(sorted({f for x in names for f in x}), 0.0)
    moved = dict.fromkeys(weights, 1e-8)
    total = sum(p.n for p in patterns)
    for _ in range(rounds):
        slope = {f: -decay * w for f, w in weights.items()}
        for x, p, q in zip(names, patterns, likely, strict=True):
            error = (q - 1 / (1 + math.exp(-sum(weights[f] for f in x)))) * p.n / total
            for f in x:
                slope[f] += error
        for f, g in slope.items():
            moved[f] += g * g
            weights[f] += rate * g / math.sqrt(moved[f])
    return weights


def train(spans: DataFrame) -> dict[str, float]:
    """The classifier from all documents' spans (as ``with_spans`` gives them); no spans give no weights."""
    voted = spans.select(F.explode("voted").alias("x")).groupBy("x.kind", *(f"x.votes.{name}" for name in LABELERS)).agg(F.count(F.lit(1)).alias("n"))
    patterns = [Pattern(r["kind"], tuple(r[name] for name in LABELERS), r["n"]) for r in voted.orderBy("kind", *LABELERS).collect()]
    return fit_classifier(patterns, estimate(patterns)) if patterns else {}


def accepted(weights: dict[str, float]) -> Column:
    """All spans of a document, base ones and accepted candidates, by start, then kind, then end."""
    def score(x: Column) -> Column:
        total = F.lit(0.0)
        for f, w in weights.items():
            name, value = f.split(":")
            total = total + F.when((x["kind"] if name == "kind" else x["votes"][name]) == int(value), w).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    kept = F.filter("voted", lambda x: x["is_base"] | (score(x) >= ACCEPT))
    return F.array_sort(F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the hash are of base spans; spans lists base and added ones as kind:start:end (code points, end
    exclusive). Null text counts as empty; documents without spans have zeros, the hash of nothing and an empty list. Rows
    that repeat an id, or have none, each get a row. Other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    spans = cut(with_spans(own).select("row.doc_id", "base", "voted"), "spans")
    base = F.array_sort(F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return spans.select(
        "doc_id", *(_count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(accepted(train(spans))).alias("spans"),
    )


def _merged(spans: Column) -> Column:
    """Spans (start, kind, end) in order, those that overlap joined under the kind that begins first."""
    def joined(xs: Column, ends: Column) -> Column:
        begins = F.filter(
            F.transform(xs, lambda x, i: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), i.alias("i"), ((i == 0) | (x["start"] >= F.get(ends, i - 1))).alias("fresh"))),
            lambda x: x["fresh"],
        )
        return let(begins, lambda bs: F.transform(bs, lambda x, j: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), F.coalesce(F.get(ends, F.get(bs, j + 1)["i"] - 1), F.element_at(ends, -1)).alias("end")
        )))

    return let(spans, lambda xs: let(running(F.transform(xs, lambda x: x["end"]), F.greatest), lambda ends: joined(xs, ends)))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with merged spans replaced by their kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def pieces(parts: Column, xs: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(xs, i - 1)["end"])
        kept = F.transform(xs, lambda x, i: F.concat(cut_out(parts, before(i), x["start"] - before(i)), F.element_at(names, x["kind"] + 1)))
        last = F.element_at(xs, -1)["end"]
        return F.concat(F.array_join(kept, ""), cut_out(parts, last, F.length(text) - last))

    return let(chunks(text), lambda parts: let(spans, lambda xs: pieces(parts, xs)))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, whole rows, with each span of their text replaced by its kind in brackets, as [EMAIL].

    Spans that overlap are replaced together, under the kind that begins first. A column n_chars, if there is one, follows the
    text where it changed. Other columns pass unchanged, whatever their names.
    """
    spans = cut(with_spans(docs, text_col), "spans")
    every = spans.select("row", "text", accepted(train(spans)).alias("every"))
    new = F.when(F.size("every") > 0, _replaced(F.col("text"), _merged(F.col("every"))))
    out = every.select("row", new.alias("new"))
    own = lambda c: F.col("row").getField(c)
    changed = {text_col: F.coalesce("new", own(text_col)), "n_chars": F.when(F.col("new").isNotNull(), F.length("new")).otherwise(own("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(changed.get(c, own(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
