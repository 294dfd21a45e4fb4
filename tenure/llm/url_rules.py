"""URL filters by association rules.

Given rules judge the urls they fit. From these judged urls FP-growth mines which combinations of
url tokens go with a block; rules pruned by confidence and support judge the urls that no given rule fits. Rules
are matched by an inverted index from token to rule: a rule fires when all its tokens are met.

Spark's own FPGrowth lists every frequent combination, 2^k of k tokens that urls share. So the patterns are grown here
by rounds of joins and groupings, over tokens of the same urls merged into one item, and only along combinations
that can still give a rule; the rules are those that a full listing gives after pruning.

Urls are reduced to their token set before they are matched, so a host with a third of all urls
counts once per distinct set.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenure.llm.common import cut, table

#: Of the judged urls, the share that must hold a combination; and of its urls, the share blocked.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.9
#: Tokens of a rule, at least: one token alone, such as an end of all hosts, is too wide a reason.
MIN_TOKENS = 2
#: Token sets of more than this part of the open urls are matched apart from others.
HOT = 1_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null urls and those without ://."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def given(rules: Iterable[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null if none fits.

    Length counts host and path together; of equally long rules that of the longer host, then of the smaller name.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name), reverse=True):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))) & F.startswith(F.col("path"), F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: domain and its ends, every host label, every path segment, ending, every parameter's name.

    Only the last segment has an ending, which is cut from it. Numbers in segments count as one token.
    """
    labels = F.split(host, r"\.")
    words = F.filter(F.split(F.regexp_replace(path, r"\.[^./]*\z", ""), "/"), lambda x: x != "")
    shaped = F.transform(words, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    name = F.transform(F.split(labels[0], "-"), lambda x: F.concat(F.lit("name="), x))
    # The first label has a token of its own; the last two are a site only together, so that no name counts under every top.
    inner = F.transform(F.filter(labels, lambda x, i: (i > 0) & (i < F.size(labels) - 2)), lambda x: F.concat(F.lit("label="), x))
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    asked = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(
        F.array(
            F.when(host != "", F.concat(F.lit("top="), F.element_at(labels, -1))),
            F.when(F.size(labels) > 1, F.concat(F.lit("site="), F.substring_index(host, ".", -3))),
            F.when(F.size(labels) > 2, F.concat(F.lit("site="), F.substring_index(host, ".", -2))),
            F.when(F.size(labels) > 2, F.concat(F.lit("first="), labels[0])),
            F.when(F.rlike(path, F.lit(r"\.[^./]*\z")), F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([^./]*)\z", 1))),
        ), shaped, inner, F.when(F.rlike(url, F.lit(r"\A[^?#]*\?")), asked).otherwise(none), F.when(F.size(F.split(labels[0], "-")) > 1, name).otherwise(none),
    ), lambda x: x.isNotNull()))


def _occurrences(judged: DataFrame, need: float) -> tuple[DataFrame, DataFrame]:
    """The frequent items (item, tokens, n, b), and the distinct token sets as sorted lists of them (items, n, b).

    Tokens of the same urls are one item: whatever holds of one of them holds of all. Items are numbered from the rarest on. Each
    is in ``need`` blocked urls at least, so there are at most (tokens of all blocked urls) / need of them.
    """
    blocked = F.sum((F.col("verdict") == "block").cast("long"))
    sets = judged.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), blocked.alias("b")).withColumn("set_id", F.monotonically_increasing_id())
    sets = cut(sets, "sets")
    each = sets.select("set_id", "n", "b", F.explode("tokens").alias("token"))
    where = (F.sum(F.xxhash64("set_id", F.lit(i)).cast("decimal(38,0)")).alias(f"w{i}") for i in (1, 2))
    frequent = each.groupBy("token").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), *where).where(F.col("b") >= need)
    merged = frequent.groupBy("n", "b", "w1", "w2").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    items = cut(merged.select(F.row_number().over(Window.orderBy("n", "tokens")).alias("item"), "tokens", "n", "b"), "items")
    numbered = each.join(items.select("item", F.explode("tokens").alias("token")), "token")
    listed = numbered.groupBy("set_id").agg(F.array_sort(F.collect_set("item")).alias("items"), F.first("n").alias("n"), F.first("b").alias("b"))
    return items, cut(listed.select("items", "n", "b"), "item-sets")


def _grown(judged: DataFrame, min_support: float, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """Items, and rules over them (items, n, b) with two items at least that no rule of a part of them dominates.

    FP-growth by rounds: a row is a found combination with what its url holds besides, among the items after it. A combination is
    grown only if each item makes it rarer (a generator), since without that item it is a rule of the same urls,
    and if some of its urls are allowed, since no rule is surer than one without.
    """
    total = judged.count()
    need = max(1.0, min_support * total - 1e-9)
    items, base = _occurrences(judged, need)
    sure = F.col("b") >= min_confidence * F.col("n") - 1e-9
    last = items.select(F.array("item").alias("items"), "n", "b")
    rest = F.filter("items", lambda x: x > F.col("item"))
    frontier = base.select(F.explode("items").alias("item"), "items", "n", "b").select(F.array("item").alias("found"), rest.alias("rest"), "n", "b")
    rules, size = None, 1
    while True:
        size += 1
        grown = frontier.where(F.size("rest") > 0).select("found", "rest", "n", "b", F.posexplode("rest").alias("at", "item")).select(
            F.array_append("found", F.col("item")).alias("items"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"), "n", "b"
        )
        counted = cut(grown.groupBy("items").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).where(F.col("b") >= need), "combinations")
        if counted.isEmpty():
            break
        # Each part without one item must have been grown, and be in more urls.
        parts = counted.select("items", "n", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("part"))
        whole = parts.join(last.select(F.col("items").alias("part"), F.col("n").alias("n_part")), "part").where("n_part > n")
        generators = cut(counted.join(whole.groupBy("items").count().where(F.col("count") == size).select("items"), "items", "left_semi"), "generators")
        found = (counted if size == 2 else generators).where(sure)
        rules = found if rules is None else rules.unionByName(found)
        last = generators.where("b < n")
        frontier = cut(grown.join(last.select("items"), "items", "left_semi").withColumnRenamed("items", "found"), "frontier")
    if rules is None:
        return items, base.limit(0)
    rules = cut(rules, "rules")
    small = rules.select(F.col("items").alias("part"), F.col("n").alias("n_part"), F.col("b").alias("b_part"), F.get("items", F.lit(0)).alias("item"))
    dominated = rules.select("items", "n", "b", F.explode("items").alias("item")).join(small, "item").where(
        (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
        & (F.col("b_part").cast("decimal(38,0)") * F.col("n") >= F.col("b").cast("decimal(38,0)") * F.col("n_part"))
    )
    return items, rules.join(dominated.select("items").distinct(), "items", "left_anti")


def mine_groups(judged: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules of judged token sets (tokens, verdict), those over tokens of the same urls together: rule_id, groups, confidence, support, n_tokens.

    A row stands for all rules of n_tokens tokens with at least one of each group.
    """
    total = max(1, judged.count())
    items, rules = _grown(judged, min_support, min_confidence)
    alone = items.where((F.size("tokens") >= MIN_TOKENS) & (F.col("b") >= min_confidence * F.col("n") - 1e-9)).select(F.array("item").alias("items"), "n", "b")
    each = rules.unionByName(alone).select("items", "n", "b", F.explode("items").alias("item")).join(items.select("item", "tokens"), "item")
    whole = each.groupBy("items", "n", "b").agg(F.array_sort(F.collect_list("tokens")).alias("groups"))
    return cut(whole.select(
        F.monotonically_increasing_id().alias("rule_id"), "groups", (F.col("b") / F.col("n")).alias("confidence"), (F.col("b") / total).alias("support"),
        F.greatest(F.size("groups"), F.lit(MIN_TOKENS)).alias("n_tokens"),
    ), "rules")


def mine(judged: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules of judged token sets (tokens, verdict), each by itself: rule_tokens, confidence, support, n_tokens.

    A rule is a token combination that is in blocked urls as often as at least ``min_support`` of the judged urls, of whose urls at least
    ``min_confidence`` are blocked. A rule is dropped if some subset of its tokens is a rule of no less confidence.
    """
    found = mine_groups(judged, min_support, min_confidence)
    pair = lambda x, i: F.transform(F.slice(F.get("groups", F.lit(0)), i + 2, F.size(F.get("groups", F.lit(0)))), lambda y: F.array(x, y))
    pairs = F.flatten(F.transform(F.get("groups", F.lit(0)), pair))
    of_each = lambda done, group: F.flatten(F.transform(done, lambda d: F.transform(group, lambda t: F.array_append(d, t))))
    product = F.aggregate("groups", F.array(F.array().cast("array<string>")), of_each)
    every = F.when(F.size("groups") == 1, pairs).otherwise(product)
    return found.select(F.explode(every).alias("rule_tokens"), "confidence", "support", "n_tokens").withColumn("rule_tokens", F.array_sort("rule_tokens"))


def index(rules: DataFrame) -> DataFrame:
    """The inverted index: each rule under the tokens of one of its groups, of that which the fewest rules have."""
    each = rules.select("rule_id", F.posexplode("groups").alias("at", "group")).select("rule_id", "at", F.explode("group").alias("token"))
    spread = each.groupBy("token").agg(F.count(F.lit(1)).alias("n_rules"))
    rarest = each.join(spread, "token").groupBy("rule_id", "at").agg(F.sum("n_rules").alias("n_rules")).groupBy("rule_id").agg(
        F.min_by("at", F.struct("n_rules", "at")).alias("at")
    )
    return rules.join(rarest, "rule_id").withColumn("token", F.explode(F.get("groups", F.col("at"))))


def match_groups(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """set_id and mined_rule: the surest rule whose tokens a set holds, for sets (set_id, tokens) that have one.

    Of equally sure rules that of the fewest tokens, then of the largest name. Of a group, the largest tokens held are named.
    """
    held = F.transform("groups", lambda g: F.array_intersect(g, F.col("tokens")))
    met = sets.select("set_id", "tokens", F.explode("tokens").alias("token")).join(index(rules), "token").withColumn("held", held)
    met = met.where(F.forall("held", lambda g: F.size(g) > 0) & (F.size(F.flatten("held")) >= F.col("n_tokens")))
    chosen = F.when(F.size("held") < F.col("n_tokens"), F.slice(F.reverse(F.array_sort(F.flatten("held"))), F.lit(1), F.col("n_tokens"))).otherwise(
        F.transform("held", lambda g: F.array_max(g))
    )
    name = F.array_join(F.array_sort(chosen), " & ")
    return met.groupBy("set_id").agg(F.max_by(name, F.struct("confidence", F.negative("n_tokens"), name)).alias("mined_rule"))


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``match_groups`` for rules (rule_id, rule_tokens, confidence, n_tokens) that are given one by one."""
    return match_groups(sets, rules.withColumn("groups", F.transform("rule_tokens", lambda t: F.array(t))))


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block), mined_rule (where one decided).

    Null urls and those without :// have an empty host and path, fit no rule and are allowed; so is
    every url that neither a given nor a mined rule fits. Repeated rows each get a row. Without urls that
    a given rule fits, nothing is mined. Extra columns are not read.
    """
    host, path = parts(F.col("url"))
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    split = split.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("url"))
    name, verdict = given(rules)
    split = split.withColumn("rule", name).withColumn("given", verdict)
    split = cut(split.withColumn("tokens", F.array_sort(tokens(F.col("host"), F.col("path"), F.col("url")))).drop("url"), "urls")
    judged = split.where("given is not null")
    named = lambda df: df.select(
        "page_id", "host", "path", "rule",
        F.coalesce("given", F.when(F.col("mined_rule").isNotNull(), "block"), F.lit("allow")).alias("verdict"), "mined_rule",
    )
    none = F.lit(None).cast("string")
    if judged.isEmpty():
        return named(split.withColumn("mined_rule", none))
    mined = mine_groups(judged.select("tokens", F.col("given").alias("verdict")))
    open_ = split.where("given is null")
    sets = cut(open_.groupBy("tokens").agg(F.count(F.lit(1)).alias("n_urls")).withColumn("set_id", F.monotonically_increasing_id()), "token-sets")
    fired = cut(match_groups(sets, mined).join(sets, "set_id").select("tokens", "n_urls", "mined_rule"), "fired")
    # At most HOT sets have a HOT-th of the open urls or more: these are sent to every task, so that none gets all urls of one.
    many = max(1, open_.count() // HOT)
    often = F.broadcast(fired.where(F.col("n_urls") > many).select("tokens", "mined_rule"))
    seldom = fired.where(F.col("n_urls") <= many).select("tokens", F.col("mined_rule").alias("seldom_rule"))
    met = open_.join(often, "tokens", "left")
    hot = met.where("mined_rule is not null")
    rest = met.where("mined_rule is null").drop("mined_rule").join(seldom, "tokens", "left").withColumnRenamed("seldom_rule", "mined_rule")
    return named(judged.withColumn("mined_rule", none)).unionByName(named(hot)).unionByName(named(rest))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
