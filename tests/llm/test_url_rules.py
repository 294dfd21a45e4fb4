"""URL rules: parts, longest rule, mined rules against counting, matching against brute force."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tenure.llm import url_rules as u

PAGES = "page_id long, url string, host string"


def slow(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


URLS = [None, "", "x", "a://", "http://", "HTTP://WWW.Example.COM/en/1?x://y/z#q", "http://example.com/en/", "http://sub.example.com/en/a.html", "http://notexample.com/en/1",
        "http://example.com", "http://example.com?x=/en/", "http://a.net/es/", "http://net/fr/1", "http://a.net/en/1", "http://É.com/Ü", "http://a.org/#://b", "a\nb://c.com/d\ne",
        "http://www.example.com/en/", "http://m.www.example.com/en/", "//a.com/b", "x://y://z.com/", "http://a.com/" + "b" * 50_000]


def test_parts_and_given_rules(spark, frame):
    rows = [(i, x, "clash") for i, x in enumerate(URLS)] + [(3, "http://a.net/es/", "clash")]
    got = sorted(tuple(r)[:4] for r in u.judge(frame(rows, PAGES)).collect())
    assert [g[:3] for g in sorted(got, key=str)] == [g[:3] for g in sorted([(i, *slow(x)[:3]) for i, x, _ in rows], key=str)]
    verdicts = {r.page_id: r.verdict for r in u.judge(frame(rows, PAGES)).where("rule is not null").collect()}
    assert all(verdicts[i] == slow(x)[3] for i, x, _ in rows if i in verdicts and i != 3)


def test_mined_rules_are_those_that_counting_finds(spark, frame):
    rng = random.Random(1)
    sets = []
    for _ in range(300):
        tokens = sorted(rng.sample("abcdef", rng.randrange(1, 5)))
        bad = {"a", "b"} <= set(tokens) or ("f" in tokens and rng.random() < 0.8)
        sets.append((tokens, "block" if bad else "allow"))
    got = {tuple(r.rule_tokens): (round(r.confidence, 9), round(r.support, 9)) for r in u.mine(frame(sets, "tokens array<string>, verdict string"), 0.02, 0.7).collect()}
    want = {}
    for n in range(u.MIN_TOKENS, 5):
        for combo in itertools.combinations("abcdef", n):
            held = [v for t, v in sets if set(combo) <= set(t)]
            blocked = held.count("block")
            if blocked >= 0.02 * len(sets) and blocked / len(held) >= 0.7:
                want[combo] = (round(blocked / len(held), 9), round(blocked / len(sets), 9))
    want = {c: v for c, v in want.items() if not any(set(d) < set(c) and w[0] >= v[0] for d, w in want.items())}
    assert got == want and len(want) > 1


def test_matching(spark, frame):
    rng = random.Random(2)
    rules = [(i, sorted(rng.sample("abcdefgh", rng.randrange(1, 4))), rng.random()) for i in range(15)]
    sets = [(i, sorted(rng.sample("abcdefgh", rng.randrange(0, 6)))) for i in range(80)]
    mined = frame(rules, "rule_id long, rule_tokens array<string>, confidence double").withColumn("n_tokens", F.size("rule_tokens"))
    got = {r.set_id: r.mined_rule for r in u.match(frame(sets, "set_id long, tokens array<string>"), mined).collect()}
    want = {}
    for i, t in sets:
        fit = [(c, -len(r), " & ".join(r)) for _, r, c in rules if set(r) <= set(t)]
        if fit:
            want[i] = max(fit)[2]
    assert got == want


@pytest.mark.parametrize("rows", [[], [(1, None, "x")], [(1, "http://a.org/q", "x"), (1, "http://a.org/q", "x")]])
def test_small_tables(spark, frame, rows):
    got = u.judge(frame(rows, PAGES)).collect()
    assert len(got) == len(rows) and all(r.verdict == "allow" for r in got)


def test_mined_rules_judge_other_urls(spark, frame):
    rows = [(i, f"http://shop.spam-farm.example.net/es/{i}", "") for i in range(60)] + [(100 + i, f"http://good.org.com/de/{i}", "") for i in range(60)]
    rows += [(200, "http://shop.spam-farm.example.net/en/1", ""), (201, "http://quiet.example.org/de/3", "")]
    got = {r.page_id: r for r in u.judge(frame(rows, PAGES)).collect()}
    assert got[200].verdict == "block" and got[200].mined_rule and got[201].verdict == "allow" and got[201].mined_rule is None


def test_tokens_of_the_whole_url(spark, frame):
    url = "https://a-b.x.y.example.org/v1.2/w/deep/er/ads/page.tar.gz?one=1&two=2#?no=1"
    host, path = u.parts(F.col("url"))
    got = frame([(url,), ("https://example.org/v1.2/ads/x",), (None,)], "url string").select(u.tokens(host, path, F.coalesce("url", F.lit(""))).alias("t")).collect()
    assert set(got[0].t) == {
        "top=org", "site=y.example.org", "first=a-b", "name=a", "name=b", "label=x", "label=y", "site=example.org", "path=v0.0", "path=w", "path=deep", "path=er",
        "path=ads", "path=page.tar", "ending=gz", "query=one", "query=two"}
    assert set(got[1].t) == {"top=org", "site=example.org", "path=v0.0", "path=ads", "path=x"} and got[2].t == []


@pytest.mark.parametrize("tail", ["a/b/c/d/spam/x", "v1.2/spam/x", "x?id=1&spam=2"])
def test_a_combination_anywhere_in_the_url_is_mined(spark, frame, tail):
    rows = [(i, f"https://s{i}.net/{'es' if i % 2 else 'xx'}/{tail if i % 2 else 'ok'}") for i in range(40)]
    rows += [(100 + i, f"https://www.example.com/en/{tail.replace('spam', 'fine')}") for i in range(40)] + [(200, f"https://t.org/{tail}")]
    got = {r.page_id: (r.verdict, r.mined_rule) for r in u.judge(frame(rows, "page_id long, url string")).collect()}
    assert got[200][0] == "block" and "spam" in got[200][1]


def counted(sets, tokens, min_support, min_confidence, longest):
    """Rules by counting every combination."""
    want = {}
    for n in range(u.MIN_TOKENS, longest + 1):
        for combo in itertools.combinations(tokens, n):
            held = [v for t, v in sets if set(combo) <= set(t)]
            blocked = held.count("block")
            if blocked >= max(1, min_support * len(sets)) and blocked / len(held) >= min_confidence:
                want[combo] = (round(blocked / len(held), 9), round(blocked / len(sets), 9))
    return {c: v for c, v in want.items() if not any(set(d) < set(c) and w[0] >= v[0] for d, w in want.items())}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_tokens_that_go_together_give_the_rules_of_counting(spark, frame, seed):
    """Tokens of the same urls (a, b, c), tokens that imply others (d, e, f, from deep to wide), and loose ones."""
    rng, sets = random.Random(seed), []
    for _ in range(200):
        t = {x for x in "xyz" if rng.random() < 0.4}
        if rng.random() < 0.5:
            t |= set("abc")
        t |= set("def"[rng.randrange(4):])
        bad = ("a" in t and rng.random() < 0.9) or ("f" in t and "x" in t and rng.random() < 0.85) or rng.random() < 0.1
        sets.append((sorted(t), "block" if bad else "allow"))
    got = {tuple(r.rule_tokens): (round(r.confidence, 9), round(r.support, 9)) for r in u.mine(frame(sets, "tokens array<string>, verdict string"), 0.03, 0.75).collect()}
    want = counted(sets, "abcdefxyz", 0.03, 0.75, 9)
    assert got == want and len(want) > 3


def test_deep_urls_give_no_powers_of_two(spark, frame):
    """Families of 1,000 urls with 20 segments in common, and with 1 to 20 of them in common, blocked, allowed and mixed."""
    deep = [f"d{i}" for i in range(20)]
    letters = "abcdefghijklmnopqrst"
    rows = []
    for i in range(1000):
        rows.append(f"https://s.net/{'es' if i % 2 else 'xx'}/{'/'.join('p' + x for x in letters)}/{i}")
        rows.append(f"https://{'www.' if i % 3 else ''}example.com/en/{'/'.join(x + 'q' for x in letters[:1 + i % 20])}/{i}")
        rows.append(f"https://t.net/fr/{'/'.join(x + 'r' for x in letters[:1 + i % 20])}?k{i % 5}=1&j{i % 7}=2")
    frame_ = frame([(i, x) for i, x in enumerate(rows)] + [(9000, "https://t.org/pa/pb/1"), (9001, "https://t.org/" + "/".join(deep))], "page_id long, url string")
    got = {r.page_id: r for r in u.judge(frame_).where("page_id >= 9000 or rule is null").collect()}
    assert got[9001].verdict == "allow"
    assert len(got) == 2 + 500


def test_a_hot_token_set_is_judged_like_any_other(spark, frame, monkeypatch):
    monkeypatch.setattr(u, "HOT", 10)
    rows = [(i, f"http://shop.spam-farm.example.net/es/{i}") for i in range(60)] + [(100 + i, f"http://good.org.com/de/{i}") for i in range(60)]
    rows += [(1000 + i, f"http://shop.spam-farm.example.net/en/{i}") for i in range(200)] + [(2000 + i, f"http://shop.spam-farm.example.net/{'abcdefgh'[i]}/1") for i in range(8)]
    got = u.judge(frame(rows, "page_id long, url string")).where("page_id >= 1000").collect()
    assert len(got) == 208 and all(r.verdict == "block" and r.mined_rule for r in got)
