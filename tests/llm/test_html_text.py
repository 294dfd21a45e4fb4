"""HTML text: the chain against enumeration, held-out labelled pages, pages that are broken or empty."""

import itertools
import os
import random
import re
import time

import numpy as np
import pytest

from tenure.llm import html_text as h
from tests.conftest import TESTDATA


def random_chain(rng):
    return h.Chain({f"f{i}": np.array([rng.gauss(0, 2), rng.gauss(0, 2)]) for i in range(5)}, np.array([[rng.gauss(0, 1) for _ in "ab"] for _ in "ab"]))


def total(chain, page, labels):
    s = chain.emissions(page)
    return sum(s[i, y] for i, y in enumerate(labels)) + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:], strict=False))


def test_decoding_and_marginals_against_enumeration():
    rng = random.Random(1)
    for _ in range(40):
        chain, page = random_chain(rng), [rng.choices([f"f{i}" for i in range(6)], k=2) for _ in range(rng.randrange(1, 7))]
        every = {y: total(chain, page, y) for y in itertools.product((0, 1), repeat=len(page))}
        assert total(chain, page, chain.decode(page)) == pytest.approx(max(every.values()))
        marginals, pairs, z = h.posteriors(chain.emissions(page), chain.moves)
        assert z == pytest.approx(np.logaddexp.reduce(list(every.values())))
        for i in range(len(page)):
            assert marginals[i, 1] == pytest.approx(sum(np.exp(v - z) for y, v in every.items() if y[i]))
        assert pairs.sum() == pytest.approx(len(page) - 1)
    assert chain.decode([]) == []


def test_held_out_labelled_pages():
    rng, right, n = random.Random(77), 0, 0
    for _ in range(150):
        names, labels = h.labelled(*h.labelled_page(rng))
        right += sum(a == b for a, b in zip(h.trained().decode(names), labels, strict=True))
        n += len(labels)
    assert right >= 0.98 * n


@pytest.mark.parametrize("page, texts", [
    ("", []), ("   ", []), ("<", ["<"]), ("a < b", ["a < b"]), ("<p>one<p>two", ["one", "two"]), ("<p>a<br>b  c\n d</p>", ["a b c d"]),
    ("<p>x&amp;y &copy; &#233;&#x41; &am</p>", ["x&y © éA &am"]), ("<div>a<span>b</span>c<div>d</div>e</div>", ["abc", "d", "e"]),
    ("<script>if (a < b) '</p>'</script>t<style>p{}</style>u<!-- <p>no</p> -->v", ["tuv"]), ("<p>a <b>b</p><p>c", ["a b", "c"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<script>never closed", []), ("<p title='>'>q</p><img alt='<p>'>r", ["q", "r"]), ("x<p class=", ["x"]),
    ("</p></div>z", ["z"]), ("<!-- open", []), ("<select><option>o</select>k", ["k"])])
def test_blocks(page, texts):
    assert [b.text for b in h.blocks(page)] == texts


@pytest.mark.parametrize("page, texts", [
    ("<p>a <svg width=1/> b</p><p>c</p>", ["a b", "c"]), ("<p>a <math/> b</p>c", ["a b", "c"]), ("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p>c", ["a x=2 b", "c"]),
    ("<p>a<svg><path d=1 /><title>t</title><g>b</g></svg>c</p>d", ["abc", "d"]), ("<p>a<svg><path d=1><p>b<div>c</div>", ["a", "b", "c"]),
    ("<datalist><option>a<option value=b>b</datalist><p>c", ["a", "b", "c"]), ("<button>a<p>b</p>", ["a", "b"]), ("<div><object>a</div>b", ["a", "b"]), ("<canvas>a<p>b", ["a", "b"]),
    ("<select><option>a<p>b", ["a", "b"]), ("<svg/><article><p>a</p></article>", ["a"]), ("<svg><title/></svg><p>a", ["a"])])
def test_nothing_else_is_dropped(page, texts):
    assert [b.text for b in h.blocks(page)] == texts


@pytest.mark.parametrize("inner", ["<svg width=1/>", "<p><math/></p>", "<object>", "<canvas>", "<button>Share</button>", "<datalist><option>One<option>Two</datalist>"])
def test_an_article_goes_on_after_empty_and_unclosed_tags(inner):
    page = f"<body><article><h1>A title</h1><p>One paragraph of words, with a stop.</p>{inner}<p>The last paragraph of words, with a stop.</p></article></body>"
    assert h.main_text(page, h.trained()) == "A title\nOne paragraph of words, with a stop.\nThe last paragraph of words, with a stop."


def test_main_text_of_ordinary_layouts():
    body = "<article><h1>A title here</h1><p>First paragraph of some words, which says things.</p><p>Second &amp; last paragraph, with more of them.</p></article>"
    page = f"""<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie notice">We use cookies.</div>{body}
        <aside class="sidebar"><p>Other things that you may like to read some day.</p></aside><form>Name <input></form>
        <section id="comments"><p>I liked this article a lot, thank you for it.</p></section><footer>&copy; us</footer></body></html>"""
    assert h.main_text(page, h.trained()) == "A title here\nFirst paragraph of some words, which says things.\nSecond & last paragraph, with more of them."


@pytest.mark.parametrize("inner", [
    '<section class="reader-comments"><p>Great read, thank you very much for it.</p></section>', '<div hidden><p>This text is not shown to any reader.</p></div>',
    '<div class="adslot sponsored"><p>Buy these shoes now, they are cheap.</p></div>', '<form><p>Your name and your address here, please.</p></form>',
    '<div class="newsletter signup"><p>Get our letter every week in your mail.</p></div>', '<aside><h3>More</h3><ul><li><a href=/a>Another story</a></ul></aside>'])
def test_what_stands_inside_an_article_but_is_not_of_it(inner):
    page = f"<body><article><h1>A title</h1><p>One paragraph of words, with a stop.</p>{inner}<p>The last paragraph of words, with a stop.</p></article></body>"
    assert h.main_text(page, h.trained()) == "A title\nOne paragraph of words, with a stop.\nThe last paragraph of words, with a stop."


def test_pages_table(spark, frame):
    deep = "<div>" * 30_000 + "<p>deep</p>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>Some words in a paragraph.</p></article>", "x"), (3, "u", deep, "x"), (3, "u", deep, "x"),
            (4, "u", "<article>" + "<p>A paragraph of words.</p>" * 20_000 + "</article>", "x")]
    got = h.extract(frame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 6
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[None].text == "Some words in a paragraph." and by[4].text.count("\n") == 19_999
    assert all(r.n_chars == len(r.text) for r in got)
    assert h.extract(frame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="needs the driver's test tables")
def test_the_articles_of_the_pages(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{TESTDATA}/pages.parquet").collect()}
    for r in h.op5_html_text(spark, TESTDATA).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("page, texts", [
    ('<p title="the hidden truth">a</p>b', ["a", "b"]), ("<p data-x='display: none'>a</p>", ["a"]), ("<p title=it's>a</p><p>b's</p>", ["a", "b's"]), ("<p title=a\"b>c</p>", ["c"]),
    ("<!-- c --!>a<!-->b<!--->c<!-- - -- > -->d", ["abcd"]), ("<p a='x' 'y>b", ["b"]), ("<p a=\"never closed>b</p>c", ["b", "c"]), ("<a href=/x?a=\"b>c</a>", ["c"]),
    ("<p a = 'x>y' b>c", ["c"]), ("1 <2 and 3< 4 <p>x", ["1 <2 and 3< 4", "x"]), ("a<?php x ?>b<!doctype html>c", ["abc"]), ("<script>x</script a='>'>b", ["'>b"]), ("<title>x</titles></title>y", ["y"]),
    ("a<b", ["a"]), ("a </ b", ["a </ b"])])
def test_tags_as_browsers_read_them(page, texts):
    assert [b.text for b in h.blocks(page)] == texts


@pytest.mark.parametrize("attributes, names", [
    ("class=a id=b role='c d'", ("a", "b", "c", "d")), ("title='class=x'", ()), ("hidden", ("hidden",)), ("HIDDEN=''", ("hidden",)), ("data-hidden", ()), ("aria-hidden=true", ("hidden",)),
    ("aria-hidden='false'", ()), ("style='Display : None'", ("hidden",)), ("title='display:none' class='x'", ("x",)), ("class='a' class='b'", ("a",)), ("class = a", ("a",)), ("class", ())])
def test_names_come_from_attributes_only(attributes, names):
    assert h.named(attributes) == names


@pytest.mark.parametrize("unit", ["<a ", "<a x=\"", "<a x='y\" ", "</script", "<script", "<select>", "<!-", "<!--", "<", "</", "<a x=\">\" ", "<p title='", "a&", "<p =", "<textarea>", "</p "])
def test_broken_tags_take_linear_time(unit):
    started = time.process_time()
    h.blocks(unit * (1_000_000 // len(unit)) + "x" * 9)
    assert time.process_time() - started < 6


@pytest.mark.parametrize("kind", ['section id="comments"', 'section class="comments"', 'div id="comments"', 'div class="comment"', 'ol class="commentlist"', 'div id="respond"', 'section id="responses"', 'div id="disqus"'])
@pytest.mark.parametrize("inner", ["<p>Nice.</p>", "<p>I liked this a lot, thank you for writing it.</p>", "Not sure that I agree with all of it."])
def test_a_single_comment_inside_the_article(kind, inner):
    tag = kind.split()[0]
    body = "<h1>A title</h1><p>One paragraph of words, with a stop.</p><p>The last paragraph of words, with a stop.</p>"
    page = f"<body><article>{body}<{kind}>{inner}</{tag}></article></body>"
    assert h.main_text(page, h.trained()) == "A title\nOne paragraph of words, with a stop.\nThe last paragraph of words, with a stop."
