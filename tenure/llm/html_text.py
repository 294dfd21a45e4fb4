"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into blocks: stretches of text that no block-level tag interrupts, each with the tags,
classes and ids of its ancestors. A two-label chain (main text or not) with ancestor and text features is
trained on labelled pages and decoded by Viterbi. Labelled pages are written by ``labelled_page``: layouts as sites have them, with
the truth known by construction.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm.common import computed, table

#: Labelled pages that the chain is trained on, and passes over them.
TRAIN_PAGES, EPOCHS = 700, 15
#: Tags deeper than this are read, but not remembered as ancestors, as in browsers.
MAX_DEPTH = 512

#: Names of HTML. Tags whose content is no text, tags without content, tags that break a block.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "title", "xmp")
#: Its choices are no text, if its end tag, which HTML demands, stands in the page.
CHOICE = "select"
#: Drawings and formulas stand in a line of text, and so do their elements, up to a tag that ends them as in browsers.
FOREIGN = ("svg", "math")
ENDS_FOREIGN = frozenset("address article aside blockquote body center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr li main menu nav ol p pre section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Tags that a new block of the same kind ends, and those that end an open paragraph.
SELF_CLOSING = {"p": ("p",), "option": ("option",), "optgroup": ("option", "optgroup"), "button": ("button",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"option": ("select", "datalist"), "optgroup": ("select", "datalist"), "li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

#: A tag as browsers read it: a value has quotes only right after its equals sign, and a quote that nothing closes is a character
#: like others. Every repetition keeps what it took, so that a page is read in linear time.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>")
_ATTR = re.compile(r"([^\s/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|(\S*+)))?")
_NO_DISPLAY = re.compile(r"display\s*+:\s*+none", re.I)
_COMMENT_END = re.compile(r"--!?>")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in (*RAW, CHOICE)}
_BEGUN = re.compile(r"</?[A-Za-z]")
_NAME = re.compile(r"[a-z]+")
_WORDS = re.compile(r"[^\W_]+")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]  # words of ancestors' classes, ids and roles
    link_chars: int
    breaks: int


def named(attributes: str) -> tuple[str, ...]:
    """Words of a tag's classes, id and role, and whether it is hidden; of an attribute given twice, the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTR.findall(attributes):
        found.setdefault(name.lower(), "".join(values))
    names = [n for a in ("class", "id", "role") for n in _NAME.findall(found.get(a, "").lower())]
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or _NO_DISPLAY.search(found.get("style", "")):
        names.append("hidden")
    return tuple(names)


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order. Raw-text elements and comments give nothing; unclosed tags are closed by their parents."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # tag, names, block-level
    text: list[str] = []
    links = breaks = 0
    at = 0

    def flush() -> None:
        nonlocal links, breaks
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                found.append(Block(whole, tuple(t for t, _, level in stack if level), tuple(n for _, names, _ in stack for n in names), links, breaks))
        text.clear()
        links = breaks = 0

    def close(tag: str) -> None:
        nonlocal stack
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                if any(level for _, _, level in stack[i:]):
                    flush()
                del stack[i:]
                return
            if tag in INLINE and stack[i][2]:
                return  # an inline end tag doesn't reach over its block

    unclosed: set[str] = set()  # raw-text tags that have no end tag in the rest of the page

    def end_of(tag: str, after: int) -> int | None:
        """Where the content of a raw-text tag, with its end tag, ends."""
        if tag in unclosed:
            return None
        end = _END[tag].search(page, after)
        if end is None:
            unclosed.add(tag)
            return None
        closed = page.find(">", end.end())
        return closed + 1 if closed >= 0 else len(page)

    met_foreign = False
    seen = 0  # text up to here is taken
    while (lt := page.find("<", at)) >= 0:
        if page.startswith("<!--", lt):
            if page.startswith("<!-->", lt):
                end = lt + 5
            else:
                closed = _COMMENT_END.search(page, lt + 4 - page.startswith("<!--->", lt))
                end = closed.end() if closed else len(page)
            m = None
        elif page.startswith(("<!", "<?"), lt):
            m, end = None, page.find(">", lt) + 1 or len(page)
        else:
            m = _TAG.match(page, lt)
            if m is None:
                if not _BEGUN.match(page, lt):
                    at = lt + 1  # a character of the text
                    continue
                end = len(page)  # a tag that the end of the page cut off
            else:
                end = m.end()
        if lt > seen:
            text.append(piece := page[seen:lt])
            if any(t == "a" for t, _, _ in stack):
                links += len(piece)
        at = seen = end
        if m is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if tag not in VOID:
                close(tag)
            continue
        foreign = next((i for i, x in enumerate(stack) if x[0] in FOREIGN), None) if met_foreign else None
        if foreign is not None and m.group(3).rstrip().endswith("/") and tag not in ENDS_FOREIGN:
            continue  # the element is empty
        if tag in _END:
            closed = end_of(tag, at)
            if closed is not None or tag != CHOICE:
                at = seen = len(page) if closed is None else closed
                if tag not in ("script", "style") and foreign is None:
                    flush()
                continue
        if tag == "br":
            text.append(" ")
            breaks += 1
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if foreign is not None and tag in ENDS_FOREIGN:
            del stack[foreign:]
            foreign = None
        met_foreign = met_foreign or tag in FOREIGN
        inline = tag in INLINE or tag in FOREIGN or foreign is not None
        if not inline:
            flush()
            for ended in SELF_CLOSING.get(tag, ("p",)):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == ended:
                        del stack[i:]
                        break
                    if stack[i][0] in SCOPES.get(tag, ()) or (ended == "p" and stack[i][0] not in INLINE):
                        break
        names = named(m.group(3)) if m.group(3) else ()
        if len(stack) < MAX_DEPTH and (not m.group(3).rstrip().endswith("/") or tag in ("p", "div", "span", "a")):
            stack.append((tag, names, not inline))
    if seen < len(page):
        text.append(page[seen:])
    flush()
    return found


# --- features ---------------------------------------------------------------------------


def features(block: Block, place: float) -> list[str]:
    """Names of the block's features; place: where in the page it stands, 0 to 1."""
    words = _WORDS.findall(block.text)
    n = len(words)
    last = block.text[-1]
    out = ["bias", f"own:{block.tags[-1] if block.tags else '-'}", f"place:{int(4 * place)}"]
    out += {f"in:{t}" for t in block.tags}
    out += {f"name:{w}" for w in block.names}
    out.append(f"words:{min(n, 3) if n < 4 else 4 if n < 10 else 5 if n < 25 else 6}")
    share = block.link_chars / len(block.text)
    out.append(f"links:{0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
    out.append(f"end:{'stop' if last in '.!?…”\"»' else 'letter' if last.isalnum() else 'other'}")
    if "©" in block.text or "all rights reserved" in block.text.lower():
        out.append("rights")
    return out


class Chain:
    """Weights of a two-label chain: per feature and label, and per pair of labels."""

    def __init__(self, weights: dict[str, np.ndarray], moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def emissions(self, page: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(page), 2))
        for i, names in enumerate(page):
            for n in names:
                if (w := self.weights.get(n)) is not None:
                    out[i] += w
        return out

    def decode(self, page: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to 0."""
        scores, (stay0, to1), (to0, stay1) = self.emissions(page).tolist(), self.moves[0].tolist(), self.moves[1].tolist()
        if not scores:
            return []
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            from0, from1 = (a + stay0 < b + to0), (a + to1 < b + stay1)
            back.append((from0, from1))
            a, b = (b + to0 if from0 else a + stay0) + x, (b + stay1 if from1 else a + to1) + y
        labels = [int(b > a)]
        for choice in reversed(back):
            labels.append(int(choice[labels[-1]]))
        return labels[::-1]


def posteriors(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of labels and of neighbouring pairs, and log Z, by forward and backward sums."""
    n = len(scores)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1]) + scores[i]
    for i in range(n - 2, -1, -1):
        step = moves + scores[i + 1] + behind[i + 1]
        behind[i] = np.logaddexp(step[:, 0], step[:, 1])
    z = float(np.logaddexp(*ahead[-1]))
    pairs = np.exp(ahead[:-1, :, None] + moves + (scores[1:] + behind[1:])[:, None, :] - z) if n > 1 else np.zeros((0, 2, 2))
    return np.exp(ahead + behind - z), pairs, z


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Chain:
    """Maximum likelihood by stochastic gradient steps, each scaled by what its weight has moved before."""
    rng = random.Random(seed)
    weights: dict[str, np.ndarray] = {}
    moved: dict[str, np.ndarray] = {}
    chain = Chain(weights, np.zeros((2, 2)))
    moves_moved = np.full((2, 2), 1e-8)
    pages = [p for p in pages if p[0]]
    for _ in range(epochs):
        rng.shuffle(pages)
        for names, labels in pages:
            for f in (f for block in names for f in block):
                if f not in weights:
                    weights[f], moved[f] = np.zeros(2), np.full(2, 1e-8)
            marginals, pairs, _ = posteriors(chain.emissions(names), chain.moves)
            truth = np.eye(2)[labels]
            slope: dict[str, np.ndarray] = {}
            for block, d in zip(names, truth - marginals, strict=True):
                for f in block:
                    slope[f] = slope.get(f, 0) + d
            for f, g in slope.items():
                g = g - decay * weights[f]
                moved[f] += g * g
                weights[f] += rate * g / np.sqrt(moved[f])
            g = -pairs.sum(axis=0)
            np.add.at(g, (labels[:-1], labels[1:]), 1)
            moves_moved += g * g
            chain.moves += rate * g / np.sqrt(moves_moved)
    return chain


# --- labelled pages ---------------------------------------------------------------------

def _kinds(text: str) -> tuple[tuple[str, str], ...]:
    """Elements as ``tag`` or ``tag.class.class``."""
    return tuple((x.split(".")[0], " ".join(x.split(".")[1:])) for x in text.split())


_MENU = _kinds("nav div.menu ul.nav.navbar div.breadcrumb header div.header.top div.skip.links div.navigation div.topbar div.masthead ul.submenu div.main-nav div.toolbar div.pagination")
_SIDE = _kinds("aside div.sidebar.widget div.related.posts section.related div.recommended div.newsletter.signup div.share.social div.tags div.teaser div.trending div.more-links div.rail div.author-box div.hidden")
_NOTICE = _kinds("div.cookie.notice div.consent.banner div.gdpr.popup div.alert.subscribe.modal dialog.cookie section.notice div.privacy-note div.paywall div.overlay div.warning.message div.hidden section.hidden")
_ADVERT = _kinds("div.ad div.ads.banner div.advert.sponsored ins.adsbygoogle section.promo div.advertisement aside.ad div.adslot div.adbox div.promotion div.sponsor div.hidden")
_COMMENTS = _kinds("section.comments div.comment.list div.disqus.thread ol.commentlist div.replies.comment div.user.reviews.comments div.discussion div.respond section.reader-comments div.responses")
_FOOT = _kinds("footer div.footer.bottom div.copyright div.site.footer.legal div.colophon div.imprint")
_FORM = _kinds("form form.search form.login form.contact div.form")
_MAIN = _kinds("article article.post main div.content div.post.body.entry div.article.text section.story div.main div section")
_SYLLABLES = "an be co do el fa go hi in ka lo me no or pa qu ra sa to un vi wa ye zu ér öl ñu ça ss th".split()


def _words(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choices(_SYLLABLES, k=rng.randrange(1, 4))) for _ in range(rng.randrange(low, high + 1))]
    return " ".join(words)


def _sentences(rng: random.Random, low: int, high: int) -> str:
    return " ".join(_words(rng, 3, 18).capitalize() + rng.choice(".....?!:") for _ in range(rng.randrange(low, high + 1)))


def labelled_page(rng: random.Random) -> tuple[str, list[str]]:
    """A page and its main text's blocks."""
    truth: list[str] = []

    def wrap(kind: tuple[str, str], inner: str) -> str:
        tag, names = kind
        if names == "hidden":
            return f"<{tag} {rng.choice(('hidden', 'aria-hidden="true"', 'style="display: none"'))}>{inner}</{tag}>"
        key = rng.choice(("class", "id")) if " " not in names else "class"
        return f"<{tag}{f' {key}="{names}"' if names else ''}>{inner}</{tag}>"

    def away(kind: tuple[str, str]) -> str:
        style = rng.randrange(5)
        if style == 0:
            inner = "<ul>" + "".join(f'<li><a href="/x">{_words(rng, 1, 4)}</a>{rng.choice(("", "</li>"))}' for _ in range(rng.randrange(2, 7))) + "</ul>"
        elif style == 1:
            inner = "".join(f"<p>{_sentences(rng, 1, 3)}</p>" for _ in range(rng.randrange(1, 4)))
        elif style == 2:
            inner = _sentences(rng, 1, 2)
        elif style == 3:
            inner = f"<h3>{_words(rng, 1, 4)}</h3>" + "".join(f'<div><a href="/x">{_words(rng, 1, 6)}</a> {_words(rng, 0, 3)}</div>' for _ in range(rng.randrange(1, 4)))
        else:
            inner = f"<span>{_words(rng, 1, 5)}</span> <a href='/y'>{_words(rng, 1, 3)}</a>"
        return wrap(kind, inner)

    def control(own: random.Random) -> str:
        if own.random() < 0.7:
            return f"<button>{_words(own, 1, 3).capitalize()}</button>"
        return "<datalist>" + "".join(f"<option>{_words(own, 1, 3)}" for _ in range(own.randrange(1, 5))) + "</datalist>"

    def keep(tag: str, text: str) -> str:
        truth.append(text)
        shown = html.escape(text, quote=False)
        style = rng.randrange(8)
        if style == 0:
            shown = f"<b>{shown}</b>"
        elif style == 1 and " " in shown:
            head, tail = shown.split(" ", 1)
            shown = f'<a href="/z">{head}</a> {tail}'
        elif style == 2 and tag == "p":
            return f"<p><b>{shown}<br>"  # left open, as pages have it
        return f"<{tag}>{shown}</{tag}>" if rng.random() < 0.9 or tag not in ("p", "li") else f"<{tag}>{shown}"

    body = []
    if rng.random() < 0.4:
        body.append(away(rng.choice(_NOTICE)))
    for _ in range(rng.randrange(0, 3)):
        body.append(away(rng.choice(_MENU)))
    if rng.random() < 0.5:
        body.append(away(rng.choice(_ADVERT)))
    inside = []
    if rng.random() < 0.7:
        inside.append(keep("h1", _words(rng, 1, 9).capitalize() + rng.choice(("", "."))))
    for _ in range(rng.randrange(0, 9)):
        kind = rng.random()
        if kind < 0.6:
            inside.append(keep("p", _sentences(rng, 1, 5)))
        elif kind < 0.66:
            inside.append(keep("h2", _words(rng, 1, 6).capitalize()))
        elif kind < 0.71:
            inside.append("<ul>" + "".join(keep("li", _words(rng, 1, 9)) for _ in range(rng.randrange(1, 5))) + "</ul>")
        elif kind < 0.74:
            inside.append("<table><tr>" + "".join(keep("td", _words(rng, 1, 4)) for _ in range(rng.randrange(1, 4))) + "</tr></table>")
        elif kind < 0.77:
            inside.append("<blockquote>" + keep("p", _sentences(rng, 1, 2)) + "</blockquote>")
        elif kind < 0.79:
            inside.append("<figure>" + keep("figcaption", _words(rng, 2, 9)) + "</figure>")
        elif kind < 0.81:
            inside.append("<pre>" + html.escape(code := _words(rng, 2, 9), quote=False) + "</pre>")
            truth.append(code)
        elif kind < 0.84:
            inside.append(keep("p", _words(rng, 1, 3) + rng.choice((".", ""))))
        else:
            inside.append(away(rng.choice((*_ADVERT, *_SIDE, *_FORM, *_COMMENTS, *_NOTICE))))
    own = random.Random("".join(inside))  # the layout's own draws go on as they were
    for _ in range(own.choice((0, 0, 0, 0, 0, 1, 2))):
        inside.insert(own.randrange(len(inside) + 1), control(own))
    if own.random() < 0.4:  # one short paragraph inside the article that only its element's name, or one word of it, tells apart
        tag, names = own.choice((*_COMMENTS, *_COMMENTS, *_ADVERT, *_SIDE, *_NOTICE))
        if names != "hidden":
            if " " in names and own.random() < 0.5:
                names = names.split()[0]
            key = "class" if " " in names else own.choice(("class", "id"))
            line = own.choice((_sentences(own, 1, 2), _words(own, 1, 3).capitalize() + "."))
            inside.insert(own.randrange(1, len(inside) + 2), f'<{tag} {key}="{names}">{own.choice((f"<p>{line}</p>", line))}</{tag}>' if names else "")
    inner = "".join(inside)
    if rng.random() < 0.3:
        inner = f'<div class="{rng.choice(("wrapper", "inner", "col", "text"))}">{inner}</div>'
    body.append(wrap(rng.choice(_MAIN), inner))
    for kinds, odds in ((_SIDE, 0.5), (_COMMENTS, 0.5), (_FORM, 0.3), (_ADVERT, 0.3), (_FOOT, 0.8)):
        if rng.random() < odds:
            block = away(rng.choice(kinds))
            if kinds is _FOOT and rng.random() < 0.5:
                block = wrap(rng.choice(_FOOT), f"&copy; {_words(rng, 1, 2)} &middot; {_sentences(rng, 1, 1)}")
            body.append(block)
    page = "".join(body)
    if rng.random() < 0.4:
        page = f'<div id="page">{page}</div>'
    head = f"<title>{_words(rng, 1, 5)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script>"
    return f"<!DOCTYPE html><html><head>{head}</head><body>{page}</body></html>", truth


def labelled(page: str, truth: list[str]) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page's blocks; truth is met in page order."""
    found, at, labels = blocks(page), 0, []
    for b in found:
        hit = at < len(truth) and b.text == _SPACE.sub(" ", truth[at]).strip()
        labels.append(int(hit))
        at += hit
    return [features(b, i / len(found)) for i, b in enumerate(found)], labels


@lru_cache(maxsize=1)
def trained(n_pages: int = TRAIN_PAGES, seed: int = 3) -> Chain:
    rng = random.Random(seed)
    return train([labelled(*labelled_page(rng)) for _ in range(n_pages)])


# --- pages ------------------------------------------------------------------------------


def main_text(page: str, chain: Chain) -> str:
    found = blocks(page)
    labels = chain.decode([features(b, i / len(found)) for i, b in enumerate(found)])
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, chain: Chain | None = None, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: page_id, the kept columns, text (main blocks joined by newlines), n_chars (code points).

    Null html counts as empty; pages without main text have an empty text. Null and repeated ids pass.
    Other columns are not read.
    """
    chain = chain or trained()

    def work():
        def texts_of(found: list) -> dict[str, pa.Array]:
            texts = [main_text(x, chain) for x in found]
            return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
        return texts_of

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), *keep, F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"))
    return computed(own, "__html", work, "text string, n_chars long")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
