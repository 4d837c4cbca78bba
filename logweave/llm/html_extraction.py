r"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements and, below them, the runs of text that they hold (inline
elements belong to the run; scripts, styles, markup and other text that isn't shown are no runs).
Every node is content or not. A node's potential comes from features of its tag, names, text and
links; parent-child potentials connect nodes. Sum-product messages, upward and downward, give each
run's marginal; runs of ``keep_at`` or more form the text, in page order.

Weights are trained on labelled pages by gradient ascent of the exact conditional likelihood (node
and edge marginals from the same messages). A labelled page marks content elements with the attribute
``data-content``, which is no feature. By default :func:`labelled_pages` composes ``Config.pages`` pages of
varied layouts.

Character references are decoded, white space within a run becomes one space, runs are joined by
``\n\n``. Null html is empty; a page without content gives an empty string. Pages are judged one by one:
repeated rows repeat their result, an empty table gives an empty result, extra columns are not read.
Pages of any length are read whole; a marginal that ties with ``keep_at`` is content. Unclosed tags and comments end with their parent or the page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweave.llm.common import read

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text isn't shown as text of the page; their content is skipped up to the end tag.
RAW = frozenset("script style template noscript textarea title iframe svg math select noframes xmp".split())
#: Of these, the ones that may close themselves, and that without an end tag are passed over as a tag only: what follows is read.
MARKUP = frozenset("template noscript svg math select".split())
#: A start tag of these ends an open p.
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split())
#: A start tag ends an open element of the second set, looked for up to an element of the third.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
TAGS = "body div p article main section nav header footer aside form ul ol li table tbody tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dt dd fieldset address center details summary button #text".split()
_TAG_AT = {t: k for k, t in enumerate(TAGS)}
#: Parts of class, id, role and other names, each a feature.
NAMES = (
    "nav menu breadcrumb header masthead banner head logo footer foot bottom copyright legal sidebar side rail aside widget related recommend more-from teaser promo sponsor ads advert adv-"
    " ad_ -ad cookie consent gdpr notice alert popup modal overlay subscribe newsletter signup login search form share social follow comment reply respond disqus discuss tag categor archive"
    " pager paginat prev next author byline meta date toolbar tool skip hidden print content article post entry story main body text page blog news"
).split()
_NAME = re.compile("|".join(map(re.escape, sorted(NAMES, key=len, reverse=True))))
_WHOLE_AD = re.compile(r"(?:^|[\s_-])ads?(?:$|[\s_-])")
_ATTR = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NAME_AT = re.compile(r"[a-zA-Z][^\s/>]*+")


@dataclass
class Page:
    """Nodes in page order, parents first; the root is node 0. Runs have their text, elements none."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["body"])
    names: list[str] = field(default_factory=lambda: [""])
    text: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])
    marked: list[bool] = field(default_factory=lambda: [False])


def _attributes(raw: str) -> tuple[str, bool]:
    """Class, id, role and the like in one lower-case string; and whether the element is marked as content."""
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}
    names = " ".join(got[k] for k in ("class", "id", "role", "itemprop", "aria-label") if k in got).lower()
    if "hidden" in got or got.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", got.get("style", "")):
        names += " hidden"
    return names, "data-content" in got


def parse(source: str) -> Page:
    p = Page()
    stack: list[tuple[str, int]] = [("body", 0)]  # open elements; inline ones have the node of their block
    run: list[str] = []
    run_linked, links, marks = 0, 0, 0

    def add(tag: str, parent: int, names: str, text: str | None, linked: int, marked: bool) -> int:
        p.parent.append(parent)
        p.depth.append(p.depth[parent] + 1)
        p.tag.append(tag)
        p.names.append(names)
        p.text.append(text)
        p.linked.append(linked)
        p.marked.append(marked)
        return len(p.parent) - 1

    def flush() -> None:
        nonlocal run_linked
        if run:
            text = "".join(run)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                add("#text", stack[-1][1], "", text, run_linked, marks > 0)
            run.clear()
        run_linked = 0

    def close(to: int) -> None:
        """Ends all open elements from place ``to`` of the stack on."""
        nonlocal links, marks
        if any(n not in INLINE for n, _ in stack[to:]):
            flush()
        while len(stack) > to:
            name, node = stack.pop()
            links -= name == "a"
            if name not in INLINE and p.marked[node]:
                marks -= 1

    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece = source[at:lt]
            run.append(piece)
            if links:
                run_linked += len(piece)
        if lt >= n:
            break
        two = source[lt + 1 : lt + 2]
        if two == "!" or two == "?":
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = source.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = two == "/"
        m = _NAME_AT.match(source, lt + 1 + closing)
        if not m:
            run.append("<")
            at = lt + 1
            continue
        name, at = m[0].lower(), m.end()
        end = source.find(">", at)
        raw = source[at : n if end < 0 else end]
        if end >= 0 and ('"' in raw or "'" in raw):
            end = _tag_end(source, at)
            raw = source[at : n if end < 0 else end]
        at = n if end < 0 else end + 1
        if closing:
            if name == "br":
                run.append(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if name in RAW:
            run.append(" ")
            if name in MARKUP and raw.endswith("/"):
                continue
            end = _raw_end(source, name, at)
            if end >= 0 or name not in MARKUP:
                at = n if end < 0 else end
            continue
        if name in VOID:
            if name == "hr":
                flush()
            run.append(" ")
            continue
        if name in ("html", "body", "head"):
            if name == "body":
                p.names[0], _ = _attributes(raw)
            continue
        if name in INLINE:
            if name == "a":
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "a":
                        stack.pop(k)
                        links -= 1
                        break
                links += 1
            stack.append((name, stack[-1][1]))
            continue
        flush()
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in IMPLIED:
            ends, limits = IMPLIED[name]
            lowest = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in limits:
                    break
                if stack[k][0] in ends:
                    lowest = k
            if lowest:
                close(lowest)
        while len(stack) > 1 and stack[-1][0] in INLINE and stack[-1][0] != "a":
            stack.pop()  # an inline element doesn't reach into the next block
        names, marked = _attributes(raw) if raw.strip(" /") else ("", False)
        node = add(name, stack[-1][1], names, None, 0, marked)
        marks += marked
        if not raw.endswith("/") or name in ("p", "div"):
            stack.append((name, node))
    flush()
    return p


def _tag_end(source: str, at: int) -> int:
    """The > that ends a tag, outside quotes of attribute values; the first > if quotes don't close."""
    k, first = at, source.find(">", at)
    while True:
        gt = source.find(">", k)
        if gt < 0:
            return first
        quote = re.compile(r"=\s*([\"'])").search(source, k, gt)
        if not quote:
            return gt
        k = source.find(quote[1], quote.end())
        if k < 0:
            return first
        k += 1


def _raw_end(source: str, name: str, at: int) -> int:
    """Behind the end tag of a raw element that began at ``at``."""
    while True:
        end = source.find("</", at)
        if end < 0:
            return -1
        if source[end + 2 : end + 2 + len(name)].lower() == name:
            gt = source.find(">", end)
            return -1 if gt < 0 else gt + 1
        at = end + 2


@dataclass(frozen=True)
class Config:
    #: Bound of the training pages.
    pages: int = 400
    steps: int = 220
    rate: float = 0.25
    ridge: float = 2e-4
    seed: int = 11
    keep_at: float = 0.5
    #: Pages whose messages are passed together.
    batch: int = 200


#: Places: tags, the parent's tag, names here and above, numbers by bucket.
_T, _N = len(TAGS), len(NAMES) + 2
_BUCKETS = 12
_NUMBERS = 8
PLACES = 1 + 2 * (_T + 1) + 3 * _N + 2 * _NUMBERS * _BUCKETS


def _bucket(x: float) -> int:
    return min(_BUCKETS - 1, int(x))


def features(p: Page) -> list[list[int]]:
    """The places of each node's indicators."""
    n = len(p.parent)
    size, linked, runs, stops = [0] * n, [0] * n, [0] * n, [0] * n
    for k in range(n - 1, 0, -1):
        if p.text[k] is not None:
            size[k], linked[k], runs[k] = len(p.text[k]), min(p.linked[k], len(p.text[k])), 1
            stops[k] = sum(map(p.text[k].count, ".!?"))
        up = p.parent[k]
        size[up] += size[k]
        linked[up] += linked[k]
        runs[up] += runs[k]
        stops[up] += stops[k]
    total, before = max(size[0], 1), 0
    named: list[list[int]] = []
    above: list[set[int]] = []
    out = []
    for k in range(n):
        own = sorted({NAMES.index(x) for x in _NAME.findall(p.names[k])}) if p.names[k] else []
        if p.names[k]:
            if _WHOLE_AD.search(p.names[k]):
                own.append(len(NAMES))
            own.append(len(NAMES) + 1)
        named.append(own)
        up = p.parent[k]
        above.append(above[up] | set(named[up]) | {-1 - _TAG_AT.get(p.tag[up], _T)} if k else set())
        leaf = p.text[k] is not None
        f = [0, 1 + _TAG_AT.get(p.tag[k], _T), 1 + (_T + 1) + (_TAG_AT.get(p.tag[up], _T) if k else _T)]
        base = 1 + 2 * (_T + 1)
        f += [base + x for x in own]
        if leaf:
            f += [base + _N + x for x in named[up]]
        f += [base + 2 * _N + x for x in above[k] if x >= 0]
        base += 3 * _N + (_NUMBERS * _BUCKETS if leaf else 0)
        density = linked[k] / max(size[k], 1)
        numbers = (
            np.log2(size[k] + 1),
            density * 10,
            min(10.0, 200.0 * stops[k] / max(size[k], 1)),
            np.log2(size[k] / max(runs[k], 1) + 1),
            10.0 * before / total,
            min(11.0, p.depth[k]),
            min(11.0, np.log2(runs[k] + 1) * 2),
            10.0 * size[k] / total,
        )
        f += [base + j * _BUCKETS + _bucket(x) for j, x in enumerate(numbers)]
        if leaf:
            before += size[k]
        out.append(f)
    return out


@dataclass
class Forest:
    """The trees of several pages, and their indicators."""

    parent: np.ndarray
    levels: list[np.ndarray]
    node: np.ndarray
    place: np.ndarray
    kind: np.ndarray


def forest(pages: list[Page]) -> Forest:
    parent, depth, node, place, kind, base = [], [], [], [], [], 0
    for p in pages:
        f = features(p)
        parent += [x + base if x >= 0 else -1 for x in p.parent]
        depth += p.depth
        kind += [x is not None for x in p.text]
        place += [y for x in f for y in x]
        node.append(np.repeat(np.arange(base, base + len(f)), [len(x) for x in f]))
        base += len(f)
    d = np.array(depth, np.int64)
    order = np.argsort(d, kind="stable")
    cuts = np.searchsorted(d[order], np.arange(d.max(initial=0) + 2))
    return Forest(np.array(parent), [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], np.concatenate(node or [np.zeros(0, np.int64)]), np.array(place, np.int64), np.array(kind, np.int64))


@dataclass
class Model:
    #: Log-odds of content for each place.
    weight: np.ndarray
    #: Log potentials by kind of child (element, run), parent's state, child's state.
    edge: np.ndarray

    def messages(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of each node's states, and of (parent's state, own state)."""
        n = len(f.parent)
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(f.node, self.weight[f.place], n)
        to_parent = np.zeros((n, 2))
        for level in reversed(f.levels[1:]):
            x = self.edge[f.kind[level]] + up[level][:, None, :]
            to_parent[level] = np.logaddexp(x[:, :, 0], x[:, :, 1])
            np.add.at(up, f.parent[level], to_parent[level])
        belief, pair = up.copy(), np.zeros((n, 2, 2))
        for level in f.levels[1:]:
            rest = belief[f.parent[level]] - to_parent[level]
            joint = rest[:, :, None] + self.edge[f.kind[level]] + up[level][:, None, :]
            belief[level] = np.logaddexp(joint[:, 0], joint[:, 1])
            pair[level] = np.exp(joint - joint.max((1, 2), keepdims=True))
            pair[level] /= pair[level].sum((1, 2), keepdims=True)
        m = np.exp(belief - belief.max(1, keepdims=True))
        return m / m.sum(1, keepdims=True), pair


def truth(p: Page) -> np.ndarray:
    """Labels of a labelled page's nodes: a run's mark; an element is content if most of its text is."""
    n = len(p.parent)
    good, size = np.zeros(n), np.zeros(n)
    for k in range(n - 1, -1, -1):
        if p.text[k] is not None:
            size[k] = len(p.text[k])
            good[k] = size[k] * p.marked[k]
        if k:
            good[p.parent[k]] += good[k]
            size[p.parent[k]] += size[k]
    return (good * 2 > size).astype(np.int64)


def fit(sources: list[str], c: Config = Config()) -> Model:
    """Weights from labelled pages."""
    pages = [parse(x) for x in sources]
    f, y = forest(pages), np.concatenate([truth(p) for p in pages])
    m = Model(np.zeros(PLACES), np.zeros((2, 2, 2)))
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (f.kind[child], y[f.parent[child]], y[child]), 1)
    counts = np.bincount(f.place, y[f.node], PLACES)
    n, first, second = len(y), {}, {}
    for step in range(1, c.steps + 1):
        marginal, pair = m.messages(f)
        got = np.zeros((2, 2, 2))
        for kind in (0, 1):
            got[kind] = pair[child[f.kind[child] == kind]].sum(0)
        grads = {"weight": (counts - np.bincount(f.place, marginal[f.node, 1], PLACES)) / n - c.ridge * m.weight, "edge": (seen - got) / n - c.ridge * m.edge}
        for k, g in grads.items():
            first[k] = 0.9 * first.get(k, 0) + 0.1 * g
            second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
            pace = c.rate * (1 - 0.8 * step / c.steps)
            setattr(m, k, getattr(m, k) + pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8))
    return m


def labelled_pages(n: int, seed: int) -> list[str]:
    """Composed pages of many layouts, content marked: articles among menus, notices, adverts, forms, comments."""
    rng = np.random.default_rng(seed)
    pick = lambda *a: a[rng.integers(len(a))]
    chance = lambda x: rng.random() < x
    syllables = "th er on an re le ung eau ción sch wh ing a o st mi ka de en is to la that and for not".split()
    word = lambda: "".join(pick(*syllables) for _ in range(rng.integers(1, 4)))
    phrase = lambda lo, hi: " ".join(word() for _ in range(rng.integers(lo, hi))).capitalize()
    junk = lambda w: w + pick("***", "###", "$$$", "&amp;&amp;&amp;", "%%%")

    def prose(lo: int, hi: int) -> str:
        style, out = rng.random(), []
        for _ in range(rng.integers(lo, hi)):
            s = phrase(3, 18)
            if style < 0.08:
                s = " ".join(map(junk, s.split()))
            elif style < 0.12:
                s = "!! ".join(s.upper().split()) + "!!"
            elif style < 0.16:
                s = " | ".join(s.split())
            out.append(s + pick(".", ".", ".", "!", "?"))
        return " ".join(out)

    def rich(text: str) -> str:
        words = text.split(" ")
        for _ in range(rng.integers(0, 3)):
            k = rng.integers(len(words))
            words[k] = pick('<a href="/{0}">{0}</a>', "<b>{0}</b>", "<em>{0}</em>", "<span>{0}</span>", "{0}<br>", "{0}<b>").format(words[k])
        return " ".join(words)

    def links(k: int, sep: str = "") -> str:
        return sep.join(f'<li><a href="/{word()}">{phrase(1, 4)}</a></li>' for _ in range(k))

    def wrap(tags: tuple, names: tuple, inner: str) -> str:
        tag, name = pick(*tags), pick(*names) if chance(0.75) else ""
        attr = f' {pick("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{attr}>{inner}</{tag}>"

    def menu() -> str:
        inner = f"<ul>{links(rng.integers(1, 9))}</ul>" if chance(0.7) else " ".join(f'<a href="/{word()}">{phrase(1, 3)}</a>' for _ in range(rng.integers(2, 8)))
        return wrap(("nav", "nav", "div", "ul"), ("menu", "navbar", "main-nav", "breadcrumbs", "topmenu", "navigation"), inner)

    def head() -> str:
        return wrap(("header", "header", "div"), ("header", "masthead", "site-header", "top-bar", "banner"), f"<a href='/'>{phrase(1, 4)}</a>" + (f"<p>{phrase(2, 9)}</p>" if chance(0.6) else "") + (menu() if chance(0.4) else ""))

    def foot() -> str:
        tail = pick(f"&copy; {word()}.example.com &middot; {prose(1, 3)}", f"<p>{phrase(2, 12)}.</p>", f"<ul>{links(rng.integers(2, 6))}</ul>", f"Copyright 20{rng.integers(10, 26)} {phrase(1, 5)}", f"&copy; {prose(1, 4)}")
        return wrap(("footer", "footer", "div"), ("footer", "site-footer", "foot", "bottom", "legal"), tail)

    def side() -> str:
        body = f"<h3>{phrase(1, 4)}</h3>" + pick(f"<ul>{links(rng.integers(2, 8))}</ul>", f"<p>{prose(1, 3)}</p>", f"<div><a href='/x'>{phrase(3, 9)}</a><p>{phrase(4, 12)}.</p></div>" * 2)
        return wrap(("aside", "aside", "div", "section"), ("sidebar", "widget", "related", "rail", "side-column", "recommended", "trending"), body)

    def advert() -> str:
        return f"<div class=\"{pick('ad', 'ad', 'ads', 'advert', 'ad-slot', 'sponsored', 'promo', 'banner-ad', 'advertisement')}\">{pick(prose(1, 3), phrase(2, 8), f'<a href=/x>{phrase(3, 8)}</a>', f'<p>{prose(1, 2)}</p>')}</div>"

    def notice() -> str:
        body = f"<p>{prose(1, 3)}</p>" + (f"<button>{phrase(1, 3)}</button>" if chance(0.6) else "")
        return f"<{(t := pick('div', 'section', 'aside'))} class=\"{pick('cookie-notice', 'notice', 'alert', 'consent', 'gdpr', 'popup', 'cookie-banner', 'site-notice', 'modal')}\">{body}</{t}>"

    def form() -> str:
        inner = pick(f"<label>{phrase(1, 3)}</label><input name=q>", f"<p>{prose(1, 2)}</p><input type=email>") + f"<button>{phrase(1, 3)}</button>"
        return wrap(("form", "form", "form"), ("search", "newsletter", "subscribe", "login", "signup"), inner) if chance(0.7) else f"<div class=newsletter><h4>{phrase(2, 5)}</h4><form>{inner}</form></div>"

    def comments() -> str:
        items = "".join(f"<{(t := pick('div', 'li', 'article'))} class=\"{pick('comment', 'comment-body', 'reply')}\"><{(h := pick('b', 'h4', 'span'))}>{phrase(1, 3)}</{h}><p>{prose(1, 5)}</p></{t}>" for _ in range(rng.integers(1, 6)))
        return f"<{(t := pick('section', 'div', 'ol'))} {pick('id', 'class')}=\"{pick('comments', 'comment-list', 'discussion', 'responses', 'disqus_thread', 'reader-comments')}\">" + (f"<h3>{phrase(1, 3)}</h3>" if chance(0.6) else "") + items + f"</{t}>"

    def extra() -> str:
        return pick(
            f'<div class="share"><a href=/a>{phrase(1, 2)}</a> <a href=/b>{phrase(1, 2)}</a></div>', f'<div class="meta">{phrase(1, 4)} &middot; 12 {phrase(1, 2)}</div>', f"<script>var t='</p>{word()}';</script>",
            f'<div class="tags">{" ".join(f"<a href=/t>{word()}</a>" for _ in range(4))}</div>', "<style>p{margin:0}</style>", f'<div class="pagination"><a href=/1>1</a> <a href=/2>2</a> {phrase(1, 2)}</div>', f"<!-- {phrase(2, 5)} -->",
        )

    def block() -> str:
        roll = rng.random()
        if roll < 0.68:
            inner = rich(prose(1, 8)) if chance(0.9) else phrase(1, 4) + "."
            return f"<p data-content>{inner}" + ("</p>" if chance(0.9) else "")
        if roll < 0.78:
            return f"<h{(k := rng.integers(2, 5))} data-content>{phrase(1, 9)}</h{k}>"
        if roll < 0.85:
            return f"<{(t := pick('ul', 'ol'))} data-content>{''.join(f'<li>{rich(phrase(2, 14))}{pick(".", "")}</li>' for _ in range(rng.integers(2, 7)))}</{t}>"
        if roll < 0.90:
            return f"<blockquote data-content>{pick('<p>{}</p>', '{}').format(prose(1, 3))}</blockquote>"
        if roll < 0.93:
            return f"<pre data-content>{phrase(3, 12)}</pre>"
        if roll < 0.96:
            return "<table data-content>" + "".join(f"<tr><td>{phrase(1, 4)}</td><td>{phrase(1, 6)}</td></tr>" for _ in range(rng.integers(2, 5))) + "</table>"
        return f"<figure data-content><img src=x><figcaption>{phrase(2, 9)}.</figcaption></figure>"

    def main() -> str:
        long = rng.random()
        count = rng.integers(0, 3) if long < 0.2 else rng.integers(2, 10) if long < 0.8 else rng.integers(8, 26)
        title = phrase(2, 14)
        parts = [f"<h1 data-content>{title}{pick('', '.', '&amp;&amp;')}</h1>"] if chance(0.85) else []
        if parts and chance(0.4):
            parts.append(f"<p data-content><b>{title} {prose(1, 4)}<br>")
        for _ in range(count):
            parts.append(block())
            if chance(0.07):
                parts.append(pick(advert, extra, extra, form, side)())
        if chance(0.2):
            parts.append(extra())
        if chance(0.15):
            parts.append(pick(comments, side, foot)())
        if not count and len(parts) < 2:
            parts.append(f"<p data-content>{prose(1, 6)}</p>")
        inner = "".join(parts)
        if chance(0.3):
            inner = f"<div{pick('', ' class=body', ' class=inner')}>{inner}</div>"
        return wrap(("article", "article", "article", "main", "div", "section"), ("content", "post", "article-body", "entry-content", "story", "main", "page-text"), inner)

    def page() -> str:
        top = [f() for f, x in ((notice, 0.25), (head, 0.45), (menu, 0.7), (advert, 0.5), (form, 0.15), (side, 0.1)) if chance(x)]
        low = [f() for f, x in ((comments, 0.35), (side, 0.35), (advert, 0.2), (form, 0.2), (extra, 0.3), (foot, 0.8), (notice, 0.15)) if chance(x)]
        body = "".join([*top, main(), *low])
        if chance(0.3):
            body = f"<div{pick('', ' id=page', ' class=wrapper', ' class=container')}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{phrase(2, 9)}</title></head><body>{body}</body></html>"

    return [page() for _ in range(n)]


@lru_cache(maxsize=4)
def trained(c: Config = Config()) -> Model:
    return fit(labelled_pages(c.pages, c.seed), c)


def main_texts(sources: list[str | None], model: Model, c: Config = Config()) -> list[str]:
    """The main text of each page."""
    out = []
    for at in range(0, len(sources), c.batch):
        pages = [parse(x or "") for x in sources[at : at + c.batch]]
        marginal, base = model.messages(forest(pages))[0][:, 1], 0
        for p in pages:
            keep = marginal[base : base + len(p.parent)] >= c.keep_at
            out.append("\n\n".join(t for t, k in zip(p.text, keep, strict=True) if t is not None and k))
            base += len(p.parent)
    return out


def extract(pages: DataFrame, model: Model, c: Config = Config()) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, c.batch):
                part = batch.slice(at, c.batch)
                text = main_texts(part.column(2).to_pylist(), shared.value, c)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"), trained())


QUERIES = {"op2_html_extraction": op2_html_extraction}
ORACLES: dict[str, str] = {}
