"""Main-text extraction from HTML: boosted trees over DOM-node features, decoded top-down.

A lenient parser makes a tree of block elements; inline elements only add text (and link text) to the block they stand in.
Every block gets features of its own: its text, links and punctuation, the same for its whole subtree (density of text over
tags), depth and place, its siblings (how many, of the same tag, how long), and categories of its attribute tokens and of
those of its ancestors. Boosted trees turn them into log-odds of being main text.

Decoding labels whole paths at once. From the root down, a node is mixed, then main, then boilerplate; a main node never
stands below a boilerplate one and a mixed one never below either, so that no answer contradicts its ancestor's. Dynamic
programming over the tree finds the labelling of least total cost. The text runs of main nodes, in page order, are the blocks.

The trees are fitted on pages made up here (TRAIN_PAGES of them, seeded): articles of several layouts with menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around and inside them, under telling, misleading or random
attribute names.

Defined results: a null or empty page has an empty text; malformed markup is read as far as it goes; repeated rows get equal
results; an empty table gives an empty result. Only the columns named are read. Nothing is dropped or capped by size.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm import boosting
from lattica.llm.common import small_batches, text_slices

TRAIN_PAGES = 700

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。]")

#: Elements whose content isn't text of the page: code, the head and titles, embedded pages, and controls of forms. Others that
#: aren't listed here, such as math, noscript and svg, are inline: their text stays, wherever they are left open.
RAW = {"script", "style", "template", "iframe", "textarea", "select", "head", "title"}
#: Of these, raw text: without an end tag they hold the rest of the page. The others then hold nothing.
TO_THE_END = ("script", "style", "textarea", "iframe")
#: Elements that may stand in a head; any other ends it, as text does.
IN_HEAD = {"title", "meta", "link", "base", "script", "style", "noscript", "template"}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "track", "wbr", "col", "area", "base", "embed", "param"}
#: Elements that start a block of their own; all others are inline.
BLOCKS = (
    "p", "div", "li", "ul", "ol", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "tbody", "thead", "tfoot",
    "tr", "td", "th", "nav", "header", "footer", "aside", "form", "fieldset", "figure", "figcaption", "dl", "dt", "dd", "body", "html", "address", "details",
    "summary", "caption", "button", "label", "dialog", "menu", "center", "hgroup", "search",
)
NUMBER = {t: i for i, t in enumerate(BLOCKS)}
#: An element closes these when it opens directly inside them.
CLOSES_P = set(BLOCKS) - {"button", "label"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

#: Categories of attribute tokens; one that ends in * is a beginning.
CATEGORIES = {
    "content": "article content post entry story main text prose body articlebody blogpost richtext copy page single",
    "nav": "nav* menu* breadcrumb* toc pagination pager tabs topbar sitemap skip links toolbar",
    "head": "header masthead banner logo branding hero top",
    "foot": "foot* copyright colophon legal bottom imprint",
    "side": "side* aside rail widget* related recommend* trending popular recirc* teaser* more latest",
    "notice": "cookie* consent notice* alert* popup modal overlay gdpr paywall disclaimer newsletter subscri* signup toast message warning",
    "ad": "ad ads adv advert* adslot sponsor* promo* dfp outbrain taboola commercial adsense adbox",
    "comment": "comment* disqus respond reply replies discussion review* feedback thread",
    "form": "form search login signin register input contact survey poll",
    "share": "share sharing social follow rating vote tags like tweet author byline meta",
    "hidden": "hidden invisible offscreen sr",
}
BIT = {name: 1 << i for i, name in enumerate(CATEGORIES)}
_WORDS = {w: BIT[name] for name, line in CATEGORIES.items() for w in line.split() if not w.endswith("*")}
_STARTS = [(w[:-1], BIT[name]) for name, line in CATEGORIES.items() for w in line.split() if w.endswith("*")]
TAG_BITS = {
    "nav": BIT["nav"], "menu": BIT["nav"], "header": BIT["head"], "footer": BIT["foot"], "aside": BIT["side"], "form": BIT["form"], "button": BIT["form"], "search": BIT["form"],
    "label": BIT["form"], "fieldset": BIT["form"], "article": BIT["content"], "main": BIT["content"], "dialog": BIT["notice"],
}
ROLES = {"navigation": "nav", "banner": "head", "contentinfo": "foot", "complementary": "side", "search": "form", "main": "content", "article": "content", "alert": "notice", "dialog": "notice"}


@lru_cache(1 << 16)
def token_bits(value: str) -> int:
    bits = 0
    for word in TOKEN.findall(value):
        word = word.lower()
        bits |= _WORDS.get(word, 0)
        for start, bit in _STARTS:
            if word.startswith(start):
                bits |= bit
    return bits


def attribute_bits(attrs: str) -> tuple[int, str]:
    """Categories of an element's attributes; the value of data-y, which only made-up training pages have."""
    bits, truth = 0, ""
    for name, a, b, c, hidden in ATTRIBUTE.findall(attrs):
        value, name = a or b or c, name.lower()
        if name in ("class", "id", "itemprop", "data-role", "data-component", "data-testid", "aria-label"):
            bits |= token_bits(value) if len(value) <= 200 else token_bits.__wrapped__(value)  # long ones aren't cached
        elif name == "role":
            bits |= BIT.get(ROLES.get(value.lower(), ""), 0)
        elif hidden or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            bits |= BIT["hidden"]
        elif name == "data-y":
            truth = value
    return bits, truth


@dataclass
class Page:
    """Block elements in document order; a node's subtree is the range from it to its end."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)  # categories of all ancestors
    nearest: list[int] = field(default_factory=list)  # of the nearest ancestor that has any
    end: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)  # among its siblings
    children: list[int] = field(default_factory=list)
    truth: list[str] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)  # (node, text), page order
    links: list[int] = field(default_factory=list)  # characters of link text, own


@cache
def _tags_of(name: str) -> re.Pattern:
    """Start and end tags of an element, outside comments and raw text."""
    raw = "|".join(TO_THE_END)
    skipped = rf"<!--.*?(?:-->|\Z)|<(?P<raw>{raw})(?=[\s/>]).*?(?:</(?P=raw)(?=[\s/>])|\Z)|"
    return re.compile(skipped + rf"<(?P<close>/?){name}(?=[\s/>])(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>", re.IGNORECASE | re.DOTALL)


TITLE_END = re.compile(r"</title(?=[\s/>])[^>]*>", re.IGNORECASE)


class Ends:
    """Where the content of an element ends, by its name and the end of its start tag; one pass over the page for each name."""

    def __init__(self, source: str):
        self.source, self.known, self.titled = source, {}, True

    def after(self, name: str, at: int) -> int | None:
        """Behind the end tag of the element whose start tag ends at `at`; None without an end tag."""
        if name in TO_THE_END:
            m = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(self.source, at)
            return m.end() if m else len(self.source)
        if name == "title":  # its text is raw, too
            m = TITLE_END.search(self.source, at) if self.titled else None
            self.titled = m is not None
            return m.end() if m else None
        if name not in self.known:
            ends, ahead = {}, []
            for m in _tags_of(name).finditer(self.source):
                if m["close"] == "":
                    if not m[0].endswith("/>"):
                        ahead.append(m.end())
                elif m["close"] and ahead:
                    ends[ahead.pop()] = m.end()
            self.known[name] = ends
        return self.known[name].get(at)

    def after_head(self, at: int) -> int:
        """Behind </head>, or before the first thing that can't stand in a head."""
        while m := TAG.search(self.source, at):
            if self.source[at : m.start()].strip():
                return at
            name, closing = (m["name"] or m["name2"] or "").lower(), bool(m["close"] or m["close2"])
            if closing and name == "head":
                return m.end()
            if name and not closing and name not in IN_HEAD:
                return m.start()
            at = m.end()
            if not closing and name in ("title", "script", "style", "noscript", "template"):
                at = self.after(name, at) or at
        return at


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    text: list[str] = []
    in_link = 0
    open_now = [0] * len(BLOCKS)  # elements of each tag on the stack, the page itself aside

    def flush() -> None:
        if text:
            line = "".join(text)
            text.clear()
            if "&" in line:
                line = entities.unescape(line)
            line = " ".join(line.split())
            if line:
                page.runs.append((stack[-1], line))

    def push(name: str, bits: int, truth: str) -> None:
        up = stack[-1] if stack else -1
        at = len(page.tag)
        page.tag.append(NUMBER[name])
        page.parent.append(up)
        page.depth.append(len(stack))
        own = bits | TAG_BITS.get(name, 0)
        page.own.append(own)
        page.above.append(page.own[up] | page.above[up] if up >= 0 else 0)
        page.nearest.append(page.own[up] or page.nearest[up] if up >= 0 else 0)
        page.end.append(-1)
        page.place.append(page.children[up] if up >= 0 else 0)
        page.children.append(0)
        page.truth.append(truth or (page.truth[up] if up >= 0 else ""))
        page.links.append(0)
        if up >= 0:
            page.children[up] += 1
            open_now[NUMBER[name]] += 1
        stack.append(at)

    def pop() -> None:
        flush()
        x = stack.pop()
        page.end[x] = len(page.tag)
        open_now[page.tag[x]] -= 1

    push("html", 0, "")
    at, size, ends = 0, len(source), Ends(source)
    while at < size:
        m = TAG.search(source, at)
        stop = m.start() if m else size
        if stop > at:
            piece = source[at:stop]
            text.append(piece)
            if in_link:
                page.links[stack[-1]] += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m["close"] or m["close2"]), m["attrs"] or m["attrs2"] or ""
        if name in RAW and not closing:
            if not attrs.endswith("/"):
                at = ends.after_head(at) if name == "head" else ends.after(name, at) or at
            text.append(" ")
        elif name in VOID:
            text.append(" ")
            if name == "hr":
                flush()
        elif name in NUMBER:
            if closing:
                in_link = 0
                if open_now[NUMBER[name]]:
                    while page.tag[stack[-1]] != NUMBER[name]:
                        pop()
                    pop()
                else:
                    flush()
                continue
            flush()
            if name in ("html", "body") and len(stack) <= 2 and (name == "html" or len(stack) == 2):
                continue
            if name in CLOSES_P and BLOCKS[page.tag[stack[-1]]] == "p":
                pop()
            while len(stack) > 1 and BLOCKS[page.tag[stack[-1]]] in CLOSES.get(name, ()):
                pop()
            push(name, *(attribute_bits(attrs) if attrs.strip() else (0, "")))
        elif name == "a":
            in_link = 0 if closing else 1
    while stack:
        pop()
    return page


N_CATEGORIES = len(CATEGORIES)
GROUPS = [
    ("p",), ("div", "center"), ("li",), ("ul", "ol", "dl", "dt", "dd"), ("section",), ("article", "main"), ("h1",), ("h2", "h3", "h4", "h5", "h6", "hgroup", "caption"),
    ("blockquote", "pre", "figcaption", "figure"), ("table", "tbody", "thead", "tfoot", "tr"), ("td", "th"), ("nav", "menu"), ("header",), ("footer", "address"), ("aside",),
    ("form", "fieldset", "button", "label", "search", "dialog"),
]
_GROUP = np.zeros((len(BLOCKS), len(GROUPS)), np.float32)
for _i, _names in enumerate(GROUPS):
    for _name in _names:
        _GROUP[NUMBER[_name], _i] = 1


def features(pages: list[Page]) -> np.ndarray:
    """One row per node of all pages."""
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    sizes = np.array([len(p.tag) for p in pages])
    first = np.cumsum(sizes) - sizes
    page_of = np.repeat(np.arange(len(pages)), sizes)
    base = first[page_of]
    n = int(sizes.sum())
    parent, end = flat("parent"), flat("end") + base
    parent = np.where(parent >= 0, parent + base, -1)
    tag, depth, own, above, nearest, place, children, links = (flat(x) for x in ("tag", "depth", "own", "above", "nearest", "place", "children", "links"))
    chars, words, marks, capital, runs = (np.zeros(n) for _ in range(5))
    for p, at in zip(pages, first.tolist(), strict=True):
        for node, line in p.runs:
            x = at + node
            chars[x] += len(line)
            words[x] += line.count(" ") + 1
            marks[x] += len(PUNCTUATION.findall(line))
            capital[x] += line[-1] in ".!?…。:\"'”»)"
            runs[x] += 1
    ones = np.ones(n)
    under = {}
    for name, value in (("chars", chars), ("words", words), ("marks", marks), ("links", links), ("tags", ones), ("runs", runs)):
        total = np.concatenate(([0.0], np.cumsum(value)))
        under[name] = total[end] - total[:-1]
        if name == "chars":
            before = (total[:-1] - total[base]) / np.maximum(1, total[(first + sizes)[page_of]] - total[base])
    ratio = lambda a, b: a / np.maximum(1, b)
    up = np.maximum(parent, 0)
    siblings = children[up]
    same = np.unique(np.stack([page_of, parent, tag], axis=1), axis=0, return_inverse=True, return_counts=True)
    same_tag = same[2][same[1].ravel()]
    around = ratio(under["chars"][up] - chars[up], siblings)
    deepest = np.maximum.reduceat(depth, first)[page_of]
    columns = [
        np.log1p(chars), np.log1p(words), ratio(links, chars), ratio(marks, words), ratio(chars, words), ratio(capital, runs),
        np.log1p(under["chars"]), np.log1p(under["tags"]), ratio(under["chars"], under["tags"]), ratio(under["links"], under["chars"]),
        ratio(under["marks"], under["words"]), ratio(under["words"], under["runs"]), ratio(under["chars"], under["chars"][base]),
        depth, ratio(depth, deepest), before, siblings, place, ratio(same_tag, siblings), np.log1p(around), under["chars"] / np.maximum(1, around),
        ratio(under["links"][up], under["chars"][up]), np.log1p(under["chars"][up]), children,
    ]
    bits = [((v >> i) & 1).astype(np.float32) for v in (own, above, nearest) for i in range(N_CATEGORIES)]
    return np.concatenate([np.stack([*columns, *bits], axis=1).astype(np.float32), _GROUP[tag], _GROUP[tag[up]]], axis=1)


# Costs of decoding: entering main text below a mixed node, and boilerplate inside main text; a node without text counts less.
ENTER_MAIN, LEAVE_MAIN, BARE = 0.8, 1.2, 0.4
MIXED, MAIN, BOILERPLATE = 0, 1, 2


def decode(page: Page, margin: np.ndarray) -> list[int]:
    """The labelling of least cost among those in which labels never fall from parent to child."""
    n = len(page.tag)
    has_text = [False] * n
    for node, _ in page.runs:
        has_text[node] = True
    z = np.clip(margin, -8, 8)
    weight = np.where(has_text, 1.0, BARE)
    main = (weight * np.log1p(np.exp(-z))).tolist()
    rest = (weight * np.log1p(np.exp(z))).tolist()
    mixed = [r if t else 0.0 for r, t in zip(rest, has_text, strict=True)]  # a mixed node's own text is left out
    parent = page.parent
    for x in range(n - 1, 0, -1):
        up = parent[x]
        b = rest[x]
        rest[up] += b
        main[up] += min(main[x], b + LEAVE_MAIN)
        mixed[up] += min(mixed[x], main[x] + ENTER_MAIN, b)
    out = [MIXED] * n
    for x in range(n):
        up = out[parent[x]] if x else MIXED
        if up == BOILERPLATE:
            out[x] = BOILERPLATE
        elif up == MAIN:
            out[x] = MAIN if main[x] <= rest[x] + LEAVE_MAIN else BOILERPLATE
        else:
            costs = (mixed[x], main[x] + ENTER_MAIN, rest[x])
            least = min(costs)
            out[x] = MAIN if costs[1] <= least else MIXED if costs[0] <= least else BOILERPLATE
    return out


def _made_up(rng: random.Random) -> str:
    """A page with data-y="1" on main text and data-y="0" on boilerplate."""
    syllables = ["ka", "lo", "mi", "ter", "an", "es", "ro", "vi", "tion", "el", "du", "sch", "er", "la", "é", "ño", "pra", "su", "be", "qu"]
    word = lambda: "".join(rng.choices(syllables, k=rng.choice((1, 1, 2, 2, 3, 4))))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))

    def sentences(k: int) -> str:
        return " ".join(re.sub(r" (\w+)$", r", \1", phrase(4, 18)).capitalize() + rng.choice("....!?") for _ in range(k))

    style = rng.random()
    clutter = rng.choice((0.0, 0.4, 0.8, 1.0, 1.0))  # how much boilerplate a page has, against the usual
    noise = lambda: "".join(rng.choices("abcdefghijkmnopqrstuvwxyz", k=rng.randint(3, 7))) + rng.choice(("", "-", "__")) + str(rng.randint(1, 99))

    def named(*names: str) -> str:
        """An attribute with a telling name, or with a random one on pages of the plain style."""
        if style < 0.25 or rng.random() < 0.12:
            return f' class="{noise()}"' if rng.random() < 0.6 else ""
        name = rng.choice(names) + rng.choice(("", "", "", "-wrapper", "-box", "-area", " clearfix", "-1", "_inner"))
        return f' {rng.choice(("class", "class", "id"))}="{name}"'

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{word()}">{phrase(1, 4)}</a></li>' for _ in range(k))

    def block(kind: str) -> str:
        y = ' data-y="0"'
        if kind == "nav":
            tag = rng.choice(("nav", "div", "ul", "div"))
            inner = links(rng.randint(2, 10))
            if rng.random() < 0.2:
                inner = rng.choice((" | ", " / ", " ")).join(f'<a href="#">{phrase(1, 2)}</a>' for _ in range(5))
            return f"<{tag}{named('nav', 'menu', 'navbar', 'breadcrumbs', 'main-menu', 'pagination', 'toc', 'topbar')}{y}>{inner if tag == 'ul' else f'<ul>{inner}</ul>'}</{tag}>"
        if kind == "head":
            tag = rng.choice(("header", "header", "div"))
            return f"<{tag}{named('header', 'masthead', 'site-header', 'branding', 'top-banner')}{y}><{(h := rng.choice(('h1', 'div', 'p', 'span')))}>{phrase(1, 4)}</{h}><p>{phrase(2, 8)}</p>{block('nav') if rng.random() < 0.4 else ''}</{tag}>"
        if kind == "foot":
            tag = rng.choice(("footer", "footer", "div"))
            inner = f"&copy; {rng.randint(1999, 2026)} {phrase(1, 4)}" + rng.choice(("", f" &middot; <a href='/'>{phrase(1, 2)}</a>", f"<p>{sentences(1)}</p>", f"<ul>{links(4)}</ul>"))
            return f"<{tag}{named('footer', 'site-footer', 'copyright', 'legal', 'colophon', 'bottom')}{y}>{inner}</{tag}>"
        if kind == "side":
            tag = rng.choice(("aside", "aside", "div", "section"))
            inner = "".join(rng.choice((f"<h3>{phrase(1, 4)}</h3>", f"<p>{sentences(1)}</p>", f"<ul>{links(rng.randint(2, 6))}</ul>", f"<p>{phrase(3, 9)}</p>")) for _ in range(rng.randint(1, 5)))
            return f"<{tag}{named('sidebar', 'widget', 'related', 'related-posts', 'recommended', 'trending', 'side-column', 'popular')}{y}>{inner}</{tag}>"
        if kind == "notice":
            return f"<div{named('cookie-banner', 'cookie-notice', 'consent', 'notice', 'alert', 'newsletter', 'subscribe-box', 'popup', 'gdpr', 'paywall', 'modal')}{y}><p>{sentences(rng.randint(1, 3))}</p>{f'<button>{phrase(1, 2)}</button>' if rng.random() < 0.6 else ''}</div>"
        if kind == "ad":
            tag = rng.choice(("div", "div", "aside", "section", "p"))
            inner = rng.choice((sentences(rng.randint(1, 3)), f"<a href='/x'>{phrase(3, 9)}</a>", f"<p>{sentences(1)}</p><a href='/x'>{phrase(1, 3)}</a>")) if tag != "p" else sentences(rng.randint(1, 2))
            return f"<{tag}{named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'sponsor')}{y}>{inner}</{tag}>"
        if kind == "comment":
            tag, one = rng.choice(("section", "div", "div", "ol")), rng.choice(("div", "article", "li"))
            inner = "".join(f"<{one}{named('comment', 'comment-body', 'reply', 'review')}><b>{phrase(1, 2)}</b><p>{sentences(rng.randint(1, 4))}</p></{one}>" for _ in range(rng.randint(1, 6)))
            return f"<{tag}{named('comments', 'comment-list', 'disqus_thread', 'respond', 'discussion', 'reviews')}{y}>{f'<h3>{phrase(1, 3)}</h3>' if rng.random() < 0.6 and tag != 'ol' else ''}{inner}</{tag}>"
        if kind == "form":
            return f"<form{named('search', 'search-form', 'login', 'contact-form', 'signup')}{y}><label>{phrase(1, 3)}</label><input name='q'><p>{phrase(2, 8)}</p><button>{phrase(1, 2)}</button></form>"
        return f"<div{named('share', 'social', 'share-buttons', 'tags', 'follow-us')}{y}>" + " ".join(f"<a href='#'>{word()}</a>" for _ in range(rng.randint(2, 6))) + "</div>"

    def part() -> str:
        r = rng.random()
        if r < 0.62:
            text = sentences(rng.randint(1, 7) if rng.random() < 0.8 else 1)
            if rng.random() < 0.3:
                text = f"<b>{phrase(1, 6)}</b> {text} <a href='/y'>{phrase(1, 4)}</a> {sentences(1)}"
            return f"<p>{text}" + rng.choice(("</p>", "</p>", "</p>", ""))
        if r < 0.68:
            return f"<p>{phrase(1, 7)}</p>"
        if r < 0.78:
            return f"<{(h := rng.choice(('h2', 'h3', 'h4')))}>{phrase(1, 8)}</{h}>"
        if r < 0.86:
            return f"<{(t := rng.choice(('ul', 'ol')))}>" + "".join(f"<li>{sentences(1) if rng.random() < 0.6 else phrase(2, 8)}</li>" for _ in range(rng.randint(2, 6))) + f"</{t}>"
        if r < 0.91:
            return f"<blockquote><p>{sentences(rng.randint(1, 3))}</p></blockquote>"
        if r < 0.94:
            return f"<pre>{phrase(3, 20)}</pre>"
        if r < 0.97:
            return "<table>" + "".join(f"<tr><td>{phrase(1, 3)}</td><td>{phrase(1, 6)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>"
        return f"<figure><figcaption>{phrase(3, 12)}</figcaption></figure>"

    def article() -> str:
        count = rng.choice((0, 1, 1, 2, 3, 5, 8, 12, 25))
        if rng.random() < 0.1:  # plain text with line breaks
            lines = "<br>".join(sentences(rng.randint(1, 4)) for _ in range(count or 1))
            return f"<div{named('article', 'post', 'content', 'main', 'text')} data-y=\"1\">{f'<h1>{phrase(2, 9)}</h1>' if rng.random() < 0.6 else ''}{lines}</div>"
        parts = [part() for _ in range(count)] or [f"<p>{phrase(1, 5)}</p>"]
        if rng.random() < 0.12:  # no element of its own
            return "".join(x.replace(">", ' data-y="1">', 1) for x in ([f"<h1>{phrase(2, 9)}</h1>"] if rng.random() < 0.6 else []) + parts)
        for kind in ("ad", "notice", "side", "share", "form", "comment", "nav"):
            if rng.random() < 0.12 * clutter * (style >= 0.25 or kind in ("share", "form", "nav")):
                parts.insert(rng.randint(1, len(parts)), block(kind))
        body = (f"<h1>{phrase(2, 9)}</h1>" if rng.random() < 0.7 else "") + "".join(parts)
        if rng.random() < 0.3:
            body = f"<div{named('content', 'entry-content', 'article-body', 'post-body', 'text')}>{body}</div>"
        tag = rng.choice(("article", "article", "main", "div", "div", "section"))
        return f"<{tag}{named('article', 'post', 'content', 'story', 'main', 'entry', 'page-content')} data-y=\"1\">{body}</{tag}>"

    # where names tell nothing, boilerplate made of plain sentences can't be told from a short article by anyone
    told = style >= 0.25
    before = [block(k) for k in ("head", "nav", "notice", "ad", "form", "side", "share") if rng.random() < 0.42 * clutter * (told or k not in ("notice", "ad"))]
    after = [block(k) for k in ("comment", "side", "ad", "notice", "share", "form", "nav") if rng.random() < 0.33 * clutter * (told or k not in ("comment", "notice", "ad"))]
    rng.shuffle(before)
    rng.shuffle(after)
    inside = "".join(before) + article() + "".join(after)
    if rng.random() < 0.4:
        inside = f"<div{named('container', 'wrapper', 'page', 'site', 'row')}>{inside}</div>"
    return f"<html><head><title>x</title></head><body>{inside}{block('foot') if rng.random() < 0.75 * clutter else ''}</body></html>"


@cache
def model(seed: int = 11, pages: int = TRAIN_PAGES) -> boosting.Trees:
    """Trees fitted on made-up pages; nodes that hold both main text and boilerplate aren't learnt from."""
    rng = random.Random(seed)
    made = [parse(_made_up(rng)) for _ in range(pages)]
    x = features(made)
    y, use = [], []
    for p in made:
        for i, t in enumerate(p.truth):
            below = set(p.truth[i : p.end[i]])
            y.append(t == "1")
            use.append(bool(t) and len(below) == 1)
    use = np.array(use)
    return boosting.train(x[use], np.array(y, float)[use])


def extract_pages(sources: list[str], trees: boosting.Trees) -> list[str]:
    if not sources:
        return []
    pages = [parse(s) for s in sources]
    margin = trees.margin(features(pages))
    out, at = [], 0
    for p in pages:
        label = decode(p, margin[at : at + len(p.tag)])
        at += len(p.tag)
        out.append("\n\n".join(line for node, line in p.runs if label[node] == MAIN))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model())
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "html"):
            texts = extract_pages([x or "" for x in piece.column("html").to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    return rows.mapInArrow(run, f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")
