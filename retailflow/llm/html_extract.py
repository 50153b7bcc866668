"""Main text of web pages by a minimum cut.

A page becomes a row of text blocks.  A linear classifier turns what a block looks like (length, links,
punctuation, element) and where it stands (menu, footer, article, advert ...) into log-odds of being content: the
capacity of its edge to the source or the sink.  Blocks that follow each other or stand in the same element are
tied by smoothness edges.  The minimum cut, found by augmenting paths, separates content from boilerplate.

The text part of the classifier is trained on a bounded sample of pages that mark their article themselves, with
the weights below as a prior; the weights of places are fixed, and their sum is bounded.  A bad place does not count
against a main text element (article, main) where the page has none in a better place, nor, on pages without such
elements, if it holds most of the page's text.

Defined results: a null, empty or wholly cut page has an empty text; unclosed elements end with their parent, an
unclosed comment or element of raw text (script, style, textarea, title, iframe, noframes) with the page; repeated
rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

# Fixed values of the page language.
RAW = {"script", "style", "textarea", "title", "iframe", "noframes"}
SKIPPED = {"noscript", "template", "svg", "math", "object", "select", "canvas", "audio", "video", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "input", "link", "meta", "label"}
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
          "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul", "figure", "details"}

# Log-odds that a place adds for all that stands in it.
ELEMENTS = {"article": 5.0, "main": 3.0, "nav": -12.0, "footer": -12.0, "aside": -12.0, "form": -12.0, "menu": -12.0,
            "dialog": -12.0, "button": -12.0, "head": -12.0, "header": -12.0, "fieldset": -12.0}
ROLES = {"navigation": -12.0, "banner": -12.0, "contentinfo": -12.0, "complementary": -12.0, "search": -12.0,
         "alert": -12.0, "alertdialog": -12.0, "dialog": -12.0, "form": -12.0, "menu": -12.0, "menubar": -12.0,
         "main": 3.0, "article": 5.0}
BAD_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion",
    "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notification", "overlay", "pagination", "pager", "popup", "promo", "promoted",
    "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar", "topbar", "widget", "alert", "paywall",
    "recommended", "recommendations", "hidden", "skip", "bottombar", "sidenav", "commentlist", "toc",
}
GOOD_WORDS = {"article", "post", "entry", "story", "main", "body", "content", "text", "hentry"}
BAD_WORD, BAD_PART, GOOD_WORD, HIDDEN = -12.0, -5.0, 2.0, -12.0
# Bound of a place's sum; the share of a page's text that no bad place holds.
BOUND, MOST = 6.0, 0.75

# Prior weights of what a block looks like; training moves them.
FEATURES = ("one", "log_words", "link_share", "sentence", "marks", "heading", "item", "cell", "paragraph", "copyright")
PRIOR = np.array([-1.5, 0.8, -4.0, 0.8, 0.3, 1.0, -0.4, -0.5, 0.8, -3.0])


class Block:
    __slots__ = ("text", "linked", "tag", "place", "parent")

    def __init__(self, text: str, linked: int, tag: str, place: float, parent: int):
        self.text, self.linked, self.tag, self.place, self.parent = text, linked, tag, place, parent


@lru_cache(maxsize=4096)
def place_of(tag: str, attributes: str) -> tuple[float, bool, bool]:
    """Log-odds that an element adds to what it holds, whether it says that it is main text, whether it is hidden."""
    value, main = ELEMENTS.get(tag, 0.0), tag in ("article", "main")
    if not attributes or tag in ("html", "body"):
        return value, main, False
    found = {m[0].lower(): html.unescape(m[1] or m[2] or m[3] or "") for m in ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    value += ROLES.get(role, 0.0)
    main = main or role in ("article", "main")
    style = found.get("style", "").replace(" ", "").lower()
    hidden = ("hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
              or "visibility:hidden" in style)
    if hidden:
        value += HIDDEN
    # A whole name says more than a word in it: "sidebar" is one, "with-sidebar" has one.
    names = [re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
             for name in (found.get("class", "") + " " + found.get("id", "")).split()]
    whole, words = {n[0] for n in names if len(n) == 1}, {w for n in names for w in n}
    if whole & BAD_WORDS:
        value += BAD_WORD
    elif whole & GOOD_WORDS:
        value += GOOD_WORD
    elif words & BAD_WORDS:
        value += BAD_PART
    elif words & GOOD_WORDS:
        value += GOOD_WORD
    return value, main, hidden


class Element:
    """An open or closed element: its parent's number, what it adds, and the text it holds."""

    __slots__ = ("parent", "value", "main", "hidden", "held")

    def __init__(self, parent: int, value: float, main: bool, hidden: bool):
        self.parent, self.value, self.main, self.hidden, self.held = parent, value, main, hidden, 0


def set_places(blocks: list[Block], owners: list[int], elements: list[Element]) -> None:
    """Sum up the place of each block; ``owners`` are the elements the blocks stand in, parents come first."""
    for block, at in zip(blocks, owners):
        elements[at].held += len(block.text)
    for e in reversed(elements[1:]):
        elements[e.parent].held += e.held

    def summed(free: set[int]) -> list[float]:
        """Sums from the root on; elements of ``free`` start anew.  In a bad place nothing else is a gain."""
        out = [0.0]
        for i, e in enumerate(elements[1:], 1):
            above = 0.0 if i in free else out[e.parent]
            out.append(max(-BOUND, min(BOUND, above + (min(0.0, e.value) if above < 0 else e.value))))
        return out

    places = summed(set())
    mains = [i for i, e in enumerate(elements) if e.main and e.held]
    if mains and not any(places[i] > 0 for i in mains):
        seen = [False]
        for e in elements[1:]:
            seen.append(seen[e.parent] or e.hidden)
        able = [i for i in mains if elements[i].value >= 0 and not seen[i]]
        top = max((elements[i].held for i in able), default=0)
        places = summed({i for i in able if 2 * elements[i].held >= top})
    elif not mains:
        for e in elements[1:]:
            if e.value < 0 and not e.hidden and e.held >= MOST * elements[0].held:
                e.value = 0.0
        places = summed(set())
    for block, at in zip(blocks, owners):
        block.place = places[at]


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; inline elements do not end a block."""
    out: list[Block] = []
    # Open elements: name, number.
    stack: list[tuple[str, int]] = [("", 0)]
    elements, owners = [Element(0, 0.0, False, False)], []
    pieces: list[str] = []
    linked = links = skipped = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                tag, parent = next((x for x in reversed(stack) if x[0] not in INLINE), stack[0])
                out.append(Block(text, min(linked, len(text)), tag, 0.0, parent))
                owners.append(stack[-1][1])
        linked = 0

    def pop_to(i: int) -> None:
        nonlocal links, skipped
        links -= sum(x[0] == "a" for x in stack[i:])
        skipped -= sum(x[0] in SKIPPED for x in stack[i:])
        del stack[i:]

    while at < end:
        m = TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not skipped:
            pieces.append(page[at:stop])
            if links:
                linked += len(page[at:stop].strip())
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if (tag == "br" or tag == "hr") and not skipped:
            pieces.append("\n")
        if tag not in INLINE and tag != "br":
            flush()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not m[3].rstrip(">").endswith("/"):
                at = close.end() if close else end
            continue
        if tag in CLOSED_BY or tag in ENDS_P:
            closes = CLOSED_BY.get(tag, {"p"})
            i = len(stack) - 1
            while i > 0 and (stack[i][0] in INLINE or stack[i][0] in closes):
                if stack[i][0] in closes:
                    pop_to(i)
                    break
                i -= 1
        if tag in VOID or m[3].endswith("/>") and tag not in INLINE:
            continue
        if tag in SKIPPED and m[3].rstrip(">").endswith("/"):
            continue
        value, main, hidden = place_of(tag, m[3].rstrip(">").strip())
        inside = (main or tag == "header") and any(elements[x[1]].main for x in stack)
        if tag == "header" and inside:
            value = 0.0  # an article's own head
        elif main and inside:
            value, main = min(0.0, value), False
        elements.append(Element(stack[-1][1], value, main, hidden))
        stack.append((tag, len(elements) - 1))
        links += tag == "a"
        skipped += tag in SKIPPED
    flush()
    set_places(out, owners, elements)
    return out


def looks(block: Block) -> list[float]:
    """Values of FEATURES."""
    text, tag = block.text, block.tag
    marks = sum(map(text.count, ".,;:!?。"))
    return [1.0, math.log1p(text.count(" ") + 1), block.linked / len(text), float(text[-1] in ".!?。\"”»:"),
            min(1.0, marks / 5), float(len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()), float(tag == "li"),
            float(tag in ("td", "th")), float(tag in ("p", "pre", "blockquote")), float("©" in text or "(c)" in text)]


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the blocks on the source's side.

    A positive gain is the capacity from the source, a negative one to the sink.  Flow runs along shortest
    augmenting paths, and the source's side is what it can still reach.
    """
    n = len(gains)
    if not any(g > 0 for g in gains):
        return [False] * n
    if not any(g < 0 for g in gains):
        return [True] * n
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        room[a][b] = room[a].get(b, 0.0) + w
        room[b][a] = room[b].get(a, 0.0) + w
    supply, demand = [max(0.0, g) for g in gains], [max(0.0, -g) for g in gains]
    tiny = 1e-9
    while True:
        before = {i: -1 for i in range(n) if supply[i] > tiny}
        queue, last = deque(before), -1
        while queue:
            a = queue.popleft()
            if demand[a] > tiny:
                last = a
                break
            for b, w in room[a].items():
                if w > tiny and b not in before:
                    before[b] = a
                    queue.append(b)
        if last < 0:
            return [i in before for i in range(n)]
        path = [last]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        flow = min(supply[path[-1]], demand[last], *(room[a][b] for b, a in zip(path, path[1:])))
        supply[path[-1]] -= flow
        demand[last] -= flow
        for b, a in zip(path, path[1:]):
            room[a][b] -= flow
            room[b][a] += flow


def extract(page: str | None, weights: np.ndarray = PRIOR, next_to: float = 0.8, same: float = 1.2) -> list[str]:
    """Content blocks of a page, in order; ``next_to`` ties neighbours, ``same`` blocks of one element."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return []
    gains = (np.array([looks(b) for b in blocks]) @ weights).clip(-4, 4) + [b.place for b in blocks]
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, next_to))
        if b.parent in last:
            edges.append((last[b.parent], i, same))
        last[b.parent] = i
    return [b.text for b, keep in zip(blocks, minimum_cut(gains.tolist(), edges)) if keep]


def train(pages: DataFrame, sample: int = 400, steps: int = 300, prior: float = 0.02) -> np.ndarray:
    """Weights of FEATURES from at most ``sample`` pages that have an article element, by logistic regression.

    A block in an article counts as content, one in a bad place as boilerplate, others are not used.  Without such
    pages the prior weights stay.
    """
    chosen = pages.where(F.col("html").contains("<article")).select("html").orderBy(
        F.xxhash64("html"), "html").limit(sample)

    def features(parts):
        for part in parts:
            rows = [(float(b.place > 0), looks(b)) for page in part["html"] for b in blocks_of(page) if abs(b.place) > 2]
            yield pd.DataFrame(rows, columns=["content", "looks"])

    rows = chosen.mapInPandas(features, "content double, looks array<double>").collect()
    if len({r.content for r in rows}) < 2:
        return PRIOR
    x, y = np.array([r.looks for r in rows]), np.array([r.content for r in rows])
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (each * (p - y)) + prior * (w - PRIOR))
    return w


def main_text(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``page_id, url, text, n_chars, blocks`` for every page."""
    learned = (train(pages) if weights is None else weights).tolist()

    def run(parts):
        w = np.array(learned)
        for part in parts:
            blocks = [extract(page.as_py(), w) for page in part.column(2)]
            texts = [" ".join(b) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(blocks, pa.list_(pa.string()))],
                names=["page_id", "url", "text", "n_chars", "blocks"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long, blocks array<string>")
