"""Main text of a web page by tag-path ratios.

A page is a row of text nodes, each under a root-to-leaf path of block tags. The
nodes of one path are written by one template: paragraphs hold much text and
punctuation a node, menu entries hold little. Per path the text a node and the
punctuation a node are worked out, smoothed along the page over neighbouring
nodes, and fused by multiplication with a weight for the names on the path: none
for what HTML or a class sets aside (navigation, forms, adverts and so on; a step
of such a name makes a path of its own), more for <article> and <main>. Paths
above a threshold are content, on every page, and nothing else selects a node.

An article has nodes that no ratio finds: headings, one-word paragraphs, a line on
a path of its own. So each content node brings along the element around it (the
list around an entry, what holds a paragraph, the <article> around both), and
what stands between the first and the last of these, where it is not set aside,
and not mostly links.

One page is one row; nothing is grouped across rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their part in a page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text that a reader sees as such.
UNSEEN = frozenset(
    "head script style noscript template select option textarea svg math iframe object canvas audio video map "
    "title noembed noframes xmp".split()
)
#: Elements that HTML sets aside from an article.
ASIDE = frozenset("nav aside footer form button input label menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold a piece of an article, never all of it.
PARTS = HEADINGS | frozenset("p li dt dd blockquote pre figcaption ul ol dl figure tr tbody thead tfoot".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
# Words that mark an element as no part of the article, in its class, id or role.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets related "
    "recommended recommendations share sharing social comment comments disqus reply replies respond discussion "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "footer masthead toolbar pagination pager skip search alert complementary contentinfo dialog".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z0-9]+")

SMOOTH = np.array([0.25, 0.5, 0.25])
#: Share of the page's root mean square of fused ratios that a path must reach.
LEVEL = 0.7
#: Weight of a path through an <article> or <main> element.
ARTICLE = 4.0

#: A block of text: its path, its element, the text, and how much of that is links.
Block = tuple[int, int, str, int]


class _Page:
    """Blocks of text in page order. Elements have numbers in the order they open in, paths in that they come up in.

    ``up`` has the block element around each element; ``path_tags`` the last tag of each path and ``weights``
    what the names on it weigh. Depth costs nothing: an element knows its path and block element by number.
    """

    def __init__(self, source: str) -> None:
        self.blocks: list[Block] = []
        self.tags: list[str] = ["#"]
        self.up: list[int] = [0]
        self.path_tags: list[str] = ["#"]
        self.weights: list[float] = [1.0]
        self.articles: set[int] = set()
        self._paths: dict[tuple[int, str, float], int] = {}
        # Tag, seen or not, block element, path.
        self._stack: list[tuple[str, bool, int, int]] = [("#", True, 0, 0)]
        self._opened: Counter[str] = Counter()
        self._parts: list[str] = []
        self._link = 0
        self._read(source)

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            _, _, block, path = self._stack[-1]
            self.blocks.append((path, block, text, min(self._link, len(text))))
        self._parts, self._link = [], 0

    def _pop(self, to: int) -> None:
        self._opened.subtract(entry[0] for entry in self._stack[to:])
        del self._stack[to:]

    def _text(self, raw: str) -> None:
        if raw and self._stack[-1][1]:
            text = html.unescape(raw) if "&" in raw else raw
            self._parts.append(text)
            if any(entry[0] == "a" for entry in self._stack[-4:]):
                self._link += len(text.strip())

    def _open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._parts.append(" ")
        if tag not in INLINE:
            self._flush()
            if tag in CLOSES_P:
                self._close_open("p", stop=("article", "section", "div", "td", "li", "body", "main"))
            if tag == "li":
                self._close_open("li", stop=("ul", "ol", "menu"))
            if tag in ("td", "th"):
                self._close_open(("td", "th"), stop=("table", "tr"))
            if tag == "tr":
                self._close_open("tr", stop=("table",))
            if tag in ("dt", "dd"):
                self._close_open(("dt", "dd"), stop=("dl",))
        if tag in VOID:
            return
        _, seen, block, path = self._stack[-1]
        marked = _marked(tag, rest)
        if tag in INLINE:
            seen = seen and not marked  # no node of its own, so no path tells
        else:
            weight = self.weights[path]
            if tag in ASIDE or marked or (tag == "header" and weight == 1.0):
                weight = 0.0
            elif tag in ("article", "main") and weight:
                weight = ARTICLE
            self.tags.append(tag)
            self.up.append(block)
            block = len(self.tags) - 1
            if tag in ("article", "main") and weight:
                self.articles.add(block)
            path = self._paths.setdefault((path, tag, weight), len(self.path_tags))
            if path == len(self.path_tags):
                self.path_tags.append(tag)
                self.weights.append(weight)
        self._stack.append((tag, seen and tag not in UNSEEN, block, path))
        self._opened[tag] += 1

    def _close_open(self, tag: str | tuple[str, ...], stop: tuple[str, ...]) -> None:
        tags = (tag,) if isinstance(tag, str) else tag
        if not any(self._opened[t] for t in tags):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            name = self._stack[i][0]
            if name in tags:
                self._pop(i)
                return
            if name in stop:
                return

    def _close(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if not self._opened[tag]:
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][0] == tag:
                self._pop(i)
                return
            if tag in INLINE and self._stack[i][0] not in INLINE:
                return

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            lt = source.find("<", at)
            if lt < 0:
                self._text(source[at:])
                break
            found = TOKEN.match(source, lt)
            if found is None:
                self._text(source[at : lt + 1])
                at = lt + 1
                continue
            self._text(source[at:lt])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            if at == end and not found[0].endswith(">"):
                break  # a tag that the page's end cuts off
            tag = name.lower()
            if found[1]:
                self._close(tag)
                continue
            rest = found[3]
            self._open(tag, rest)
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = close.start() if close else end
        self._flush()


def _marked(tag: str, rest: str) -> bool:
    if not rest or tag in ("body", "html", "article", "main") and "comment" not in rest.lower():
        return False
    if HIDDEN.search(rest):
        return True
    for value in NAMED.findall(rest):
        if not MARKS.isdisjoint(WORD.findall(value.lower())):
            return True
    return False


def content_paths(blocks: list[Block], weights: list[float]) -> set[int]:
    """Paths whose smoothed, fused and weighted text and punctuation ratios, on the mean of their nodes, reach the threshold.

    The best path always does, if any has text but links.
    """
    chars, marks, nodes = Counter(), Counter(), Counter()
    for path, _, text, link in blocks:
        chars[path] += len(text) - link
        marks[path] += len(PUNCTUATION.findall(text))
        nodes[path] += 1
    seen = np.array([weights[b[0]] > 0 for b in blocks])
    text_ratio = seen * np.array([chars[b[0]] / nodes[b[0]] for b in blocks])
    mark_ratio = seen * np.array([(1 + marks[b[0]]) / nodes[b[0]] for b in blocks])

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(np.pad(x, 1, mode="edge"), SMOOTH, mode="valid")

    fused = smooth(text_ratio) * smooth(mark_ratio) * np.array([weights[b[0]] for b in blocks])
    line = LEVEL * float(np.sqrt(np.mean(fused**2)))
    scores: dict[int, float] = Counter()
    for (path, *_), value in zip(blocks, fused):
        scores[path] += float(value) / nodes[path]
    scores = {path: score for path, score in scores.items() if chars[path] > 0}
    line = min(line, max(scores.values(), default=0.0))
    return {path for path, score in scores.items() if score >= line and score > 0}


def _holders(page: _Page, content: list[int]) -> list[bool]:
    """For each element, does it stand in one that a content node brings along, or is it one?"""
    article = [0] * len(page.tags)  # the innermost <article> or <main> around each element
    for n in range(1, len(page.tags)):
        article[n] = n if n in page.articles else article[page.up[n]]
    brought = set()
    for i in content:
        element = page.blocks[i][1]
        while page.tags[element] in PARTS:
            element = page.up[element]
        brought.add(article[element] or element)
    found = [0 in brought]
    for n in range(1, len(page.tags)):
        found.append(n in brought or found[page.up[n]])
    return found


def main_text(source: str | None) -> str:
    """The article's text; empty for a null, empty or textless page."""
    if not source:
        return ""
    page = _Page(source)
    blocks = page.blocks
    if not blocks:
        return ""
    chosen = content_paths(blocks, page.weights)
    content = [i for i, b in enumerate(blocks) if b[0] in chosen]
    if not content:
        return ""
    brought = _holders(page, content)
    aside = [page.weights[path] == 0 for path, *_ in blocks]
    near = [i for i, (path, element, _, _) in enumerate(blocks) if path in chosen or brought[element] and not aside[i]]
    headings = [page.path_tags[path] in HEADINGS for path, *_ in blocks]
    first, last = near[0], near[-1]
    while first > 0 and headings[first - 1]:
        first -= 1
    kept = []
    for i in range(first, last + 1):
        path, _, text, link = blocks[i]
        if path in chosen or not aside[i] and (2 * link <= len(text) or headings[i]):
            kept.append(text)
    return " ".join(kept)


@F.pandas_udf(T.StringType())
def _extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for sources in pages:
        yield pd.Series([main_text(s) for s in sources], dtype=object)


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """Every row, as struct ``row``, with its main ``text`` and ``n_chars`` (code points).

    Null, empty and textless pages give an empty text. Rows that repeat give
    equal texts; other columns stay in ``row``.
    """
    row: Column = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    return pages.select(row.alias("row"), _extract(F.col(f"`{source}`")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
