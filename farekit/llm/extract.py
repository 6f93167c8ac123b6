"""Main text of web pages by scoring containers of paragraphs."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ITEMS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",)}
# What is no part of an article. By element or role, whatever it holds:
NEVER = frozenset("nav footer button select menu head".split())
NEVER_ROLES = frozenset("navigation banner contentinfo search alertdialog alert menu menubar".split())
# By element or role, unless the article itself is in it:
FOREIGN = frozenset("aside form fieldset dialog".split())
FOREIGN_ROLES = frozenset("complementary dialog".split())
# By a whole class or id, or the first word of one whose last word is a part of a page:
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies".split())
CLEAR_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs footer masthead topbar cookie cookies consent gdpr newsletter pagination pager toolbar related recommended".split()
)
DOUBTFUL_WORDS = frozenset(
    "promo promotion banner aside header notice notices popup modal overlay subscribe subscription share sharing social "
    "recommendations widget login signup skip hidden".split()
)
PAGE_PARTS = frozenset(
    "area articles bar block box button buttons column container content feed form icons inner items label links list message "
    "outer overlay panel posts region section slot stories thread tools unit widget wrap wrapper".split()
)
# A word after one of these tells how the page is laid out, not what the element is; a header after one of those is the article's.
LAYOUT_WORDS = frozenset("has is no not with without hide show".split())
OWN_HEADERS = frozenset("article content entry post story title".split())
KEPT = frozenset("html body article main".split())
# Share of the page's points that releases an element that is foreign by a doubtful name or by kind.
MOST = 0.75
# Elements that hold one whole article; roles, classes and ids that say so of others.
ARTICLES = frozenset("article main".split())
ARTICLE_NAMES = frozenset(
    "main article article-body article-content articlebody content main-content post post-body post-content entry entry-content story "
    "story-body".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre h1 h2 h3 h4 h5 h6 li td dd dt blockquote".split())
# Containers above a paragraph that get a share of its points; the next share would be a seventeenth.
LEVELS = 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


# Why an element is foreign: not at all, by a doubtful name, by a clear one, by its kind, or in any case.
OWN, DOUBTFUL, CLEAR, KIND, ANYHOW = range(5)


@dataclass
class _Node:
    tag: str
    parent: int
    why: int = OWN
    never: bool = False
    foreign: bool = False
    named: bool = False
    score: float = 0.0
    chars: int = 0
    link_chars: int = 0


@dataclass
class _Block:
    node: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _why_named(name: str) -> int:
    """What one class or id says."""
    words = _WORD.findall(name)
    if not words or words[0] in LAYOUT_WORDS:
        return OWN
    first, last = words[0], words[-1]
    if last == "header" and len(words) > 1:
        return OWN if first in OWN_HEADERS else DOUBTFUL if first in ("site", "page", "main", "top", "global") else OWN
    # Of several words the first counts if the last is a part of a page; the last alone counts if it is clear: a text
    # widget or a policy on sharing may be anything.
    leading = {first} if len(words) == 1 or last in PAGE_PARTS | DOUBTFUL_WORDS else set()
    if (leading | {last}) & COMMENT_WORDS:
        return ANYHOW
    if (leading | {last}) & CLEAR_WORDS:
        return CLEAR
    return DOUBTFUL if leading & DOUBTFUL_WORDS else OWN


def _why(tag: str, raw: str, inside: bool) -> int:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    if tag in NEVER:
        return ANYHOW
    if tag not in KEPT:
        style = found.get("style", "").replace(" ", "").lower()
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style:
            return ANYHOW
        if found.get("role", "").lower() in NEVER_ROLES:
            return ANYHOW
    why = OWN
    if tag in FOREIGN or (tag == "header" and not inside) or found.get("role", "").lower() in FOREIGN_ROLES:
        why = KIND
        if tag == "header" and any(_WORD.findall(n)[:1] and _WORD.findall(n)[0] in OWN_HEADERS for n in names):
            why = OWN
    if tag in ("html", "body", "main"):
        return why
    by_name = [_why_named(n) for n in names]
    if ANYHOW in by_name:
        return ANYHOW
    # An article may be called anything.
    return max([why, *by_name]) if tag not in KEPT else why


def _named(raw: str) -> bool:
    """Whether role, class, id or itemprop name the element as an article's container."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(raw)}
    words = [w for name in ("role", "class", "id", "itemprop") for w in found.get(name, "").split()]
    return not ARTICLE_NAMES.isdisjoint(words)


class _Page:
    """The tree of a page's block elements, and its blocks of text in page order."""

    def __init__(self, source: str) -> None:
        self.nodes = [_Node("", -1)]
        self.blocks: list[_Block] = []
        self.stack, self.links, self.inside = [0], 0, 0
        self.open: Counter[str] = Counter()
        self.block: _Block | None = None
        self._read(source)

    def _close_to(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.open[self.nodes[node].tag] -= 1
            self.inside -= self.nodes[node].tag in ("article", "main")
        del self.stack[depth:]
        self.block = None
        self.links = 0

    def _close(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.nodes[self.stack[depth]].tag
            if tag in tags:
                self._close_to(depth)
                return
            if tag in within:
                return

    def _open(self, tag: str, raw: str) -> None:
        if tag in CLOSES_PARAGRAPH:
            self._close(("p",), ("td", "th", "li", "div", "section", "article", "blockquote"))
        if tag in ITEMS:
            self._close(("td", "th") if tag in ("td", "th") else ("dd", "dt") if tag in ("dd", "dt") else (tag,), ITEMS[tag])
        parent = self.stack[-1]
        named = bool(raw) and tag not in PARAGRAPHS and tag not in ("html", "body") and _named(raw)
        why = _why(tag, raw, self.inside > 0)
        self.nodes.append(_Node(tag, parent, why, self.nodes[parent].never or why == ANYHOW, named=named))
        self.stack.append(len(self.nodes) - 1)
        self.open[tag] += 1
        self.inside += tag in ("article", "main")
        self.block = None

    def _text(self, text: str) -> None:
        node = self.stack[-1]
        if self.nodes[node].never:
            return
        if self.block is None:
            if text.isspace():
                return
            self.block = _Block(node)
            self.blocks.append(self.block)
        self.block.parts.append(text)
        if self.links:
            self.block.linked += len(text.strip())

    def _read(self, source: str) -> None:
        position, end = 0, len(source)
        while position < end:
            match = _TOKEN.match(source, position)
            position = match.end()
            if match[2] is None:
                text = match[0]
                if text[0] != "<" or text == "<":
                    self._text(text)
                continue
            tag, raw = match[2].lower(), match[3]
            if match[1]:
                if tag in INLINE:
                    self.links -= tag == "a" and self.links > 0
                elif tag not in VOID:
                    self._close((tag,))
            elif tag in RAW:
                if not raw.rstrip().endswith("/"):
                    closing = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(source, position)
                    position = closing.end() if closing else end
                if self.block is not None:
                    self.block.parts.append(" ")
            elif tag == "br":
                if self.block is not None:
                    self.block.parts.append(" ")
            elif tag in INLINE:
                self.links += tag == "a"
            elif tag in VOID:
                self.block = None
            else:
                self._open(tag, raw)


def _points(block: _Block, text: str) -> float:
    """Points of a paragraph, for itself, its commas and its length, less what is linked."""
    share = min(1.0, block.linked / max(len(text), 1))
    return (1 + text.count(",") + text.count("、") + min(len(text) / 100, 3)) * (1 - share)


def _mark_foreign(page: _Page, texts: list[str], allowed: frozenset[int]) -> None:
    """Decide which elements are no part of the article.

    An element that is foreign by name or kind is released if it holds an
    article or main element, or, unless its name is clear, most of the page's
    points while no article is outside of it. ``allowed`` reasons don't count.
    """
    nodes = page.nodes
    points, articles = [0.0] * len(nodes), [0] * len(nodes)
    for block, text in zip(page.blocks, texts, strict=True):
        points[block.node] += _points(block, text) if text else 0.0
    for i in range(len(nodes) - 1, 0, -1):
        articles[i] += nodes[i].tag in ARTICLES and points[i] > 0 and not nodes[i].never
        points[nodes[i].parent] += points[i]
        articles[nodes[i].parent] += articles[i]
    for node in nodes[1:]:
        node.foreign = False
    for i, node in enumerate(nodes):
        if i == 0:
            continue
        own = node.why != OWN and node.why not in allowed
        if own and node.why != ANYHOW:
            most = node.why != CLEAR and points[i] >= MOST * points[0] > 0 and not articles[0]
            own = not (articles[i] and node.tag not in ARTICLES) and not most
        node.foreign = nodes[node.parent].foreign or node.never or own


def _score(page: _Page, texts: list[str]) -> None:
    """Points of every paragraph to its container, half of them to the next one up, a third to the one above, and so on."""
    for node in page.nodes:
        node.score, node.chars, node.link_chars = 0.0, 0, 0
    for block, text in zip(page.blocks, texts, strict=True):
        own = page.nodes[block.node]
        if own.foreign:
            continue
        own.chars += len(text)
        own.link_chars += min(block.linked, len(text))
        points = _points(block, text)
        node = own.parent if own.tag in PARAGRAPHS else block.node
        for level in range(1, LEVELS + 1):
            if node <= 0:
                break
            page.nodes[node].score += points / level
            node = page.nodes[node].parent
    # Children stand behind their parents, so one pass from the end adds up whole subtrees.
    for node in reversed(page.nodes[1:]):
        page.nodes[node.parent].chars += node.chars
        page.nodes[node.parent].link_chars += node.link_chars
    for node in page.nodes:
        node.score *= 1 - node.link_chars / max(node.chars, 1)
        if node.tag in ("article", "main") and node.chars:
            node.score += 25


def _whole(page: _Page, best: int) -> int | None:
    """The container of the whole article that the best container is a part of, if one can be told.

    The outermost article; else the nearest main element or container named so; else the outermost one that directly
    holds a heading or paragraph of its own.
    """
    nodes, above = page.nodes, []
    node = best
    while node > 0:
        above.append(node)
        node = nodes[node].parent
    for wanted in ([i for i in reversed(above) if nodes[i].tag == "article"], [i for i in above if nodes[i].tag == "main"]):
        if wanted:
            return wanted[0]
    for i in above:
        if nodes[i].named:
            return i
    ancestors = set(above)
    holding = {
        nodes[b.node].parent for b in page.blocks
        if not nodes[b.node].foreign and (nodes[b.node].tag in HEADINGS or nodes[b.node].tag == "p") and b.linked < 0.9 * len("".join(b.parts).strip())
    }
    return next((i for i in reversed(above) if i in holding & ancestors), None)


def main_text(source: str | None) -> str:
    """The blocks of the article around the best container, in page order, one to a line.

    Where an article, a main element, a container named so, or one with a
    heading or paragraph of its own holds the best container, that has the
    article, and all its blocks are kept. Else the best container is kept
    without lists of links. Siblings like it stay in either case, and h1.

    A block's white space is one space each; character references are decoded.
    Menus, page headers, footers, asides, forms, scripts, adverts, notices and
    comments are left out by element, role or name before scoring, unless the
    article is in them. A page of which nothing is left that way is scored again
    with doubtful names allowed, then with asides and forms. Of equal containers
    the first wins. Null, empty and textless pages give an empty text; broken
    markup gives what can be read.
    """
    page = _Page(source or "")
    texts = [" ".join(html.unescape("".join(b.parts)).split()) for b in page.blocks]
    for allowed in (frozenset(), frozenset({DOUBTFUL}), frozenset({DOUBTFUL, KIND})):
        _mark_foreign(page, texts, allowed)
        if found := _best_text(page, texts):
            return found
    return ""


def _best_text(page: _Page, texts: list[str]) -> str:
    _score(page, texts)
    nodes = page.nodes
    best = max(range(len(nodes)), key=lambda i: (nodes[i].score, -i))
    whole = _whole(page, best) if nodes[best].score else None
    if not nodes[best].score:
        chosen = {0}
    else:
        least = max(10.0, 0.2 * nodes[best].score)
        top = best if whole is None else whole
        chosen = {top} | {
            i for i, n in enumerate(nodes)
            if n.parent == nodes[top].parent and i != top
            and (n.score >= least or (n.tag == "p" and n.chars > 80 and n.link_chars < 0.25 * n.chars) or n.tag == "h1")
        }
    part = [False] * len(nodes)
    for i, node in enumerate(nodes):
        part[i] = i in chosen or (i > 0 and part[node.parent])
    kept = []
    for block, text in zip(page.blocks, texts, strict=True):
        listed = nodes[block.node].tag in ("li", "div", "td", "dd") and block.linked >= 0.9 * len(text)
        if part[block.node] and text and not nodes[block.node].foreign and (whole is not None or not listed):
            kept.append(text)
    return "\n".join(kept)


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(None if p is None else p.decode("utf-8", "replace")) for p in pages], dtype="object")


def extracted(source: Column) -> Column:
    """``main_text`` of a column of pages."""
    return _main_texts(source.cast("binary"))


def with_text(pages: DataFrame) -> DataFrame:
    """Pages with ``text`` and ``n_chars`` (its code points), replacing such columns; one row per page, repeats kept."""
    return pages.withColumn("text", extracted(F.col("html"))).withColumn("n_chars", F.length("text").cast("long"))
