"""Main text of HTML pages from flat text blocks and a decision tree (operator 5).

A page is read once, tag by tag, into a flat list of text blocks: the text between two
block-level tags.  A block has its word count and link density (the share of its words
inside links), those of its two neighbours, and what the tags around it say: whether it
stands in an article, in an element for page furniture, or in one whose class, id or role
names such furniture.  What speaks for furniture is how little of the page (of the main
article, inside it) such an element holds: a wrapper named after its sidebar, or a form around the
whole page, holds nearly all of it.  Reader comments, related items and asides get no such
excuse while there is text beside them, however long they are.  One article is the page's main
one: the longest of those that stand in no such element, if any does.  It alone begins
without the marks of what is around it; articles within it, or beside it in a list of
comments or teasers, keep theirs.  A decision tree over these numbers, grown on the small labelled
table below, keeps a block or not; the kept blocks are the text, in page order.

The tree is grown anew (Gini impurity) wherever it is needed; it is the same each time.

Defined results: null and empty pages have the empty text; unclosed and stray tags are
allowed (an element ends with the one around it, a paragraph with the next block); what
is no tag is text; repeated rows are read each by itself; pages are read whole, in time in proportion
to their length even if quotes, comments or elements are never closed.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medallion.llm.common import slices

# HTML element names by their part in a page.
BLOCK = frozenset("""address article aside blockquote body br button center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
    p pre section select summary table tbody td tfoot th thead tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video head select datalist".split())
#: Of these, the ones that HTML reads as raw text up to their end tag, or the page's end.
RAW_TEXT = frozenset("script style noscript textarea title iframe".split())
MAIN = frozenset(["article", "main"])
#: Elements whose own names speak of the page's layout, not of a part beside the text.
WHOLE = frozenset(["html", "body", "main", "article"])
FURNITURE = frozenset("nav header footer aside form menu button dialog fieldset".split())
#: Elements that the next one of the same kind ends.
SIBLINGS = frozenset("li dt dd tr td th option".split())
# Words in a class, id or role that name page furniture.
HINTS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer copyright sidebar aside widget rail
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    comment comments disqus respond reply replies share sharing social related recommended recommendations trending
    pagination pager search toolbar contentinfo complementary form paywall hidden teaser teasers""".split())
#: Of these, what is written by readers or leads to other pages.
BESIDE = frozenset("comment comments disqus respond reply replies related recommended recommendations trending teaser teasers".split())
#: Hints that are also words of a text: they count beside other hints and words of layout only ("share-buttons", not "market-share").
PLAIN = frozenset("""ad ads advertising sponsor sponsored promotion banner menu header rail cookie cookies consent notice notices alert
    newsletter subscription comment comments respond reply replies share sharing social related recommended recommendations
    trending search form hidden""".split())
LAYOUT = frozenset("""site page main top bottom left right center inner outer box bar block blocks area section container wrapper wrap row
    column col list lists item items button buttons link links icon icons post posts article articles entry content body text title
    form field input label count meta info global primary secondary mobile desktop sticky fixed fixture module group panel view region
    story stories news more most box unit slot media widget widgets blog user author thread""".split())
#: A name with one of these says what a wrapper has, or has not, beside the text.
MODIFIERS = frozenset("has with without no".split())

# The labelled table.  A row: words and link density of a block, of the block before it, of the block after
# it; 1 in an article, 0 beside one, 0.5 on a page without one; in a furniture element the share of the words that it
# does not hold, else 0; the same of an element that is named like furniture; 1 for main text.
LABELLED = (
    # menus, before or between articles
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 1, 0),
    (1, 1.0, 1, 1.0, 12, 0.0, 0, 1, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0, 0, 1, 0), (6, 1.0, 4, 1.0, 5, 1.0, 0.5, 0, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 0.5, 1, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0.5, 0, 1, 0), (4, 0.8, 2, 1.0, 3, 1.0, 0.5, 0, 0, 0),
    (1, 1.0, 60, 0.0, 1, 1.0, 1, 1, 0, 0), (2, 1.0, 45, 0.0, 2, 1.0, 1, 0, 1, 0), (9, 0.9, 3, 1.0, 8, 0.9, 0, 0, 0, 0),
    # menus without a name on pages without an article
    (1, 1.0, 0, 0.0, 1, 1.0, 0.5, 0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0.5, 0, 0, 0), (1, 1.0, 12, 0.0, 1, 1.0, 0.5, 0, 0, 0), (3, 1.0, 2, 1.0, 25, 0.0, 0.5, 0, 0, 0),
    (2, 1.0, 30, 0.0, 2, 1.0, 0.5, 0, 0, 0), (4, 1.0, 3, 1.0, 0, 0.0, 0.5, 0, 0, 0), (5, 0.8, 40, 0.0, 3, 1.0, 0.5, 0, 0, 0), (3, 1.0, 1, 1.0, 9, 0.0, 0.5, 0, 0, 0),
    # page headers and footers
    (4, 0.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (8, 0.0, 2, 1.0, 5, 0.0, 0, 1, 1, 0), (14, 0.1, 80, 0.0, 0, 0.0, 0, 1, 0, 0),
    (9, 0.0, 33, 0.0, 0, 0.0, 0, 1, 0, 0), (22, 0.3, 15, 0.0, 0, 0.0, 0.5, 1, 0, 0), (6, 0.0, 120, 0.0, 3, 1.0, 0.5, 1, 1, 0),
    (5, 0.0, 0, 0.0, 50, 0.0, 1, 1, 0, 0), (7, 0.5, 90, 0.0, 4, 0.0, 0.5, 0, 1, 0), (30, 0.0, 25, 0.0, 6, 0.0, 0, 1, 0, 0),
    # adverts, notices, sidebars, forms
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 0, 1, 0), (15, 0.0, 1, 1.0, 10, 0.0, 0, 0, 1, 0), (60, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0),
    (12, 0.5, 70, 0.0, 55, 0.0, 1, 0, 1, 0), (25, 0.1, 40, 0.0, 60, 0.0, 1, 0, 1, 0), (18, 0.1, 3, 0.0, 2, 1.0, 0.5, 0, 1, 0),
    (35, 0.0, 10, 0.0, 30, 0.0, 0.5, 0, 1, 0), (28, 0.0, 5, 0.0, 20, 0.0, 0, 1, 0, 0), (45, 0.0, 20, 0.0, 35, 0.0, 0, 1, 0, 0),
    (3, 0.0, 12, 0.0, 4, 0.0, 0.5, 1, 0, 0), (20, 0.0, 55, 0.0, 30, 0.0, 1, 1, 0, 0), (16, 0.2, 4, 0.0, 0, 0.0, 0, 0, 1, 0),
    # reader comments
    (30, 0.0, 50, 0.0, 24, 0.0, 0, 0, 1, 0), (80, 0.0, 12, 0.0, 6, 0.0, 0, 0, 1, 0), (24, 0.0, 3, 0.0, 40, 0.0, 1, 0, 1, 0),
    (55, 0.0, 30, 0.0, 20, 0.0, 0.5, 0, 1, 0), (5, 0.0, 28, 0.0, 33, 0.0, 0.5, 0, 1, 0), (110, 0.0, 60, 0.0, 70, 0.0, 1, 0, 1, 0),
    # comments and sidebars that hold much of the page
    (40, 0.0, 30, 0.0, 25, 0.0, 0.5, 0, 0.5, 0), (22, 0.0, 18, 0.0, 60, 0.0, 0.5, 0, 0.6, 0), (75, 0.0, 40, 0.0, 33, 0.0, 1, 0, 0.5, 0),
    (30, 0.0, 12, 0.0, 20, 0.0, 0.5, 0.5, 0, 0), (50, 0.0, 60, 0.0, 20, 0.0, 1, 0.6, 0, 0), (14, 0.1, 9, 0.0, 35, 0.0, 0.5, 0.5, 0.5, 0),
    # text beside an article, without a name
    (7, 0.0, 1, 1.0, 6, 0.0, 0, 0, 0, 0), (20, 0.0, 2, 1.0, 8, 0.0, 0, 0, 0, 0), (12, 0.0, 66, 0.0, 9, 0.0, 0, 0, 0, 0),
    (40, 0.0, 30, 0.0, 12, 0.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    # articles: headlines, paragraphs of any length, lists, links in the text
    (8, 0.0, 9, 0.0, 45, 0.0, 1, 0, 0, 1), (12, 0.0, 15, 0.0, 30, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 1.0, 80, 0.0, 1, 0, 0, 1),
    (45, 0.0, 8, 0.0, 60, 0.0, 1, 0, 0, 1), (120, 0.0, 45, 0.0, 90, 0.0, 1, 0, 0, 1), (1, 0.0, 90, 0.0, 70, 0.0, 1, 0, 0, 1),
    (1, 0.0, 1, 0.0, 2, 0.0, 1, 0, 0, 1), (2, 0.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1), (30, 0.2, 50, 0.0, 40, 0.1, 1, 0, 0, 1),
    (70, 0.0, 2, 0.0, 12, 0.0, 1, 0, 0, 1), (6, 0.5, 44, 0.0, 38, 0.0, 1, 0, 0, 1), (400, 0.0, 30, 0.0, 12, 0.0, 1, 0, 0, 1),
    (5, 1.0, 30, 0.0, 35, 0.0, 1, 0, 0, 1), (9, 0.0, 5, 0.0, 7, 0.0, 1, 0, 0, 1), (15, 0.0, 4, 0.0, 1, 0.0, 1, 0, 0, 1),
    (2, 1.0, 14, 0.0, 3, 1.0, 1, 0, 0, 1), (5, 1.0, 9, 0.0, 4, 1.0, 1, 0, 0, 1), (4, 1.0, 4, 1.0, 4, 1.0, 1, 0, 0, 1), (8, 1.0, 6, 1.0, 7, 1.0, 1, 0, 0, 1),
    (3, 1.0, 60, 0.0, 5, 1.0, 1, 0, 0, 1), (10, 1.0, 12, 0.0, 9, 0.0, 1, 0, 0, 1), (6, 1.0, 30, 0.0, 20, 0.0, 1, 0, 0, 1), (2, 1.0, 25, 0.1, 2, 1.0, 1, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1), (1, 1.0, 14, 0.0, 2, 1.0, 1, 0, 0, 1), (3, 1.0, 2, 1.0, 0, 0.0, 1, 0, 0, 1), (2, 1.0, 4, 1.0, 35, 0.0, 1, 0, 0, 1),
    (2, 0.0, 12, 0.0, 0, 0.0, 1, 0, 0, 1), (25, 0.1, 12, 0.5, 25, 0.1, 1, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    # pages without an article element
    (60, 0.0, 7, 0.0, 80, 0.0, 0.5, 0, 0, 1), (35, 0.1, 55, 0.0, 40, 0.0, 0.5, 0, 0, 1), (150, 0.0, 20, 0.0, 4, 1.0, 0.5, 0, 0, 1),
    (7, 0.0, 2, 1.0, 60, 0.0, 0.5, 0, 0, 1), (5, 0.0, 70, 0.0, 55, 0.0, 0.5, 0, 0, 1), (18, 0.0, 40, 0.0, 33, 0.0, 0.5, 0, 0, 1),
    (22, 0.0, 6, 0.0, 26, 0.0, 0.5, 0, 0, 1), (90, 0.2, 3, 1.0, 2, 1.0, 0.5, 0, 0, 1), (1, 0.0, 30, 0.0, 48, 0.0, 0.5, 0, 0, 1),
    # wrappers named after a part, forms around the page
    (60, 0.0, 9, 0.0, 70, 0.0, 0.5, 0, 0.05, 1), (8, 0.0, 1, 1.0, 50, 0.0, 0.5, 0, 0.1, 1), (25, 0.1, 40, 0.0, 30, 0.0, 0.5, 0, 0.35, 1),
    (45, 0.0, 20, 0.0, 35, 0.0, 0.5, 0.05, 0, 1), (6, 0.0, 2, 1.0, 44, 0.0, 0.5, 0.2, 0, 1), (33, 0.0, 50, 0.0, 5, 0.0, 0.5, 0.35, 0, 1),
    (80, 0.0, 30, 0.0, 60, 0.0, 1, 0, 0.1, 1), (10, 0.0, 6, 0.0, 40, 0.0, 1, 0.1, 0, 1), (28, 0.0, 35, 0.0, 22, 0.0, 0.5, 0.35, 0.35, 1),
    (30, 0.0, 0, 0.0, 0, 0.0, 0.5, 0, 0, 1), (12, 0.0, 20, 0.0, 14, 0.0, 0.5, 0, 0, 1), (4, 0.0, 0, 0.0, 0, 0.0, 0.5, 0, 0, 1),
)


# --- the tree ----------------------------------------------------------------------------------


@dataclass
class Node:
    """A leaf (``keep``) or a split: rows with feature ``at`` up to ``limit`` go to ``low``."""

    keep: bool
    at: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _gini(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return len(y) * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> Node:
    """A decision tree by Gini impurity: each split is the best one over all features and midpoints."""
    node = Node(bool(y.mean() >= 0.5))
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return node
    best = (_gini(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            if least <= low.sum() <= len(y) - least:
                best = min(best, (_gini(y[low]) + _gini(y[~low]), f, float(limit)))
    _, f, limit = best
    if f < 0:
        return node
    low = x[:, f] <= limit
    return Node(node.keep, f, limit, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def default_tree() -> Node:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def keeps(tree: Node, row: tuple) -> bool:
    while tree.low is not None:
        tree = tree.low if row[tree.at] <= tree.limit else tree.high
    return tree.keep


# --- blocks ------------------------------------------------------------------------------------

_START = re.compile(r"<(?=[!?/a-zA-Z])")
_NAME_END = re.compile(r"[\s/>\"']")
_SPECIAL = re.compile(r"[>\"']")
#: Names longer than this are no HTML element's.
_LONGEST_NAME = 40


class Tags:
    """Tags of a page from left to right.  No character is looked at again and again, whatever is left open."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()  # opening quotes from which no tag's end is reached
        self.seen = {}  # what was found last by each kind of search, and from where

    def _next(self, what, at: int) -> int:
        """Place of the next match of ``what`` (a pattern or one character), or the page's end; searches never overlap."""
        begin, found = self.seen.get(what, (0, -1))
        if not begin <= at <= found:
            if isinstance(what, str):
                found = self.page.find(what, at)
            else:
                m = what.search(self.page, at)
                found = m.start() if m else -1
            found = len(self.page) if found < 0 else found
            self.seen[what] = (at, found)
        return found

    def _end(self, at: int) -> int:
        """Place after the tag's closing bracket; -1 if there is none outside quotes."""
        opened = []
        while at <= self.last[">"]:
            at = self._next(_SPECIAL, at)
            if at == len(self.page) or at in self.dead:
                break
            c = self.page[at]
            if c == ">":
                return at + 1
            opened.append(at)
            if at >= self.last[c]:
                break
            at = self._next(c, at + 1) + 1
        self.dead.update(opened)
        return -1

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, name, attributes) of the next tag; the name is empty for comments and declarations."""
        page = self.page
        while (at := self._next(_START, at)) < len(page):
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, False, "", ""
            if page[at + 1] in "!?":
                end = self._next(">", at)
                if end < len(page):
                    return at, end + 1, False, "", ""
            else:
                closing = page[at + 1] == "/"
                begin = at + 1 + closing
                if page[begin:begin + 1].isascii() and page[begin:begin + 1].isalpha():
                    stop = self._next(_NAME_END, begin)
                    end = self._end(stop) if stop < len(page) else -1
                    if end >= 0:
                        return at, end, closing, page[begin:stop].lower() if stop - begin <= _LONGEST_NAME else "unknown", page[stop:end - 1]
            at += 1
        return None


_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named_furniture(attributes: str) -> int:
    """1 if a class, id or role names furniture, or the element is hidden; 2 if it names what readers wrote or other pages."""
    if "=" not in attributes and "hidden" not in attributes:
        return 0
    found = 0
    for value in _NAMED.findall(attributes):
        for name in value.strip("\"'").split():
            parts = {w.lower() for w in _PART.findall(name)}
            hints = parts & HINTS
            if not hints or not MODIFIERS.isdisjoint(parts):
                continue
            if hints - PLAIN or all(w in HINTS or w in LAYOUT or len(w) < 4 for w in parts):
                found = max(found, 2 if hints & BESIDE else 1)
    return found or int(_HIDDEN.search(attributes) is not None)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    #: Share of the words (of the main article's, inside it) that are not in the furniture, or named, element around the block; 0 without one.
    furniture: float
    named: float


@dataclass
class _Open:
    """An open element: the innermost marks around its content, and where the innermost block-level element is."""

    name: str
    article: int = -1
    furniture: int = -1
    named: int = -1
    mark: int = -1
    links: int = 0
    block: int = 0


@dataclass
class _Mark:
    """An element that is furniture or named like it: the mark around it, the innermost strict mark up to it, and its plain words."""

    around: int
    strict: int
    by_name: bool
    held: int = 0


@dataclass
class _Article:
    """An outermost article or main element: the mark around it, the number of marks before it, and its plain words."""

    mark: int
    first: int
    words: int = 0


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks that have a word, in order."""
    out: list[Block] = []
    stack, open_names = [_Open("")], Counter()
    marks: list[_Mark] = []
    articles: list[_Article] = []
    places: list[_Open] = []  # each block's place
    unclosed: set[str] = set()
    parts: list[str] = []
    link_parts: list[str] = []
    tags, at = Tags(page), 0

    def end_block() -> None:
        if parts:
            words = " ".join(html.unescape("".join(parts)).split())
            if words:
                linked = len(html.unescape(" ".join(link_parts)).split())
                out.append(Block(words, words.count(" ") + 1, linked, stack[-1].article >= 0, 0.0, 0.0))
                places.append(stack[-1])
            parts.clear()
            link_parts.clear()

    def text(begin: int, end: int) -> None:
        if end > begin:
            parts.append(page[begin:end])
            if stack[-1].links:
                link_parts.append(page[begin:end])

    def close(k: int) -> None:
        for element in stack[k:]:
            open_names[element.name] -= 1
        del stack[k:]

    while True:
        tag = tags.after(at)
        if tag is None:
            text(at, len(page))
            break
        start, end, closing, name, attributes = tag
        text(at, start)
        at = end
        if not name:
            continue  # a comment or a declaration
        if closing:
            if name in BLOCK:
                end_block()
            if open_names[name] > 0:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                if any(e.name in BLOCK for e in stack[k:]):
                    end_block()
                close(k)
            continue
        if name in RAW and not attributes.endswith("/"):
            found = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if found is not None:
                at = found.end()
                if name in BLOCK:
                    end_block()
                continue
            if name in RAW_TEXT:  # never closed: it goes on to the end
                break
            unclosed.add(name)
        if name in BLOCK:
            end_block()
            if name != "br" and stack[stack[-1].block].name == "p":
                close(stack[-1].block)
            if name in SIBLINGS and stack[-1].name == name:
                close(len(stack) - 1)
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "a" and stack[-1].name == "a":
            close(len(stack) - 1)  # links don't nest
        inside = stack[-1]
        hint = _named_furniture(attributes) if attributes else 0
        if name in WHOLE and (hint < 2 or name != "article"):
            hint = 0
        if name in BLOCK or name == "a" or hint:
            new = _Open(name, inside.article, inside.furniture, inside.named, inside.mark, inside.links + (name == "a"), len(stack) if name in BLOCK else inside.block)
            if hint or name in FURNITURE:
                strict = len(marks) if hint == 2 or name == "aside" else marks[inside.mark].strict if inside.mark >= 0 else -1
                marks.append(_Mark(inside.mark, strict, hint == 2))
                new.mark = len(marks) - 1
                new.furniture = new.mark if name in FURNITURE else inside.furniture
                new.named = new.mark if hint else inside.named
            if inside.article < 0 and (name in MAIN or 'role="main"' in attributes):
                articles.append(_Article(new.mark, len(marks)))
                new.article = len(articles) - 1
            stack.append(new)
            open_names[name] += 1
    end_block()
    if marks:
        _share(out, places, marks, articles)
    return out


def _share(blocks: list[Block], places: list[_Open], marks: list[_Mark], articles: list[_Article]) -> None:
    """Fill in each block's shares, by the main article and by what the marked elements hold."""
    plain = [max(0, b.words - b.linked) for b in blocks]
    for n, place in zip(plain, places):
        if place.mark >= 0:
            marks[place.mark].held += n
        if place.article >= 0:
            articles[place.article].words += n
    for mark in reversed(marks):
        if mark.around >= 0:
            marks[mark.around].held += mark.held
    # articles of readers or of other pages are none; one in an aside is, if nothing stands outside
    able = {i for i, a in enumerate(articles) if a.mark < 0 or marks[a.mark].strict < 0}
    if not able and not any(n for n, p in zip(plain, places) if p.mark < 0):
        able = {i for i, a in enumerate(articles) if not marks[marks[a.mark].strict].by_name}
    for block, place in zip(blocks, places):
        block.main = place.article in able
    # the main one: the longest outside all marks, else the longest
    main = max(able, key=lambda i: (articles[i].mark < 0, articles[i].words, -i), default=None)
    primary = None if main is None else articles[main]
    first = primary.first if primary else 0
    own = [main is not None and p.article == main for p in places]
    free = [m and p.mark < first or p.mark < 0 for m, p in zip(own, places)]
    page, inside = sum(plain), primary.words if primary else 0
    beside = {True: sum(n for n, m, f in zip(plain, own, free) if m and f), False: sum(n for n, m, f in zip(plain, own, free) if m or f)}
    for block, place, is_own in zip(blocks, places, own):
        least, whole = (first, inside or 1) if is_own else (0, page or 1)
        block.furniture = 1 - marks[place.furniture].held / whole if place.furniture >= least else 0.0
        block.named = 1 - marks[place.named].held / whole if place.named >= least else 0.0
        strict = marks[place.mark].strict if place.mark >= least else -1
        if strict >= least and beside[is_own] > 0:
            block.furniture, block.named = (block.furniture, 1.0) if marks[strict].by_name else (1.0, block.named)


def rows_of(blocks: list[Block]) -> list[tuple]:
    """The tree's features of each block."""
    any_main = any(b.main for b in blocks)
    sizes = [(0, 0.0)] + [(b.words, min(1.0, b.linked / b.words)) for b in blocks] + [(0, 0.0)]
    return [(*sizes[i + 1], *sizes[i], *sizes[i + 2], (1.0 if b.main else 0.0) if any_main else 0.5, float(b.furniture), float(b.named))
            for i, b in enumerate(blocks)]


def main_text(page: str | None, tree: Node) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    return " ".join(b.text for b, row in zip(blocks, rows_of(blocks)) if keeps(tree, row))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    narrow = pages.select(pages[id_column].alias("id"), pages[url_column].alias("url"), pages[html_column].alias("html"))
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in slices(batches, "html"):
            texts = [main_text(r.decode("utf-8") if r else None, tree) for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in narrow.schema}
    return (narrow.mapInArrow(run, f"id {types['id']}, url {types['url']}, text string, n_chars bigint")
            .withColumnRenamed("id", id_column).withColumnRenamed("url", url_column))
