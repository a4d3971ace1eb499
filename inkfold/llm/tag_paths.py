"""Main text of web pages by the ratios of their tag paths.

Every block of text lies at the end of a path of block elements from the root. Text length
and punctuation are aggregated per path, so all paragraphs of an article share the figures
of one path, the short ones too. Blocks take the two ratios of their path in page order, a
Gaussian smooths both along the page, their product is the block's score, and blocks that
score at least the standard deviation of the scores are content. Paths that are mostly links
score nothing, nor does anything inside elements that are no part of an article by their
tag, role, class or id. The element that holds most of the content bounds the result: of an
article element all blocks count, of another one those between the first and the last
content block.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import neutral

RESULT = "_main_text"
LINKED = 0.6  # share of link text from which a path is a menu
MOST = 0.5  # share of the content that an article element has to hold
DEEP = 0.7  # share of the content that any other element has to hold
WEIGHTS = np.array([0.05, 0.25, 0.4, 0.25, 0.05])

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
# Closing tags of other elements, and of paragraphs, do not reach past these.
STRUCTURE = frozenset(
    "article aside body center dd dialog div dl dt fieldset figure footer form header html li main nav ol "
    "section table td th tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}
LISTS = frozenset("ul ol dl table".split())  # an item does not end the item that its list is in
MAIN = frozenset(("article", "main"))
# No part of an article by tag; of a page's header and an article's own only the former.
OUTSIDE = frozenset(
    "nav footer aside form dialog button select option textarea label fieldset input noscript template svg "
    "iframe object canvas audio video menu head".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login "
    "signin sidebar sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination "
    "pager toolbar topbar masthead header footer copyright comment comments commentlist disqus respond replies reply "
    "discussion share sharing social related recommended recommendations trending search form hidden".split()
)
# "no-sidebar" and "category-social" say nothing about the element.
NOT_HERE = frozenset("no has with without category tag".split())
IN_MAIN = frozenset(("header", "masthead"))  # of an article itself: it may hold the headline
ANSWERS = frozenset("comment comments commentlist reply replies respond disqus".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                                          # comment
    |<(script|style|textarea|title|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)  # text that is no text
    |<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+)>  # tag
    |<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)(?:>|\Z)                      # tag with a stray quote
    |<[!?/][^<>]*(?:>|\Z)""",
    re.S | re.I | re.X,
)

# Executors get this code with their tasks; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def is_outside(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether role, class, id or visibility say that an element is no part of an article.

    Of an article element only the names of reader comments count.
    """
    if not attributes or tag in ("html", "body"):
        return False
    names = ANSWERS if tag in MAIN else WORDS - IN_MAIN if in_main else WORDS
    lowered = attributes.lower()
    if re.search(r"(?:^|\s)hidden(?:[\s=/]|$)", lowered) or "display:none" in lowered.replace(" ", ""):
        return True
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in NAME.findall(one)]
                if not NOT_HERE.intersection(words[:1]) and not names.isdisjoint(words):
                    return True
    return False


class Page:
    """Elements and blocks of a page. Elements are numbered in page order, the root is 0."""

    def __init__(self, html: str):
        self.parent, self.tags, self.outside, self.closed, self.last = [0], ["html"], [False], [True], [0]
        self.paths, self.path_of = {}, [0]  # (path of the parent, label) -> path; of each element
        self.block_of = [0]  # nearest block element of each
        self.blocks: list[tuple[int, list[tuple[int, str]]]] = []  # (block element, its pieces)
        self._stack, self._open, self._walls = [0], {}, [0]
        at = 0
        self._block()
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if tag:
                attributes = m[4] if m[3] else m[7]
                (self._end if (m[2] or m[5]) else self._start)(tag.lower(), attributes)
        self._text(html[at:])
        while len(self._stack) > 1:
            self._pop(False)

    def _block(self) -> None:
        top = self._stack[-1]
        if self.blocks and not self.blocks[-1][1]:
            self.blocks.pop()
        self.blocks.append((self.block_of[top], []))

    def _text(self, text: str) -> None:
        if text:
            self.blocks[-1][1].append((self._stack[-1], unescape(text)))

    def _pop(self, closed: bool) -> None:
        element = self._stack.pop()
        depth = len(self._stack)
        self.closed[element], self.last[element] = closed, len(self.tags) - 1
        self._open[self.tags[element]].pop()
        if self._walls[-1] == depth:
            self._walls.pop()

    def _close(self, tag: str, wall: int, explicit: bool) -> None:
        """Close the innermost open ``tag`` that is not below the wall, with all in it."""
        places = self._open.get(tag)
        if places and places[-1] >= wall:
            place = places[-1]
            while len(self._stack) > place + 1:
                self._pop(False)
            self._pop(explicit)

    def _wall(self, names: frozenset[str]) -> int:
        return max((self._open[n][-1] for n in names if self._open.get(n)), default=0)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and self._open.get(tag):
            return
        if tag == "br":
            self._text("\n")
            return
        block = tag in BLOCKS
        if block:
            self._close("p", self._walls[-1], False)
        if tag in ENDS:
            self._close(ENDS[tag], self._wall(LISTS), False)
            if tag in ("dt", "dd"):
                self._close("dd" if tag == "dt" else "dt", self._wall(LISTS), False)
        if tag in VOID:
            if block:
                self._block()
            return
        parent, element = self._stack[-1], len(self.tags)
        self.parent.append(parent)
        self.tags.append(tag)
        self.closed.append(False)
        self.last.append(element)
        in_main = any(self._open.get(m) for m in MAIN)
        by_tag = tag in OUTSIDE or (tag == "header" and not in_main)
        self.outside.append(by_tag or is_outside(tag, attributes, in_main))
        path = self.path_of[parent]
        if block:
            path = self.paths.setdefault((path, tag), len(self.paths) + 1)
        self.path_of.append(path)
        self.block_of.append(element if block else self.block_of[parent])
        self._open.setdefault(tag, []).append(len(self._stack))
        if tag in STRUCTURE:
            self._walls.append(len(self._stack))
        self._stack.append(element)
        if block:
            self._block()

    def _end(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text("\n")
            return
        self._close(tag, 0 if tag in STRUCTURE else self._walls[-1], True)
        if tag in BLOCKS:
            self._block()

    def left_out(self) -> list[bool]:
        """Whether each element, or one around it, is no part of an article.

        Where that leaves out every article element of the page, as when a menu is never
        closed, what is around an article element counts again.
        """
        def spread(outside):
            out = list(outside)
            for i in range(1, len(out)):
                out[i] = out[i] or out[self.parent[i]]
            return out

        out = spread(self.outside)
        mains = [i for i, tag in enumerate(self.tags) if tag in MAIN]
        if mains and all(out[i] for i in mains):
            outside = list(self.outside)
            seen = set()
            for i in mains:
                while i and i not in seen:
                    seen.add(i)
                    if not self.closed[i] or self.tags[i] == "form":
                        outside[i] = False
                    i = self.parent[i]
            out = spread(outside)
        return out


def _scores(paths: list[int], sizes: np.ndarray, marks: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Fused, smoothed ratios of the blocks by their paths."""
    _, at = np.unique(paths, return_inverse=True)
    count = np.bincount(at)
    size, mark, link = (np.bincount(at, x) for x in (sizes, marks, linked))
    menu = link > LINKED * size
    ratios = [np.where(menu, 0, x / count)[at] for x in (size, mark)]
    half = len(WEIGHTS) // 2
    norm = np.convolve(np.ones(len(at) + 2 * half), WEIGHTS, "same")[half:-half]
    smooth = [np.convolve(np.pad(r, half), WEIGHTS, "valid") / norm for r in ratios]
    return np.where(menu[at], 0, smooth[0] * (1 + smooth[1]))


def main_blocks(html: str) -> list[str]:
    """Texts of the content blocks in page order."""
    page = Page(html)
    out = page.left_out()
    owners, texts, links = [], [], []
    in_link = [False]
    for i in range(1, len(page.tags)):
        in_link.append(page.tags[i] == "a" or in_link[page.parent[i]])
    for owner, pieces in page.blocks:
        kept = [(e, t) for e, t in pieces if not out[e]]
        text = " ".join("".join(t for _, t in kept).split())
        if text:
            owners.append(owner)
            texts.append(text)
            links.append(sum(len(t.strip()) for e, t in kept if in_link[e]))
    if not texts:
        return []
    sizes = np.array([len(t) for t in texts], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for t in texts], float)
    scores = _scores([page.path_of[o] for o in owners], sizes, marks, np.array(links, float))
    content = (scores > 0) & (scores >= np.std(scores))
    if not content.any():
        return []
    inside, whole = _container(page, owners, np.where(content, sizes, 0))
    place = np.array(owners)
    within = (place >= inside) & (place <= page.last[inside])
    if whole:
        chosen = within & (scores > 0)
    else:
        first, last = np.flatnonzero(content)[[0, -1]]
        between = np.arange(len(texts))
        chosen = content | (within & (scores > 0) & (between > first) & (between < last))
        if first and re.fullmatch("h[1-6]", page.tags[owners[first - 1]]) and within[first - 1]:
            chosen[first - 1] = True
    return [t for t, c in zip(texts, chosen) if c]


def _container(page: Page, owners: list[int], weights: np.ndarray) -> tuple[int, bool]:
    """The element that holds the content, and whether it is an article element."""
    held = np.zeros(len(page.tags))
    np.add.at(held, owners, weights)
    for i in range(len(held) - 1, 0, -1):
        held[page.parent[i]] += held[i]
    best, deepest = None, 0
    for i in range(len(held)):
        if page.tags[i] in MAIN and held[i] >= MOST * held[0]:
            best = i
        if page.tags[i] in STRUCTURE and held[i] >= DEEP * held[0]:
            deepest = i
    return (deepest, False) if best is None else (best, True)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``_main_text``: the blocks of the main text, an empty line between them.

    Character references are decoded once, white space inside a block becomes one space.
    Null and empty pages, and pages without content, have an empty text. Pages are treated
    one by one and whole, so repeated rows and urls have equal texts and an empty table
    gives an empty result. Markup of any kind is read in one pass, in time that grows with
    its length. Columns pass unchanged, whatever their names, but one called ``_main_text``
    gives way to the text. Nothing is shuffled.
    """
    pages = pages.select(*(pages[c] for c in pages.columns if c != RESULT))
    outer = [*pages.columns, RESULT]
    pages, html_col = neutral(pages, html_col)

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(["\n\n".join(main_blocks(p.as_py() or "")) for p in batch], pa.string())

    main = F.arrow_udf(texts, "string")(F.col(html_col))
    return pages.withColumn("_text", main).toDF(*outer)
