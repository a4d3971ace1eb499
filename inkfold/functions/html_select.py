"""Element texts of nested HTML, where a pattern cannot balance tags.

A small standard-library parser run over Arrow batches, for selectors whose element may
contain elements of the same tag. Plain tags are cheaper with the regular expressions in
``functions.extract``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The parser travels with the task, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("p div section article li ul ol h1 h2 h3 h4 h5 h6 tr table blockquote".split())
SILENT = frozenset(("script", "style"))

_PART = re.compile(r"(?P<tag>[a-zA-Z][\w-]*)?(?P<classes>(?:\.[\w-]+)*)(?P<attr>\[[^\]]+\])?")


class Part(NamedTuple):
    """One step of a selector: tag, classes, and an attribute holding a text."""

    tag: str | None
    classes: tuple[str, ...]
    attr: tuple[str, str] | None

    def fits(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag and self.tag != tag:
            return False
        if self.classes and not set(self.classes) <= set(attrs.get("class", "").split()):
            return False
        return self.attr is None or self.attr[1] in attrs.get(self.attr[0], "")


Selector = list[list[Part]]


def _parse_part(text: str) -> Part:
    found = _PART.fullmatch(text)
    if not found or not text:
        raise ValueError(f"unsupported selector part: {text!r}")
    attr = None
    if found["attr"]:
        name, _, value = found["attr"][1:-1].partition("*=")
        attr = (name, value.strip("\"'"))
    tag = found["tag"].lower() if found["tag"] else None
    return Part(tag, tuple(c for c in found["classes"].split(".") if c), attr)


def parse_selectors(selectors: list[str]) -> list[Selector]:
    """Each selector: comma-separated choices of space-separated (descendant) parts."""
    return [
        [[_parse_part(part) for part in choice.split()] for choice in selector.split(",")]
        for selector in selectors
    ]


class _Elements(HTMLParser):
    """Walks a page once, keeping the stack of open elements and watching selectors."""

    def __init__(self, selectors: list[Selector]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.stack: list[tuple[str, dict[str, str]]] = []

    def matches(self, selector: Selector) -> bool:
        """Whether the innermost open element fits one of the choices."""
        for choice in selector:
            if not choice[-1].fits(*self.stack[-1]):
                continue
            wanted = len(choice) - 2
            for element in reversed(self.stack[:-1]):
                if wanted >= 0 and choice[wanted].fits(*element):
                    wanted -= 1
            if wanted < 0:
                return True
        return False

    def handle_starttag(self, tag, attrs):
        self.stack.append((tag, {k: v or "" for k, v in attrs}))
        self.opened(tag)
        if tag in VOID:
            self.close_top()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(open_tag == tag for open_tag, _ in self.stack):
            while self.close_top() != tag:
                pass

    def close_top(self) -> str:
        self.closing(len(self.stack) - 1)
        return self.stack.pop()[0]

    def finish(self, html: str):
        self.feed(html)
        self.close()
        while self.stack:
            self.close_top()


class _FirstTexts(_Elements):
    """The text of the first element of each selector."""

    def __init__(self, selectors: list[Selector]):
        super().__init__(selectors)
        self.texts: list[list[str] | None] = [None] * len(selectors)
        self.open_at: dict[int, int] = {}
        self.silent = 0

    def opened(self, tag):
        for i, selector in enumerate(self.selectors):
            if self.texts[i] is None and self.matches(selector):
                self.texts[i] = []
                self.open_at[i] = len(self.stack) - 1
        self.silent += tag in SILENT
        if tag == "br" or tag in BLOCK:
            self.add("\n")

    def closing(self, depth):
        tag = self.stack[depth][0]
        if tag in BLOCK:
            self.add("\n")
        self.silent -= tag in SILENT
        self.open_at = {i: d for i, d in self.open_at.items() if d != depth}

    def handle_data(self, data):
        if not self.silent:
            self.add(data)

    def add(self, piece):
        for i in self.open_at:
            self.texts[i].append(piece)


class _Sources(_Elements):
    """The source of every element of one selector, in page order."""

    def __init__(self, selector: Selector, html: str):
        super().__init__([selector])
        self.html = html
        self.line_starts = [0] + [m.end() for m in re.finditer("\n", html)]
        self.starts: dict[int, tuple[int, int]] = {}
        self.sources: list[str] = []

    def position(self) -> int:
        line, column = self.getpos()
        return self.line_starts[line - 1] + column

    def opened(self, tag):
        if self.matches(self.selectors[0]):
            self.starts[len(self.stack) - 1] = (len(self.sources), self.position())
            self.sources.append("")

    def closing(self, depth):
        if depth in self.starts:
            n, start = self.starts.pop(depth)
            self.sources[n] = self.html[start : self.position()]


def first_texts(html: str | None, selectors: list[Selector]) -> list[str | None]:
    """Text of the first element of each selector, NULL where there is none."""
    page = _FirstTexts(selectors)
    page.finish(html or "")
    return [
        None if t is None else re.sub(r"\n{2,}", "\n", "".join(t)).strip() for t in page.texts
    ]


def element_sources(html: str | None, selector: Selector) -> list[str]:
    page = _Sources(selector, html or "")
    page.finish(html or "")
    return page.sources


def _schema(df: DataFrame, kept: list[str], *added: StructField) -> StructType:
    return StructType([df.schema[c] for c in kept] + list(added))


def _text_fields(names: list[str]) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


def with_element_texts(df: DataFrame, html: str, selectors: dict[str, str]) -> DataFrame:
    """Replace the ``html`` column by one text column per ``{name: selector}``."""
    names, parsed = list(selectors), parse_selectors(list(selectors.values()))
    kept = [c for c in df.columns if c != html]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [first_texts(page, parsed) for page in batch[html]]
            found = pd.DataFrame(texts, columns=names, index=batch.index, dtype=object)
            yield pd.concat([batch[kept], found], axis=1)

    return df.mapInPandas(run, _schema(df, kept, *_text_fields(names)))


def split_elements(
    df: DataFrame, html: str, item: str, selectors: dict[str, str]
) -> DataFrame:
    """One row per element that ``item`` selects: its place ``pos`` in the page, its source
    in the ``html`` column, and the selected texts inside it."""
    names, parsed = list(selectors), parse_selectors(list(selectors.values()))
    (item_selector,) = parse_selectors([item])
    kept = [c for c in df.columns if c != html]
    schema = _schema(
        df, kept, StructField("pos", IntegerType(), True), *_text_fields([html, *names])
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sources = [element_sources(page, item_selector) for page in batch[html]]
            places = [n for n, found in enumerate(sources) for _ in found]
            items = [
                (pos, source, *first_texts(source, parsed))
                for found in sources
                for pos, source in enumerate(found)
            ]
            rows = pd.DataFrame(items, columns=["pos", html, *names])
            yield pd.concat([batch[kept].iloc[places].reset_index(drop=True), rows], axis=1)

    return df.mapInPandas(run, schema)
