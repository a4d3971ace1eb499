"""Bulk extraction over stored pages and list items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions import extract as X
from inkfold.functions.html_select import split_elements, with_element_texts
from inkfold.functions.text import first_int, strip, text
from inkfold.params import SiteParams


def extract_article_links(items: DataFrame, site: SiteParams, html: str = "html") -> DataFrame:
    """First article link of each item as ``link``; items without one are dropped."""
    return (
        items.withColumn("link", F.get(X.article_links(F.col(html), site), F.lit(0)))
        .filter(F.col("link").isNotNull())
    )


def extract_article_id(rows: DataFrame, site: SiteParams, url: str = "url") -> DataFrame:
    return rows.withColumn("article_id", X.article_id(F.col(url), site))


def clean_page_title(rows: DataFrame, site: SiteParams, title: str = "title") -> DataFrame:
    return rows.withColumn(title, X.page_title(F.col(title), site.title_marker))


def title_fallback_first_line(
    rows: DataFrame, title: str = "title", content: str = "content"
) -> DataFrame:
    return rows.withColumn(title, X.title_or_first_line(text(title), text(content)))


def extract_page_counters(
    pages: DataFrame, patterns: dict[str, str], html: str = "html"
) -> DataFrame:
    """One integer column per ``{name: pattern}``, 0 where the pattern has no match."""
    return pages.withColumns({n: first_int(text(html), p) for n, p in patterns.items()})


def extract_label_count(rows: DataFrame, label: str, out: str) -> DataFrame:
    """The first integer in a label such as a like button's text."""
    return rows.withColumn(out, first_int(text(label), r"(\d+)"))


def extract_page_body(
    pages: DataFrame, main_tag: str, fallback_tags: list[str], title: str, html: str = "html"
) -> DataFrame:
    """Adds ``content`` and ``is_column`` where the elements are plain, un-nested tags."""
    body, is_column = X.page_body(
        X.element_text(F.col(html), main_tag),
        [X.element_text(F.col(html), t) for t in fallback_tags],
        F.col(title),
    )
    return pages.withColumns({"content": body, "is_column": is_column})


def extract_page_body_nested(
    pages: DataFrame, site: SiteParams, title: str, html: str = "html"
) -> DataFrame:
    """The same with the site's class selectors, whose elements nest; drops ``html``."""
    names = {"_main": site.body_selector}
    names.update({f"_fb{i}": s for i, s in enumerate(site.body_fallback_selectors)})
    texts = with_element_texts(pages, html, names)
    body, is_column = X.page_body(
        F.col("_main"), [F.col(n) for n in names if n != "_main"], F.col(title)
    )
    return texts.withColumns({"content": body, "is_column": is_column}).drop(*names)


def derive_user_name(
    rows: DataFrame, site: SiteParams, name: str, page_title: str, user_id: str
) -> DataFrame:
    return rows.withColumn(
        "user_name",
        X.user_name(text(name), text(page_title), F.col(user_id), site.name_suffix),
    )


def flag_blocked_pages(
    pages: DataFrame, site: SiteParams, title: str = "title", html: str = "html"
) -> DataFrame:
    return pages.withColumn("blocked", X.is_blocked(F.col(title), F.col(html), site))


def list_item_heuristic(
    items: DataFrame,
    site: SiteParams,
    title: str = "title",
    source: str = "source",
    content: str = "content",
) -> DataFrame:
    """Keep the list items that look like articles."""
    return items.filter(
        X.looks_like_article(F.col(title), F.col(source), F.col(content), site)
    )


# Detail fields that overlay list fields of the same name, and those only a detail has.
OVERLAY = ("title", "publish_time", "content", "likes", "comments")
DETAIL_ONLY = ("author", "is_column")


def merge_list_detail(items: DataFrame, details: DataFrame) -> DataFrame:
    """Detail fields laid over list fields, matched on the item's link.

    A detail that exists wins even where its field is empty or NULL, so this tests
    for the row, not for the value. ``details`` holds one row per url and any of the
    detail fields.
    """
    fields = [c for c in (*OVERLAY, *DETAIL_ONLY) if c in details.columns]
    d = details.select(F.col("url").alias("_url"), *[F.col(c).alias(f"_{c}") for c in fields])
    joined = items.join(d, F.col("link") == F.col("_url"), "left")
    found = F.col("_url").isNotNull()

    def overlaid(c: str):
        if c not in items.columns:
            return F.col(f"_{c}").alias(c)
        return F.when(found, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(
        *[c for c in items.columns if c not in fields],
        *[overlaid(c) for c in fields],
        F.col("_url").alias("url"),
    )


def page_title_of(html: str = "html"):
    """The ``<title>`` text of a stored page."""
    return strip(F.regexp_extract(F.col(html), X.PAGE_TITLE, 1))


def parse_list_items(pages: DataFrame, site: SiteParams) -> DataFrame:
    """List items of stored author pages (``user_id, html``): one row per timeline item
    that links to an article, with its place ``pos`` in the page."""
    fields = {
        "title": site.item_title_selector,
        "content": site.item_content_selector,
        "publish_time": site.item_time_selector,
        "_likes": site.item_likes_selector,
    }
    items = split_elements(pages.select("user_id", "html"), "html", site.item_selector, fields)
    linked = extract_article_id(extract_article_links(items, site), site, "link")
    titled = title_fallback_first_line(linked)
    return titled.select(
        "user_id",
        "article_id",
        "title",
        text("content").alias("content"),
        text("publish_time").alias("publish_time"),
        "link",
        first_int(text("_likes"), r"(\d+)").alias("likes"),
        F.lit(0).alias("comments"),
        F.col("pos").cast("bigint").alias("pos"),
    )


def page_details(pages: DataFrame, site: SiteParams) -> DataFrame:
    """One detail row per stored article page (``url, html``); verification walls are left out.

    Title and counters come from built-in functions, element texts from one parser pass.
    """
    titled = pages.select("url", "html", page_title_of().alias("_page_title"))
    open_pages = flag_blocked_pages(titled, site, "_page_title").filter(~F.col("blocked"))
    counted = extract_page_counters(
        open_pages, {"likes": site.likes_pattern, "comments": site.comments_pattern}
    )
    fallbacks = {f"_fb{i}": s for i, s in enumerate(site.body_fallback_selectors)}
    texts = with_element_texts(
        counted,
        "html",
        {
            "_author": site.author_selector,
            "_time": site.time_selector,
            "_main": site.body_selector,
            **fallbacks,
        },
    )
    title = X.page_title(F.col("_page_title"), site.title_marker)
    body, is_column = X.page_body(F.col("_main"), [F.col(n) for n in fallbacks], title)
    return texts.select(
        "url",
        title.alias("title"),
        text("_author").alias("author"),
        text("_time").alias("publish_time"),
        body.alias("content"),
        "likes",
        "comments",
        is_column.alias("is_column"),
    )
