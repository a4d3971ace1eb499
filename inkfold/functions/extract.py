"""Column expressions that read fields out of URLs, titles and page source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkfold.functions.text import before_marker, cut, first_line, nonempty, strip
from inkfold.params import SiteParams

HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
QUOTES = r"""^["']|["']$"""
PAGE_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
MAX_TITLE = 100
MIN_FIRST_LINE = 5
MIN_FALLBACK_BODY = 20
MIN_HEURISTIC_CONTENT = 200


def article_links(html: Column, site: SiteParams) -> Column:
    """All absolute article links of a page or list item, in page order."""
    values = F.transform(
        F.regexp_extract_all(html, F.lit(HREF), 1),
        lambda h: F.replace(F.regexp_replace(h, QUOTES, ""), F.lit("&amp;"), F.lit("&")),
    )
    hrefs = F.filter(values, lambda h: h != "")
    absolute = F.transform(
        hrefs,
        lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(site.base_url), h)),
    )
    return F.filter(
        absolute,
        lambda h: h.rlike(site.url_pattern) & ~h.contains(F.lit(site.comment_marker)),
    )


def article_id(url: Column, site: SiteParams) -> Column:
    """The number that ends an article URL, else a short hash of the URL."""
    return F.coalesce(
        nonempty(F.regexp_extract(url, site.article_id_pattern, 1)),
        F.substring(F.md5(url), 1, 12),
    )


def page_title(title: Column, marker: str | None) -> Column:
    """Page title without the site's name and the dashes in front of it, at most 100 chars."""
    head = strip(before_marker(title, marker))
    for dash in ("-", "—", "–"):
        head = F.rtrim(head, F.lit(dash))
    clean = F.coalesce(strip(head), strip(title), F.lit(""))
    return F.when(
        F.length(clean) > MAX_TITLE, F.concat(cut(clean, MAX_TITLE), F.lit("..."))
    ).otherwise(clean)


def title_or_first_line(title: Column, content: Column) -> Column:
    """The stripped title; where empty, the content's first line if it is long enough."""
    line = first_line(strip(content))
    return F.coalesce(
        nonempty(strip(title)),
        F.when(F.length(line) > MIN_FIRST_LINE, cut(line, MAX_TITLE)),
        F.lit(""),
    )


def element_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element, tags removed; NULL where there is none."""
    found = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    present = html.rlike(rf"(?i)<{tag}\b")
    return F.when(present, strip(F.regexp_replace(found, "<[^>]*>", "")))


def page_body(main: Column, fallbacks: list[Column], title: Column) -> tuple[Column, Column]:
    """Body text and whether it came from the main element (a column article).

    ``main`` and ``fallbacks`` are stripped element texts, NULL where the page has no
    such element.
    """
    choices = [F.when(F.length(f) > MIN_FALLBACK_BODY, f) for f in fallbacks]
    body = F.coalesce(main, *choices, nonempty(title), F.lit(""))
    return body, main.isNotNull()


def user_name(
    name: Column, page_title_text: Column, user_id: Column, suffix: str | None
) -> Column:
    """Name element, else the page title in front of the suffix, else the id."""
    return F.coalesce(
        nonempty(strip(name)), nonempty(strip(before_marker(page_title_text, suffix))), user_id
    )


def is_blocked(title: Column, html: Column, site: SiteParams) -> Column:
    """Verification wall: a marker in the title or another one in the source."""
    return F.coalesce(title.contains(F.lit(site.blocked_title_marker)), F.lit(False)) | (
        F.coalesce(html.contains(F.lit(site.blocked_page_marker)), F.lit(False))
    )


def looks_like_article(title: Column, source: Column, content: Column, site: SiteParams) -> Column:
    """Long title; otherwise not a repost and with long content. Order matters."""
    return (
        F.when(F.length(strip(title)) > MIN_FIRST_LINE, True)
        .when(source.contains(F.lit(site.repost_marker)), False)
        .otherwise(F.coalesce(F.length(content) > MIN_HEURISTIC_CONTENT, F.lit(False)))
    )
