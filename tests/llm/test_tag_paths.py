"""Main texts of pages built from known ones, and of the test pages by their article element."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from inkfold.llm import queries, tag_paths
from tests.llm.cases import prose

PAGES = "page_id bigint, url string, html string"


def sentences(seed, n):
    return [prose(seed * 100 + i, 5 + (7 * i + seed) % 60).capitalize() + "." for i in range(n)]


MENU = "<ul>" + "".join(f'<li><a href="/{i}">Topic {i}</a></li>' for i in range(8)) + "</ul>"
SCRIPT = '<style>p{margin:0}</style><script>if (a<b) document.write("<p>never</p>")</script>'
COMMENTS = "".join(f'<div class="comment"><p>Reader {i} says: no, never. Why?</p></div>' for i in range(9))


def article_page(blocks):
    title, *rest = blocks
    body = "".join(f"<p>{b}" + ("" if i % 3 == 1 else "</p>") for i, b in enumerate(rest))
    return (
        f"<!DOCTYPE html><html><head><title>x</title>{SCRIPT}</head><body><header>Site. Name.</header>"
        f"<nav>{MENU}</nav><div class='ad-box'>Buy this. Buy that. Now, please.</div><article><h1>{title}</h1>{body}"
        f"<form><p>Sign up. Get news.</p><input><button>Go</button></form></article>"
        f"<section id='comments'>{COMMENTS}</section><aside><p>{prose(7, 80)}</p></aside><footer>&copy; us.</footer>"
    )


def plain_page(blocks):
    """No article element, menus and lists of links without telling names."""
    title, *rest = blocks
    body = "".join(f"<p>{b}</p>" for b in rest)
    return (
        f"<html><body><div>{MENU}</div><table><tr><td>{MENU}</td><td><div><h2>{title}</h2>{body}</div></td></tr>"
        f"</table><div>{MENU}</div>{SCRIPT}<div class='cookie-notice'>We use cookies. Fine, are they?</div></body></html>"
    )


@pytest.mark.parametrize("page", [article_page, plain_page])
@pytest.mark.parametrize("n", [4, 12, 60])
def test_known_texts(page, n):
    blocks = sentences(n, n)
    assert tag_paths.main_blocks(page(blocks)) == blocks


def test_short_article_beside_longer_boilerplate():
    assert tag_paths.main_blocks(article_page(["Title", "Short."])) == ["Title", "Short."]


def test_parts_of_blocks():
    body = "<p>One <b>bo<i>ld</b>er</i>&amp;amp; <a href=x>link</a>,<br>next\n\t line&nbsp;end.<!-- no --></p>"
    page = f"<main><h1>Head &lt;1&gt;</h1>{body}<ul><li>first<li>second</ul><pre>a  b</pre><div>{MENU}</div></main>"
    assert tag_paths.main_blocks(page) == [
        "Head <1>", "One bolder&amp; link, next line end.", "first", "second", "a b",
    ]


def test_a_menu_that_is_never_closed():
    page = f"<nav><ul><li><a href=1>Topic</a><article><p>{prose(1)}.</p><p>Short.</p></article>"
    assert tag_paths.main_blocks(page) == [prose(1) + ".", "Short."]


def test_comments_in_article_elements():
    page = f"<article><p>{prose(1)}.</p></article>" + "".join(
        f"<article class='comment-body'><p>{prose(i, 90)}.</p></article>" for i in range(5)
    )
    assert tag_paths.main_blocks(page) == [prose(1) + "."]


@pytest.mark.parametrize(
    "page",
    ["", "<", "<!--", "<script>x", "<nav>a</nav>", "</p></div>", "<div class='ad'>x", "&lt;", "a < b", "<a href='", "\x00"],
)
def test_scraps(page):
    assert "".join(tag_paths.main_blocks(page)) in ("", "<", "a < b", "\x00")


def test_time_grows_with_the_page():
    def seconds(k):
        begin = time.perf_counter()
        for unit in ("<div>x", "<p><b>", '<a "', "<b></i>", "<ul><li>x<ul>", "<!-- <p "):
            tag_paths.main_blocks(unit * k)
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(16_000) < 16 * seconds(4_000) + 1


def rows():
    made = [(i, f"http://h/{i % 3}", article_page(sentences(i, 3 + i))) for i in range(12)]
    made += [(50, None, None), (51, "u", ""), (None, "u", "<p>Alone.</p>"), (52, "u", "<p>Alone.</p>")]
    return [*made, made[3], (53, "long", article_page(sentences(5, 3000)))]


def test_table(spark):
    pages = spark.createDataFrame(rows(), PAGES).withColumns({"_text": F.lit("z"), "_main_text": F.lit("old")})
    made = tag_paths.extract(pages)
    assert made.columns == ["page_id", "url", "html", "_text", "_main_text"]
    for r in made.collect():
        assert r["_main_text"] == "\n\n".join(tag_paths.main_blocks(r["html"] or ""))
        assert r["_text"] == "z"
    long = next(r for r in made.collect() if r["page_id"] == 53)
    assert long["_main_text"] == "\n\n".join(sentences(5, 3000))
    assert tag_paths.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_query_on_the_test_pages(spark):
    """All test pages have one article element; its blocks by plain patterns are the result."""
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    want = {}
    for r in pages:
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        parts = [html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in (" ".join(p.split()) for p in parts) if b)
        want[r["page_id"]] = (r["url"], text, len(text))
    found = queries.op12_tag_path_ratios(spark, folder).collect()
    assert len(found) == len(pages)
    assert {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in found} == want
    assert random.Random(1).choice(found)["text"]
