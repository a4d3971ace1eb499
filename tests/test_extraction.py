"""Extraction rules on small inline rows."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkfold.functions import extract as E
from inkfold.functions.html_select import first_texts, parse_selectors
from inkfold.operators import extraction as X
from inkfold.params import SiteParams

SITE = SiteParams(
    base_url="https://site.example", title_marker="SITE", name_suffix="'s page", repost_marker="原文"
)


def apply(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", expr.alias("x")).orderBy("i").collect()]


def test_first_article_link(spark):
    items = spark.createDataFrame(
        [
            (1, '<a href="/u/1">u</a><a class=x href="/12/34">t</a><a href="/5/6">t</a>'),
            (2, '<a href="/12/34#comment">c</a>'),
            (3, "<a HREF='https://site.example/7/8'>t</a>"),
            (4, '<a href="">t</a><b href="/1/2">no</b>'),
            (5, '<a href="https://other.example/1/2">t</a>'),
        ],
        "i int, html string",
    )
    links = {r.i: r.link for r in X.extract_article_links(items, SITE).collect()}
    assert links == {1: "https://site.example/12/34", 3: "https://site.example/7/8"}


def test_article_id(spark):
    urls = ["https://site.example/12/345", "https://site.example/u/1", "https://site.example/12/345/"]
    hashed = [hashlib.md5(u.encode()).hexdigest()[:12] for u in urls]
    assert apply(spark, urls, E.article_id(F.col("v"), SITE)) == ["345", hashed[1], hashed[2]]


@pytest.mark.parametrize(
    "title,expected",
    [
        ("A title - SITE", "A title"),
        ("A — – SITE - SITE", "A —"),
        ("A –—- SITE", "A"),
        ("SITE", ""),
        (" no marker - ", "no marker -"),
        ("x" * 100, "x" * 100),
        ("x" * 101, "x" * 100 + "..."),
        ("", ""),
    ],
)
def test_page_title(spark, title, expected):
    assert apply(spark, [title], E.page_title(F.col("v"), "SITE")) == [expected]


def test_title_falls_back_to_a_long_first_line(spark):
    rows = spark.createDataFrame(
        [(1, " t ", "c"), (2, "", "\n 123456 \nrest"), (3, " ", "12345\nrest is longer"), (4, None, "y" * 120)],
        "i int, title string, content string",
    )
    got = {r.i: r.title for r in X.title_fallback_first_line(rows).collect()}
    assert got == {1: "t", 2: "123456 ", 3: "", 4: "y" * 100}


def test_counters(spark):
    pages = spark.createDataFrame([('{"likeCount":12,"likeCount":3}',), ("x",), (None,)], "html string")
    got = X.extract_page_counters(pages, {"likes": SITE.likes_pattern, "comments": SITE.comments_pattern})
    assert [(r.likes, r.comments) for r in got.collect()] == [(12, 0), (0, 0), (0, 0)]


def test_page_body_order(spark):
    pages = spark.createDataFrame(
        [
            (1, "<main> <b>body</b> </main><p>long enough paragraph text</p>", "t"),
            (2, "<p>exactly twenty chars</p><h1>a heading of more than twenty</h1>", "t"),
            (3, "<p>short</p>", "the title"),
            (4, "<main></main>", "t"),
        ],
        "i int, html string, title string",
    )
    got = {r.i: (r.content, r.is_column) for r in X.extract_page_body(pages, "main", ["p", "h1"], "title").collect()}
    assert got == {
        1: ("body", True),
        2: ("a heading of more than twenty", False),
        3: ("the title", False),
        # The main element counts even where it is empty.
        4: ("", True),
    }


def test_nested_elements():
    html = (
        '<div class="a x"><div>in<br>side<script>no()</script></div><p>two</p></div>'
        '<div class="a">second</div><i class="b">bee</i>'
    )
    texts = first_texts(html, parse_selectors([".a", "i.b", ".none", "div div", "p, i"]))
    assert texts == ["in\nside\ntwo", "bee", None, "in\nside", "two"]
    assert first_texts("<p>a<p>b", parse_selectors(["p"])) == ["a\nb"]
    assert first_texts(None, parse_selectors(["p"])) == [None]


def test_attribute_selector():
    html = '<div class="s"><a href="/x/1">no</a><a href="/u/1">yes</a></div><img class="qrcode">'
    assert first_texts(html, parse_selectors(['.s a[href*="/u/"]', "[class*=qr]"])) == ["yes", ""]
    with pytest.raises(ValueError):
        parse_selectors(["a > b"])


def test_nested_page_body(spark):
    pages = spark.createDataFrame(
        [
            (1, '<div class="article__bd__detail"><div>one</div><div>two</div></div>', "t"),
            (2, '<div class="status-content"><div>a status text of more than twenty</div></div>', "t"),
            (3, "<p>x</p>", "title"),
        ],
        "i int, html string, title string",
    )
    rows = X.extract_page_body_nested(pages, SITE, "title").collect()
    assert {r.i: (r.content, r.is_column) for r in rows} == {
        1: ("one\ntwo", True),
        2: ("a status text of more than twenty", False),
        3: ("title", False),
    }


def test_page_details(spark):
    pages = spark.createDataFrame(
        [
            (
                "u1",
                "<title>T - SITE</title><div class='article__bd__from'><a>Ann</a><span class='date'>today</span>"
                "</div><div class='article__bd__detail'>body</div><script>{\"likeCount\":5}</script>",
            ),
            ("u2", "<title>Verification</title>"),
        ],
        "url string, html string",
    )
    (row,) = X.page_details(pages, SITE).collect()
    assert (row.url, row.title, row.author, row.publish_time) == ("u1", "T", "Ann", "today")
    assert (row.content, row.is_column, row.likes, row.comments) == ("body", True, 5, 0)


def test_list_items(spark):
    page = (
        "<div class='timeline__item'><h3>A long title</h3><a href='/1/11'>x</a><div class='content'>c1</div>"
        "<span class='like'>赞 7</span></div>"
        "<div class='timeline__item'><a href='/1/12'>x</a><div class='content'> first line\nrest</div></div>"
        "<div class='timeline__item'><div class='content'>no link</div></div>"
    )
    pages = spark.createDataFrame([("1", page)], "user_id string, html string")
    rows = X.parse_list_items(pages, SITE).orderBy("pos").collect()
    assert [(r.article_id, r.title, r.content, r.likes, r.comments, r.pos) for r in rows] == [
        ("11", "A long title", "c1", 7, 0, 0),
        ("12", "first line", "first line\nrest", 0, 0, 1),
    ]


def test_user_name(spark):
    rows = spark.createDataFrame(
        [(" Ann ", "x's page", "1"), ("", "Bob 's page", "2"), (None, "'s page", "3"), ("", "none", "4")],
        "name string, title string, id string",
    )
    got = [r.user_name for r in X.derive_user_name(rows, SITE, "name", "title", "id").collect()]
    assert got == ["Ann", "Bob", "3", "4"]


def test_blocked(spark):
    pages = spark.createDataFrame(
        [("Verification", "x"), ("t", "请验证"), ("t", "x"), (None, None)], "title string, html string"
    )
    assert [r.blocked for r in X.flag_blocked_pages(pages, SITE).collect()] == [True, True, False, False]


def test_detail_wins_even_when_empty(spark):
    items = spark.createDataFrame(
        [("a", "list a", 9, "l1"), ("b", "list b", 8, "l2")],
        "article_id string, title string, likes int, link string",
    )
    details = spark.createDataFrame(
        [("l1", "", None, 0, True)], "url string, title string, author string, likes int, is_column boolean"
    )
    rows = {r.article_id: (r.title, r.likes, r.is_column) for r in X.merge_list_detail(items, details).collect()}
    assert rows == {"a": ("", 0, True), "b": ("list b", 8, None)}


def test_heuristic_order(spark):
    items = spark.createDataFrame(
        [
            (1, "123456", "原文", ""),
            (2, "12345", "原文", "c" * 201),
            (3, None, None, "c" * 201),
            (4, "", "", "c" * 200),
            (5, None, None, None),
        ],
        "i int, title string, source string, content string",
    )
    assert sorted(r.i for r in X.list_item_heuristic(items, SITE).collect()) == [1, 3]


WORKER_WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, sys.argv[1])
from inkfold.functions.html_select import with_element_texts
from inkfold.session import build_session
spark = build_session("workers", "local[1]")
pages = spark.createDataFrame([("<p>a</p>",)], "html string")
assert with_element_texts(pages, "html", {"p": "p"}).first().p == "a"
"""


def test_workers_need_not_have_the_package(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", WORKER_WITHOUT_PACKAGE, root], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_links_of_the_right_attribute(spark):
    from pyspark.sql import functions as F

    from inkfold.functions.extract import article_links
    from inkfold.params import SiteParams

    site = SiteParams(base_url="https://s.example", article_url_pattern=r"/\d+/\d+")
    pages = [
        '<a data-href="/9/9" href="/1/2">x</a>',
        "<a href=/1/2>x</a>",
        "<a class='c' HREF = '/1/2?a=1&amp;b=2'>x</a>",
        '<a data-href="/9/9">x</a>',
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    found = [r.l for r in df.select(article_links(F.col("html"), site).alias("l")).collect()]
    assert found == [["https://s.example/1/2"], ["https://s.example/1/2"], ["https://s.example/1/2?a=1&b=2"], []]
