"""The chains end to end: collect, store, report, rerun."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from inkfold.operators import daily_report as H
from inkfold.operators import extraction as X
from inkfold.operators import investment_report as I
from inkfold.operators.incremental import upsert_index
from inkfold.params import CrawlParams, DailyReportParams, Params, SiteParams
from inkfold.plans import daily
from inkfold.session import materialize
from inkfold.sources import corpus, sinks, tables

SITE = SiteParams(title_marker="SITE")
PARAMS = Params(site=SITE, crawl=CrawlParams(articles_per_user=3), daily=DailyReportParams(limit=3))
ITEM = "<div class='timeline__item'><h3>list title {i}</h3><a href='/{u}/{i}'>x</a></div>"
PAGE = (
    "<title>{title} - SITE</title><div class='author-name'>Ann</div><div class='date'>day</div>"
    "<div class='article__bd__detail'><div>{text}</div></div>"
)


@pytest.fixture(scope="module")
def site_pages(spark):
    """Two authors' list pages and the detail pages behind them."""
    users = {"1": range(11, 17), "2": range(21, 23)}
    lists = spark.createDataFrame(
        [(u, {"1": "<title>Ann page</title>", "2": "<p class='username'>Bob</p>"}[u] + "".join(ITEM.format(u=u, i=i) for i in ids)) for u, ids in users.items()] + [("3", "<p>empty</p>")],
        "user_id string, html string",
    )
    pages = [
        (f"https://site.example/{u}/{i}",
         PAGE.format(title="回复@x: no" if i == 12 else f"Title {i}", text=("估值 " if i == 13 else "text ") * 150))
        for u, ids in users.items() for i in ids
    ]
    accounts = spark.createDataFrame(
        [("1", "a", "url", True), ("2", "b", "url", None), ("3", "c", "url", True), ("4", "d", "url", False)],
        "id string, name string, url string, enabled boolean",
    )
    return accounts, lists, spark.createDataFrame(pages, "url string, html string")


@pytest.fixture(scope="module")
def site(site_pages):
    accounts, lists, pages = site_pages
    return accounts, X.parse_list_items(lists, SITE), X.page_details(pages, SITE)


def test_collect_store_and_rerun(spark, site, tmp_path):
    accounts, items, details = site
    table, snaps, index_path = (str(tmp_path / x) for x in ("articles", "snapshots", "index"))
    index_schema = (
        "article_id string, user_id string, title string, author string, crawl_time timestamp, filepath string"
    )
    index = spark.createDataFrame([], index_schema)
    stored = spark.createDataFrame([], "user_id string, date date, article_count bigint, articles array<struct<article_id:string,title:string,crawl_time:timestamp>>")
    # Item 12 is a reply. It is never stored, so no snapshot knows it, and it takes up one of
    # its author's three slots in every run.
    expected = [{"11", "13", "21", "22"}, {"14", "15"}, {"16"}, set()]
    for run_id, want in enumerate(expected, 1):
        day = F.lit(dt.date(2024, 1, run_id))
        at = F.timestamp_seconds(1704067200 + 86400 * (run_id - 1) + F.col("pos"))
        run = daily.collect(accounts, items, details, stored, index, PARAMS, crawl_time=at)
        kept = materialize(run.batch.withColumnRenamed("content", "body"))
        assert {r.article_id for r in kept.collect()} == want
        assert sum(r.kept for r in run.counts.collect()) == len(want)
        sinks.write_articles(kept, table, run_id)
        sinks.write_snapshots(daily.run_snapshots(accounts, kept, day, PARAMS), snaps, run_id)
        rows = upsert_index(index, kept.select(*index.columns), ["crawl_time"])
        sinks.write_index_rows(rows.join(index, "article_id", "left_anti"), index_path, run_id)
        index = spark.read.parquet(index_path).drop("batch_id")
        stored = tables.scan_snapshots(spark, snaps)
        heads = {(r.user_id, r.article_count) for r in stored.filter(F.col("date") == day).collect()}
        # Account 3 has an empty snapshot, the disabled one has none.
        assert ("3", 0) in heads and len(heads) <= 3 and not any(u == "4" for u, _ in heads)
    documents = corpus.scan_articles(spark, table)
    assert documents.count() == 7
    first = documents.filter("article_id = '11'").first()
    assert (first.title, first.author, first.publish_time) == ("Title 11", "Ann", "day")


def test_runs_from_pages_to_state_and_a_report(spark, site_pages, tmp_path):
    """Nothing is added by hand: pages in, state on disk, the day's report from what is stored."""
    accounts, lists, pages = site_pages
    store = daily.Store(*(str(tmp_path / x) for x in ("articles", "index", "snapshots", "documents")))
    expected = [{"11", "13", "21", "22"}, {"14", "15"}, {"16"}, set()]
    for run_id, want in enumerate(expected, 1):
        at = F.lit(f"2024-01-0{run_id} 09:00:00").cast("timestamp")
        for _ in range(2 if run_id == 2 else 1):  # the second run happens twice
            counts = daily.collect_run(accounts, lists, pages, store, run_id, at, PARAMS)
            assert sum(r.kept for r in counts.collect()) == len(want)
    index = tables.scan_index_table(spark, store.index)
    assert {r.article_id: r.filepath for r in index.collect()} == {
        a: f"data/{a[0]}/{a}.md" for day in expected for a in day
    }
    snapshots = tables.scan_snapshots(spark, store.snapshots)
    assert snapshots.filter("user_id = '3'").count() == 4  # empty ones, but one each
    documents = corpus.scan_packed_corpus(spark, store.documents)
    assert documents.filter("well_formed").count() == 7
    table = corpus.scan_articles(spark, store.articles)
    report = daily.daily_report(
        index, table.select("user_id", "article_id", "crawl_date", F.col("body").alias("content")), None, "now",
        PARAMS, day=dt.date(2024, 1, 2),
    )
    (row,) = H.render_report(report).collect()
    assert str(row.date) == "2024-01-02" and "- **今日新增**：2 篇" in row.report
    assert "Title 14" in row.report and "Title 11" not in row.report
    named = daily.named_accounts(accounts.withColumn("name", F.col("id")), lists, Params(site=SiteParams(name_suffix=" page")))
    assert {r.id: r.name for r in named.collect()} == {"1": "Ann", "2": "Bob", "3": "3", "4": "4"}


def documents_and_index(spark, n=5):
    rows = spark.createDataFrame(
        [(str(i), "u", f"Title {i}", "au", ("估值 " if i % 2 else "x ") * (30 if i == 0 else 300), 60 * i) for i in range(n)],
        "article_id string, user_id string, title string, author string, content string, s int",
    ).withColumn("crawl_time", F.timestamp_seconds(1704067200 + F.col("s")))
    return rows.drop("content"), rows.select("article_id", "content")


def test_daily_report_without_a_model(spark):
    index, documents = documents_and_index(spark)
    (row,) = H.render_report(
        daily.daily_report(index, documents.filter("article_id <> '1'"), None, "now", PARAMS)
    ).collect()
    text = row.report
    assert "- **今日新增**：3 篇" in text and "- **无效文章**：1 篇" in text
    # Article 1 has no document; 0, 2 and 3 are the first three that have one.
    assert "u/1)" not in text and "u/4" not in text
    assert "1. [Title 0](https://site.example/u/0)（au）\n   - ⚠️ 内容过短(60字)" in text
    assert "#### 1. Title 3" in text and "- **主题归类**：公司研究" in text
    assert "- **热门股票**：无" in text


def test_daily_report_with_responses(spark):
    index, documents = documents_and_index(spark)
    responses = spark.createDataFrame(
        [("1", json.dumps({"category": "c", "related_stocks": ["S1", "S2"]}), None), ("2", None, "timeout")],
        "article_id string, response string, error string",
    )
    (row,) = H.render_report(daily.daily_report(index, documents, responses, "now", PARAMS)).collect()
    assert "- **相关股票**：S1, S2" in row.report and "| S1 | 1 | [Title 1](https://site.example/u/1) |" in row.report
    assert "2. [Title 2](https://site.example/u/2)（au）" in row.report


def test_investment_report(spark):
    index, documents = documents_and_index(spark, 25)
    articles = (
        index.join(documents, "article_id")
        .withColumn("date", F.to_date("crawl_time"))
        .withColumn("url", F.lit(None).cast("string"))
        .withColumn("link", F.concat(F.lit("l"), "article_id"))
    )
    (rules,) = I.render_investment_report(daily.investment_report(articles, None, "now")).collect()
    assert "共爬取 **25** 篇新文章。" in rules.report and "25. [Title 24](l24)" in rules.report
    assert "### 需要关注\n- Title 0\n" in rules.report and "- ... 还有 20 条" in rules.report
    responses = spark.createDataFrame(
        [("0", '{"importance": "high", "core_thesis": "big", "related_stocks": ["X"]}', None)],
        "article_id string, response string, error string",
    )
    (answered,) = I.render_investment_report(daily.investment_report(articles, responses, "now")).collect()
    assert "**核心论点：** big" in answered.report and "$**X**" in answered.report
