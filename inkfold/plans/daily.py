"""Day-to-day chains: collect, daily report, investment report."""

from __future__ import annotations

import datetime as dt

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.html_select import with_element_texts
from inkfold.functions.text import text
from inkfold.operators.classification import analyze_rules, analyze_rules_v2
from inkfold.operators.daily_report import report_blocks
from inkfold.operators.extraction import derive_user_name, page_details, page_title_of, parse_list_items
from inkfold.operators.filters import filter_crawl_date
from inkfold.operators.incremental import (
    Collected,
    account_name_merge,
    enabled_accounts,
    incremental_run,
    report_batch,
    snapshot_rollup,
)
from inkfold.operators.investment_report import investment_blocks
from inkfold.operators.responses import attach_responses_v1, attach_responses_v2
from inkfold.params import Params
from inkfold.schemas import INDEX_ROWS
from inkfold.session import stored
from inkfold.sources.sinks import write_articles, write_index_rows, write_markdown, write_snapshots
from inkfold.sources.tables import scan_index_table, scan_snapshots


def collect(
    accounts: DataFrame,
    items: DataFrame,
    details: DataFrame,
    snapshots: DataFrame,
    index: DataFrame,
    params: Params = Params(),
    crawl_time: Column | None = None,
) -> Collected:
    """Articles to store from one run's listings, and its counts.

    ``accounts`` come in order of ``account_order``, or, without that column, of their ids.
    """
    enabled = enabled_accounts(accounts)
    order = F.col("account_order") if "account_order" in accounts.columns else F.col("id")
    listed = items.join(
        enabled.select(F.col("id").alias("user_id"), order.alias("account_order")), "user_id"
    )
    return incremental_run(
        listed, details, snapshots, index, params.site, params.crawl, crawl_time=crawl_time
    )


class Store(NamedTuple):
    """Folders of the stored state; ``documents`` only where texts are wanted, too."""

    articles: str
    index: str
    snapshots: str
    documents: str | None = None


def named_accounts(accounts: DataFrame, list_pages: DataFrame, params: Params = Params()) -> DataFrame:
    """``accounts`` with the names that their pages show, where they have none yet."""
    site = params.site
    titled = list_pages.select("user_id", "html", page_title_of().alias("_title"))
    pages = with_element_texts(titled, "html", {"_name": site.name_selector})
    found = derive_user_name(pages, site, "_name", "_title", "user_id").groupBy("user_id").agg(
        F.min("user_name").alias("user_name")
    )
    return account_name_merge(accounts, found, site)


def collect_run(
    accounts: DataFrame,
    list_pages: DataFrame,
    pages: DataFrame,
    store: Store,
    run_id: int,
    crawl_time: Column,
    params: Params = Params(),
) -> DataFrame:
    """One run from stored pages to stored state; returns the counts per user.

    ``list_pages`` has the accounts' own pages (``user_id, html``), ``pages`` the articles'
    (``url, html``). Articles, index rows and snapshots are appended under ``run_id``, the
    index last. State is read as it was before this run, and each writer replaces what the
    same run wrote: a run that failed half way is simply run again.
    """
    spark = accounts.sparkSession
    run = collect(
        accounts,
        parse_list_items(list_pages, params.site),
        page_details(pages, params.site),
        scan_snapshots(spark, store.snapshots, run_id),
        scan_index_table(spark, store.index, run_id),
        params,
        crawl_time,
    )
    batch = stored(run.batch.withColumnRenamed("content", "body"), "collected")
    write_articles(batch, store.articles, run_id)
    if store.documents:
        write_markdown(batch, store.documents, run_id)
    write_snapshots(run_snapshots(accounts, batch, F.to_date(crawl_time), params), store.snapshots, run_id)
    write_index_rows(batch.select(INDEX_ROWS.names), store.index, run_id)
    return run.counts


def run_snapshots(accounts: DataFrame, kept: DataFrame, day: Column, params: Params = Params()) -> DataFrame:
    """The snapshot records of one run, one at least per account."""
    runs = enabled_accounts(accounts).select(F.col("id").alias("user_id"), day.alias("date"))
    rows = kept.withColumn("date", day).withColumn("ord", F.col("pos"))
    return snapshot_rollup(runs, rows, params.crawl)


def daily_batch(
    articles: DataFrame, responses: DataFrame | None, params: Params = Params()
) -> DataFrame:
    """Articles with their results, ready for the report's tables."""
    if responses is not None:
        return attach_responses_v1(
            articles, responses, params.gate, params.priority, params.responses
        )
    counted = articles.withColumn("word_count", F.length(text("content")).cast("bigint"))
    return analyze_rules(counted, params.gate, params.priority, params.category).drop("content")


def daily_report(
    index: DataFrame,
    documents: DataFrame,
    responses: DataFrame | None,
    generated_at: Column | str,
    params: Params = Params(),
    day: dt.date | None = None,
) -> DataFrame:
    """The report of each day over the day's first articles, as ordered block rows.

    With ``day``, of that day alone: nothing else is read of the index, nor of documents
    that are partitioned by day. ``render_report`` makes texts of the rows, ``report_text``
    what the text sink takes.
    """
    if day is not None:
        index = filter_crawl_date(index, day)
    chosen = report_batch(index, documents, params.daily.limit)
    batch = daily_batch(chosen, responses, params)
    return report_blocks(batch, generated_at, params.site, params.daily)


def investment_report(
    articles: DataFrame,
    responses: DataFrame | None,
    generated_at: Column | str,
    params: Params = Params(),
) -> DataFrame:
    """The investment report of each day over all of the day's articles, as ordered block rows."""
    if responses is None:
        batch = analyze_rules_v2(articles, params.entity).drop("content")
    else:
        batch = attach_responses_v2(articles, responses, params.entity)
    return investment_blocks(batch, generated_at, params.investment)
