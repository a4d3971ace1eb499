"""What the plans have to look like to hold up on large tables."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from inkfold.catalog.registry import QUERIES
from inkfold import session
from inkfold.operators import daily_report as H
from inkfold.operators import filters as C
from inkfold.operators import incremental as D
from inkfold.operators.quality import quality_gate_report, quality_log_daily
from inkfold.sources import corpus, sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """An article table and an index on disk."""
    path = str(tmp_path_factory.mktemp("stored"))
    rows = spark.range(200).select(
        (F.col("id") % 5).cast("string").alias("user_id"),
        F.col("id").cast("string").alias("article_id"),
        F.lit("title").alias("title"), F.lit("a").alias("author"), F.lit("p").alias("publish_time"),
        F.lit(0).alias("likes"), F.lit(0).alias("comments"), F.lit("u").alias("url"),
        F.repeat(F.lit("text "), 300).alias("body"),
        F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("crawl_time"),
    )
    sinks.write_articles(rows, path, 1)
    return path


def test_day_filter_prunes_partitions_and_reaches_the_scan(spark, stored):
    rows = spark.read.schema(corpus.STORED).parquet(stored)
    text = plan(C.filter_crawl_date(rows, dt.date(2024, 1, 2), partition_column="crawl_date").select("article_id"))
    assert "PartitionFilters: [isnotnull(crawl_date" in text
    assert "GreaterThanOrEqual(crawl_time" in text and "LessThan(crawl_time" in text
    assert "body" not in text


def test_report_limit_ranks_keys_only(spark, stored):
    rows = spark.read.schema(corpus.STORED).parquet(stored).withColumn("date", F.col("crawl_date"))
    # The partial limit sits in front of the exchange.
    ranked = plan(D.limit_keys(rows, 20))
    assert "row_number(), 20, Partial" in ranked and "body" not in ranked
    # Of the stored keys the optimizer sees that they are few; text stays where it is.
    picked = D.report_limit(rows.select("user_id", "article_id", "date", "crawl_time", "body"), 20)
    picked.collect()
    text = plan(picked)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert picked.count() == 20 * rows.select("date").distinct().count() - 20 * 1 + 8


@pytest.mark.parametrize("limit", [None, 20])
def test_days_of_the_index_prune_the_documents(spark, stored, limit):
    """The day is filtered on the index alone; the documents' partitions follow at run time."""
    rows = spark.read.schema(corpus.STORED).parquet(stored)
    index = C.filter_crawl_date(rows.select("user_id", "article_id", "crawl_time"), dt.date(2024, 1, 2))
    for documents in (rows, corpus.scan_articles(spark, stored)):
        documents = documents.withColumnRenamed("body", "content")
        joined = (
            D.today_articles_join(index, documents) if limit is None else D.report_batch(index, documents, limit)
        )
        text = plan(joined)
        scan = [x for x in text.splitlines() if "FileScan" in x and "body" in x]
        assert scan and all("dynamicpruningexpression(crawl_date" in x for x in scan), text
        assert joined.count() == (24 if limit is None else limit)


def test_a_collect_run_has_six_exchanges_and_moves_no_text_before_its_filters(spark, monkeypatch):
    items = spark.range(300).select(
        (F.col("id") % 5).cast("string").alias("user_id"), F.col("id").cast("string").alias("article_id"),
        F.concat(F.lit("l"), "id").alias("link"), F.col("id").alias("pos"), F.lit(1).alias("account_order"),
    )
    details = items.select(
        F.col("link").alias("url"), F.lit("t").alias("title"), F.repeat(F.lit("text "), 50).alias("content"),
        F.lit(True).alias("is_column"),
    )
    none = spark.createDataFrame([], "user_id string, date date, articles array<struct<article_id:string>>")
    index = items.select("article_id").limit(0)
    plans = []

    def seen(df, purpose):
        plans.append(plan(df))
        return session.stored(df, purpose)

    monkeypatch.setattr(D, "stored", seen)
    batch = D.incremental_batch(items, details, none, index)
    assert batch.count() == 100
    exchanges = [x for p in [*plans, plan(batch)] for x in p.splitlines() if " Exchange " in x]
    assert len(exchanges) <= 6 + 2  # the two that a broadcast replaces once sizes are known
    assert not any("content" in x for p in plans for x in p.splitlines() if " Exchange " in x)


def test_cap_and_dedup_limit_before_the_shuffle(spark):
    items = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("user_id"), F.col("id").cast("string").alias("article_id"),
        F.col("id").alias("pos"),
    )
    assert "row_number(), 20, Partial" in plan(D.crawl_cap_per_user(items, 20))
    index = spark.createDataFrame([("x",)], "article_id string")
    assert "row_number(), 1, Partial" in plan(D.index_dedup(items, index, ["pos"]))


def test_known_ids_are_an_anti_join(spark):
    items = spark.createDataFrame([("u", "a")], "user_id string, article_id string")
    assert "LeftAnti" in plan(D.new_articles_antijoin(items, items))


def test_counts_combine_before_the_shuffle_without_text(spark, stored):
    rows = spark.read.schema(corpus.STORED).parquet(stored).withColumnRenamed("body", "content")
    gated = quality_gate_report(rows.withColumn("date", F.col("crawl_date")))
    text = plan(quality_log_daily(gated))
    assert "partial_count" in text
    exchange = next(x for x in text.splitlines() if "Exchange" in x)
    assert "content" not in exchange and "body" not in exchange


def test_numbering_has_no_window_over_articles(spark):
    rows = spark.range(50).select(
        F.lit("2024-01-01").cast("date").alias("date"), F.lit("must_read").alias("priority"),
        F.col("id").cast("string").alias("article_id"), F.current_timestamp().alias("crawl_time"),
    )
    text = plan(H.article_sections(rows))
    assert "row_number" not in text
    assert "SortAggregate" in text or "HashAggregate" in text


def test_entities_are_extracted_once_per_pass(spark):
    rows = spark.createDataFrame([("2024-01-01", "1", "u", "t", "now", "x Abcde")], "date string, article_id string, user_id string, title string, crawl_time string, text string")
    made = rows.withColumn(
        "analysis", F.struct(F.regexp_extract_all("text", F.lit("([A-Z][a-z]+)"), 1).alias("related_stocks"))
    )
    assert plan(H.entity_rows(made)).count("regexp_extract_all") == 1


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize(
    "name", [n for n in QUERIES if not n.startswith(("stream_", "sink_", "scan_", "render_", "report_lines"))]
)
def test_no_cross_join_and_no_single_task_window(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # A window without a partition would pull the whole table into one task.
    if "Window [" in text or "WindowGroupLimit" in text:
        assert "Exchange SinglePartition\n" not in text.split("Subquery")[0]


def test_a_hot_run_is_dealt_by_chunk(spark):
    """One (user, date) with most of the rows is gathered by several tasks."""
    from inkfold.operators.incremental import snapshot_rollup

    kept = spark.range(20_000).select(
        F.lit("u").alias("user_id"),
        F.lit("2024-01-01").cast("date").alias("date"),
        F.col("id").alias("ord"),
        F.col("id").cast("string").alias("article_id"),
        F.lit("t").alias("title"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("crawl_time"),
    )
    runs = kept.select("user_id", "date").distinct()
    rolled = snapshot_rollup(runs, kept, chunk=1000)
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert rolled.count() == 20


def test_entries_are_cut_before_anything_moves(spark, stored):
    """Detail and brief lines: what an entry does not show is gone before the first exchange."""
    rows = spark.read.schema(corpus.STORED).parquet(stored)
    points = F.split("body", " ")
    batch = rows.select(
        F.col("crawl_date").alias("date"), "article_id", "user_id", "title", "author", "crawl_time",
        F.length("body").cast("bigint").alias("word_count"), F.lit(True).alias("quality_passed"),
        F.array().cast("array<string>").alias("issues"),
        F.when(F.length("body") > 10, "must_read").otherwise("reference").alias("priority"),
        F.struct(
            F.lit("c").alias("category"), F.array(F.lit("S")).alias("related_stocks"), points.alias("core_points"),
            F.lit(None).cast("struct<alignment:string,margin_of_safety:string,analysis:string>").alias("value_investment"),
            F.array().cast("array<string>").alias("insights"), F.lit("s").alias("summary"),
        ).alias("analysis"),
    )
    for made in (H.article_detail_rows(batch), H.article_brief_rows(batch)):
        moved = [x for x in plan(made).splitlines() if "Exchange" in x or "Sort [" in x]
        assert moved and not any("body" in x or "analysis" in x for x in moved)
    lines = H.article_detail_rows(batch).filter("line_no = 15").collect()
    assert len(lines) == 200 and all(len(r.line) < 20 for r in lines)
