"""What is new against stored state: snapshots, the article index, accounts.

State tables are read narrow (keys and order only); article text joins in last.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.functions.ranking import first_k
from inkfold.functions.text import cut, text
from inkfold.operators.filters import filter_column_articles
from inkfold.params import CrawlParams, SiteParams
from inkfold.session import stored

# A snapshot record holds about this many entries; larger ones are split into chunks.
SNAPSHOT_CHUNK = 1000


def explode_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per entry; an empty snapshot keeps one row with NULL entry fields."""
    return snapshots.select(
        "user_id", "date", "article_count", F.explode_outer("articles").alias("a")
    ).select("user_id", "date", "article_count", "a.article_id", "a.title", "a.crawl_time")


def enabled_accounts(accounts: DataFrame) -> DataFrame:
    """Enabled accounts that have an id and a url; a missing flag means enabled."""
    return accounts.filter(
        F.coalesce(F.col("enabled"), F.lit(True)) & (text("id") != "") & (text("url") != "")
    )


def newest_snapshots(
    snapshots: DataFrame, k: int = CrawlParams().snapshot_files, since: dt.date | None = None
) -> DataFrame:
    """The records of each user's ``k`` newest snapshots, still nested.

    Users and dates alone decide: of a user with any number of snapshots a task sends ``k``
    rows on, and the records of the others go before their entries are unfolded. ``since``
    is for tables partitioned by date: earlier days are neither listed nor read, and a user
    with fewer than ``k`` snapshots since then has just those.
    """
    if since is not None:
        snapshots = snapshots.filter(F.col("date") >= F.lit(since))
    newest = Window.partitionBy("user_id").orderBy(F.col("date").desc())
    recent = (
        snapshots.select("user_id", "date")
        .withColumn("_rank", F.dense_rank().over(newest))
        .filter(F.col("_rank") <= k)
        .select("user_id", "date")
    )
    return snapshots.join(recent, ["user_id", "date"], "left_semi")


def _recent_entries(snapshots: DataFrame, k: int, since: dt.date | None) -> DataFrame:
    """(user_id, article_id) of the entries of the newest snapshots, repeats kept."""
    return newest_snapshots(snapshots, k, since).select(
        "user_id", F.explode("articles.article_id").alias("article_id")
    )


def recent_snapshot_ids(
    snapshots: DataFrame, k: int = CrawlParams().snapshot_files, since: dt.date | None = None
) -> DataFrame:
    """Distinct ids in each user's ``k`` newest snapshots.

    ``snapshots`` has nested records: ``user_id, date, articles``, one or more per (user,
    date), and one without entries where a run found nothing: it counts among the ``k``,
    too. It is ``k`` snapshots, not ``k`` days.
    """
    return _recent_entries(snapshots, k, since).distinct()


def new_articles_antijoin(items: DataFrame, known: DataFrame) -> DataFrame:
    """Listed items with an id the user's recent snapshots do not hold.

    Repeats among the known ids combine before the shuffle the join needs anyway.
    """
    return items.filter(text("article_id") != "").join(
        known.select("user_id", "article_id").distinct(), ["user_id", "article_id"], "left_anti"
    )


def crawl_cap_per_user(
    new_items: DataFrame, n: int = CrawlParams().articles_per_user, order: str = "pos"
) -> DataFrame:
    """The first ``n`` new items of each user in list order, at one place by id."""
    return first_k(new_items, ["user_id"], [order, "article_id"], n, "slot").drop("slot")


def index_dedup(batch: DataFrame, index: DataFrame, order: list[str]) -> DataFrame:
    """Drop ids the index holds, and all but the first of an id inside the batch.

    Copies go first: that happens inside the map tasks, so an id with very many copies
    does not reach the join, and the join reuses the partitioning by id.
    """
    single = first_k(batch, ["article_id"], order, 1, "_copy").drop("_copy")
    return single.join(index.select("article_id"), "article_id", "left_anti")


def upsert_index(index: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """The index with the unseen rows added. Rows already there never change."""
    return index.unionByName(index_dedup(rows, index, order).select(*index.columns))


def concat_user_batches(*batches: DataFrame) -> DataFrame:
    """Append batches; nothing is deduplicated."""
    return reduce(lambda a, b: a.unionByName(b), batches)


class Collected(NamedTuple):
    """What one run finds: the articles to store, and per user listed/new/capped/kept."""

    batch: DataFrame
    counts: DataFrame


def incremental_run(
    items: DataFrame,
    details: DataFrame,
    snapshots: DataFrame,
    index: DataFrame,
    site: SiteParams = SiteParams(),
    crawl: CrawlParams = CrawlParams(),
    batch_order: tuple[str, ...] = ("account_order", "pos"),
    detail_order: str | None = None,
    crawl_time: Column | None = None,
    since: dt.date | None = None,
    root: str = "data",
) -> Collected:
    """One run over the listings: known ids out, cap, detail overlay, type filter, index dedup.

    Order matters: an item dropped after the cap is not replaced by a later one. Of several
    details of one url the one with the largest ``detail_order`` (a column such as the fetch
    time) counts, then the one with the largest hash of its content. The batch has the
    article's ``crawl_time``, that of the detail unless one is given, and the ``filepath``
    under which its document is stored.

    Items and known ids meet as one table, and so do candidates and index rows: one exchange
    by key each, with flags for what a row is. Of any number of copies of an item a task
    sends no more than the cap. What the cap leaves, a few rows per user, is stored narrow;
    batch and counts both read it, and only details of urls that passed everything give
    their text.
    """
    order = [c for c in batch_order if c in items.columns]
    listed = items.select("user_id", "article_id", "link", *order, F.lit(False).alias("_known"))
    known = _recent_entries(snapshots, crawl.snapshot_files, since).withColumn("_known", F.lit(True))
    tagged = listed.unionByName(known, allowMissingColumns=True)
    capped = stored(_capped(tagged, crawl.articles_per_user), "capped")
    kept = stored(_kept(capped, details, index, site, order, detail_order), "kept")
    return Collected(
        _with_text(kept, details, detail_order, crawl_time, root),
        _counts(tagged, capped, kept, crawl.articles_per_user),
    )


def incremental_batch(*args, **options) -> DataFrame:
    """The articles one run keeps; see ``incremental_run``."""
    return incremental_run(*args, **options).batch


def incremental_counts(*args, **options) -> DataFrame:
    """Per user: listed, new, capped and kept items; see ``incremental_run``."""
    return incremental_run(*args, **options).counts


def _capped(tagged: DataFrame, n: int) -> DataFrame:
    """The first ``n`` new items of each user."""
    pair = ["user_id", "article_id"]
    copies = Window.partitionBy(*pair).orderBy(F.col("_known").desc(), "pos", "link")
    # A known row comes first, so it is never cut off.
    few = (
        tagged.filter(text("article_id") != "")
        .withColumn("_copy", F.row_number().over(copies))
        .filter(F.col("_copy") <= n + 1)
    )
    new = few.withColumn("_any", F.max("_known").over(Window.partitionBy(*pair))).filter(
        ~F.col("_any")
    )
    return crawl_cap_per_user(new.drop("_copy", "_any", "_known"), n)


def _detail_rank(details: DataFrame, order: str | None) -> Column:
    """Which of several details of a url counts; equal rows have equal ranks."""
    return F.struct(
        *([F.col(order)] if order else []), F.xxhash64(*details.columns).alias("_hash")
    )


def one_detail(details: DataFrame, order: str | None = None) -> DataFrame:
    """``url``, the ``_rank`` of the detail that counts for it, its title and type."""
    return details.groupBy("url").agg(
        F.max(F.struct(_detail_rank(details, order).alias("_rank"), "title", "is_column")).alias("_best")
    ).select("url", "_best.*")


def _kept(
    capped: DataFrame, details: DataFrame, index: DataFrame, site: SiteParams,
    order: list[str], detail_order: str | None,
) -> DataFrame:
    """Keys of the articles to store, with the rank of their detail.

    Only an item with a detail row can be a column article, and a detail row replaces every
    list field; so the list's own text and counters never reach the result. Copies of an id
    go inside the map tasks, but for the first; an index row comes before any item.
    """
    listed = details.join(capped.select(F.col("link").alias("url")), "url", "left_semi")
    best = one_detail(listed, detail_order).withColumnRenamed("url", "link")
    typed = filter_column_articles(capped.join(best, "link"), site).select(
        "user_id", "article_id", "link", *order, "_rank", F.lit(False).alias("_stored")
    )
    ids = index.select("article_id", F.lit(True).alias("_stored"))
    both = typed.unionByName(ids, allowMissingColumns=True).withColumn("_first", ~F.col("_stored"))
    single = first_k(both, ["article_id"], ["_first", *order, "link"], 1, "_copy")
    return single.filter(~F.col("_stored")).drop("_copy", "_stored", "_first")


def _with_text(
    kept: DataFrame, details: DataFrame, detail_order: str | None, crawl_time: Column | None, root: str
) -> DataFrame:
    taken = kept.columns
    fields = [c for c in details.columns if c not in taken and c != "crawl_time"]
    when = crawl_time if crawl_time is not None else (
        F.col("crawl_time") if "crawl_time" in details.columns else F.lit(None).cast("timestamp")
    )
    file = F.concat(F.col("article_id"), F.lit(".md"))
    ranked = details.withColumn("_d_rank", _detail_rank(details, detail_order))
    same = (F.col("link") == F.col("url")) & F.col("_rank").eqNullSafe(F.col("_d_rank"))
    return (
        ranked.join(kept, same)
        .select(
            *[c for c in taken if c != "_rank"],
            *fields,
            when.alias("crawl_time"),
            F.concat_ws("/", F.lit(root), F.col("user_id"), file).alias("filepath"),
        )
        # Details that are equal in all columns are still several rows; few articles are left.
        .dropDuplicates(["article_id"])
    )


def _counts(tagged: DataFrame, capped: DataFrame, kept: DataFrame, n: int) -> DataFrame:
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    pairs = tagged.groupBy("user_id", "article_id").agg(
        F.count_if(~F.col("_known")).alias("listed"), F.max("_known").alias("_any")
    )
    is_new = ~F.col("_any") & (text("article_id") != "")
    names = ["listed", "new", "kept"]
    rows = pairs.select(
        "user_id", "listed", F.when(is_new, F.col("listed")).otherwise(zero).alias("new"), zero.alias("kept")
    ).unionByName(
        kept.select("user_id", zero.alias("listed"), zero.alias("new"), one.alias("kept"))
    )
    return (
        rows.groupBy("user_id")
        .agg(*[F.sum(c).alias(c) for c in names])
        .filter(F.col("listed") > 0)
        .select("user_id", "listed", "new", F.least("new", F.lit(n).cast("bigint")).alias("capped"), "kept")
    )


def snapshot_rollup(
    runs: DataFrame,
    kept: DataFrame,
    crawl: CrawlParams = CrawlParams(),
    chunk: int = SNAPSHOT_CHUNK,
) -> DataFrame:
    """One nested record per (user, date) run; a run that kept nothing has an empty one.

    ``runs`` has distinct (user_id, date); ``kept`` the articles with ``date`` and an
    ``ord`` column for their order. A run within the crawl cap makes one record. A
    larger one is split by id hash into chunks of about ``chunk`` entries, each a
    record with the run's whole ``article_count``, so no record grows without bound.
    """
    counts = kept.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("article_count"))
    entry = F.struct(
        "ord",
        F.col("article_id"),
        cut(text("title"), crawl.snapshot_title_chars).alias("title"),
        F.col("crawl_time"),
    )
    chunks = F.ceil(F.col("article_count") / F.lit(chunk)).cast("int")
    records = (
        kept.join(counts, ["user_id", "date"])
        .withColumn("chunk", F.pmod(F.hash("article_id"), chunks))
        # The join leaves a run's rows in one partition, and the grouping would keep them there.
        .repartition("user_id", "date", "chunk")
        .groupBy("user_id", "date", "article_count", "chunk")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    )
    return runs.join(records, ["user_id", "date"], "left").select(
        "user_id",
        "date",
        F.coalesce("chunk", F.lit(0)).alias("chunk"),
        F.coalesce("article_count", F.lit(0).cast("bigint")).alias("article_count"),
        F.coalesce(
            F.transform(
                "_entries",
                lambda e: F.struct(
                    e["article_id"].alias("article_id"),
                    e["title"].alias("title"),
                    e["crawl_time"].alias("crawl_time"),
                ),
            ),
            F.array().cast("array<struct<article_id:string,title:string,crawl_time:timestamp>>"),
        ).alias("articles"),
    )


def account_name_merge(
    accounts: DataFrame, names: DataFrame, site: SiteParams = SiteParams()
) -> DataFrame:
    """Fill in found names where the account has only a placeholder or its id as name."""
    found = names.select(F.col("user_id").alias("_uid"), F.col("user_name").alias("_new"))
    joined = accounts.join(found, F.col("id") == F.col("_uid"), "left")
    unnamed = F.col("name").isin(site.placeholder_name) | (F.col("name") == F.col("id"))
    usable = (text("_new") != "") & (F.col("_new") != F.col("id"))
    return joined.select(
        *[c for c in accounts.columns if c != "name"],
        F.when(unnamed & usable, F.col("_new")).otherwise(F.col("name")).alias("name"),
    ).select(*accounts.columns)


def _document_key(index: DataFrame, documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """``index`` with the columns that tell its documents apart, and their names.

    Two authors may use one id, so the author is part of the key where both tables have it.
    Where the documents are partitioned by the day they were collected, so is that day: a
    filter on the index then prunes their partitions at run time.
    """
    keys = ["article_id"]
    if "user_id" in index.columns and "user_id" in documents.columns:
        keys.append("user_id")
    if "crawl_date" in documents.columns:
        index = index.withColumn("crawl_date", F.to_date("crawl_time"))
        keys.append("crawl_date")
    return index, keys


def today_articles_join(index: DataFrame, documents: DataFrame) -> DataFrame:
    """Index rows with their documents' text; a row without a document is dropped.

    ``index`` should already be filtered to the day(s) wanted.
    """
    columns = index.columns
    index, keys = _document_key(index, documents)
    return index.join(documents.select(*keys, "content"), keys).select(*columns, "content")


def limit_keys(
    rows: DataFrame, limit: int, day: str = "date", order: tuple[str, ...] = ("crawl_time", "article_id")
) -> DataFrame:
    """Keys of the first ``limit`` articles of each day, numbered as ``batch_no``."""
    keys = list(dict.fromkeys([*(c for c in ("user_id",) if c in rows.columns), *order, "article_id"]))
    return first_k(rows.select(day, *keys), [day], list(order), limit, "batch_no")


def report_limit(
    rows: DataFrame, limit: int, day: str = "date", order: tuple[str, ...] = ("crawl_time", "article_id")
) -> DataFrame:
    """The first ``limit`` articles of each day in the order they were collected.

    The ranking sorts keys only. The chosen keys are stored and then pick the rows, so where
    they are few, text is neither sorted nor shuffled; the optimizer sees how many they are.
    """
    chosen = stored(limit_keys(rows, limit, day, order), "limited")
    same = F.col("article_id") == F.col("_article_id")
    if "user_id" in rows.columns:
        same &= F.col("user_id").eqNullSafe(F.col("_user_id"))
    keys = [c for c in ("user_id", "article_id") if c in rows.columns]
    few = chosen.select(*[F.col(c).alias(f"_{c}") for c in keys], "batch_no")
    return rows.join(few, same).drop(*[f"_{c}" for c in keys])


def report_batch(index: DataFrame, documents: DataFrame, limit: int) -> DataFrame:
    """The articles of each day's report: index rows that have a document, first ``limit``.

    The limit is taken on index columns and stored; only the articles that remain fetch
    their text, and the documents' partitions of other days are not read.
    """
    columns = [*index.columns, "date", "batch_no"]
    keyed, keys = _document_key(index.withColumn("date", F.to_date("crawl_time")), documents)
    present = keyed.join(documents.select(*keys), keys, "left_semi")
    chosen = stored(
        first_k(present, ["date"], ["crawl_time", "article_id"], limit, "batch_no"), "report"
    )
    # The filter changes nothing; it tells the optimizer that these rows are a selection.
    few = chosen.filter(F.col("batch_no") <= limit)
    return few.join(documents.select(*keys, "content"), keys).select(*columns, "content")


def analysis_join(articles: DataFrame, results: DataFrame) -> DataFrame:
    """Pair each article with its result."""
    return articles.join(results, "article_id")
