"""The article corpus: one Markdown document per article, or the same as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from inkfold import schemas
from inkfold.functions.text import text
from inkfold.sources.packed import scan_packed
from inkfold.sources.tables import child_names

# --- fixed values: the document layout ---
TITLE_START = "# "
AUTHOR_START, TIME_START = "> 作者：", " | 发布时间："
LIKES_START, COMMENTS_START = "> 点赞：", " | 评论："
URL_START = "> 原文链接："
RULE_LINE = "---"
CRAWL_START, CRAWL_END = "*爬取时间：", "*"
CRAWL_FORMAT = "yyyy-MM-dd HH:mm:ss"
NO_TITLE = "无标题"
UNKNOWN = "未知"

USER_FOLDERS = "[0-9]*/*.md"
_HEADER_LINES = 8


def _between(line: Column, start: str, end: str | None = None) -> Column:
    """What follows ``start`` in a line, up to the first ``end`` after it."""
    rest = F.substring(line, F.lit(len(start) + 1), F.length(line))
    return F.substring_index(rest, end, 1) if end else rest


def parse_documents(documents: DataFrame, raw: str = "raw", path: str = "path") -> DataFrame:
    """Header, body and tail of each document as columns.

    The layout is fixed line by line, so one split finds the header and lengths find
    the tail; no pattern runs over the body. ``well_formed`` tells whether the layout
    holds; where it does not, the fields are NULL and the raw text remains.
    """
    tail_text = "\n\n" + RULE_LINE + "\n\n" + CRAWL_START
    stamp_chars = 19
    tail_chars = len(tail_text) + stamp_chars + len(CRAWL_END)
    line = F.split(F.col(raw), "\n", _HEADER_LINES + 1)

    def at(i: int) -> Column:
        return F.get(line, F.lit(i))

    rest = F.col("_rest")
    keep = F.length(rest) - tail_chars
    author_part = F.substring_index(_between(F.col("_l2"), AUTHOR_START), TIME_START, 1)
    time_part = F.substring_index(F.col("_l2"), TIME_START, -1)
    split_up = documents.withColumns(
        {
            "_l0": at(0),
            "_l2": at(2),
            "_l3": at(3),
            "_l4": at(4),
            "_l6": at(6),
            # Some writers end a file with a line break.
            "_rest": F.rtrim(at(_HEADER_LINES), F.lit("\n")),
        }
    )
    well_formed = F.coalesce(
        F.col("_l0").startswith(TITLE_START)
        & F.col("_l2").startswith(AUTHOR_START)
        & F.col("_l2").contains(TIME_START)
        & F.col("_l3").startswith(LIKES_START)
        & F.col("_l4").startswith(URL_START)
        & (F.col("_l6") == RULE_LINE)
        & (keep >= 0)
        & (F.substring(rest, keep + 1, F.lit(len(tail_text))) == tail_text),
        F.lit(False),
    )

    def field(c: Column) -> Column:
        return F.when(F.col("well_formed"), c)

    pieces = F.split(F.col(path), "/")
    crawl = F.substring(rest, keep + len(tail_text) + 1, F.lit(stamp_chars))
    return split_up.withColumn("well_formed", well_formed).select(
        F.try_element_at(pieces, F.lit(-2)).alias("user_id"),
        F.regexp_replace(F.try_element_at(pieces, F.lit(-1)), r"\.md$", "").alias("article_id"),
        field(_between(F.col("_l0"), TITLE_START)).alias("title"),
        field(author_part).alias("author"),
        field(time_part).alias("publish_time"),
        field(_between(F.col("_l3"), LIKES_START, COMMENTS_START).try_cast("int")).alias("likes"),
        field(F.substring_index(F.col("_l3"), COMMENTS_START, -1).try_cast("int")).alias("comments"),
        field(_between(F.col("_l4"), URL_START)).alias("url"),
        field(F.substring(rest, F.lit(1), keep)).alias("body"),
        field(F.try_to_timestamp(crawl, F.lit(CRAWL_FORMAT))).alias("crawl_time"),
        F.col(raw).alias("raw"),
        "well_formed",
    )


def scan_article_corpus(spark: SparkSession, root: str, glob: str = USER_FOLDERS) -> DataFrame:
    """Articles from ``<root>/<user_id>/<article_id>.md``, each file read whole.

    Small files are packed into common tasks by the scan. A corpus of many millions of
    files should be packed (``scan_packed_corpus``) or converted to the article table.
    """
    documents = (
        spark.read.text(f"{root}/{glob}", wholetext=True)
        .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("path"))
    )
    return parse_documents(documents)


def scan_packed_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Articles from archives of documents, an archive to a task."""
    return parse_documents(scan_packed(spark, path))


def markdown_document(crawl_time: Column | None = None, body: str = "body") -> Column:
    """The document text of an article row; missing fields get the layout's defaults."""
    stamp = F.date_format(F.col("crawl_time") if crawl_time is None else crawl_time, CRAWL_FORMAT)
    lines = [
        F.concat(F.lit(TITLE_START), text("title", NO_TITLE)),
        F.lit(""),
        F.concat(
            F.lit(AUTHOR_START), text("author", UNKNOWN),
            F.lit(TIME_START), text("publish_time", UNKNOWN),
        ),
        F.concat(
            F.lit(LIKES_START), F.coalesce("likes", F.lit(0)).cast("string"),
            F.lit(COMMENTS_START), F.coalesce("comments", F.lit(0)).cast("string"),
        ),
        F.concat(F.lit(URL_START), text("url")),
        F.lit(""),
        F.lit(RULE_LINE),
        F.lit(""),
        text(body),
        F.lit(""),
        F.lit(RULE_LINE),
        F.lit(""),
        F.concat(F.lit(CRAWL_START), stamp, F.lit(CRAWL_END)),
    ]
    return F.array_join(F.array(*lines), "\n")


# The article table: raw text is not stored, it is a rendering of the other columns.
STORED = StructType(
    [f for f in schemas.ARTICLES if f.name != "raw"]
    + [
        StructField("batch_id", LongType(), True),
        StructField("crawl_date", DateType(), True),
    ]
)


# Which keys have several versions, as of a batch: (key, latest). Spark's readers of the
# article table pass over the folder, as its name starts with an underscore.
REPLACED = "_replaced"
KEY = ["user_id", "article_id"]
POINTERS = StructType(
    [f for f in schemas.ARTICLES if f.name in KEY]
    + [StructField("latest", LongType(), True), StructField("base", LongType(), True)]
)


def _numbers(names: list[str], column: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{column}="))


def _newer(spark: SparkSession, path: str, stored: DataFrame) -> tuple[DataFrame, int | None]:
    """(key, latest) of all keys that may have replaced something, and the batch up to which
    they are compacted. Of batches since then only the keys are read, none of older ones;
    the first batch of a table cannot have replaced anything.
    """
    bases = _numbers(child_names(spark, f"{path}/{REPLACED}"), "base")
    if bases:
        since = bases[-1]
        pointers = spark.read.schema(POINTERS).parquet(f"{path}/{REPLACED}")
        known = pointers.filter(F.col("base") == since).select(*KEY, "latest")
    else:
        batches = _numbers(child_names(spark, path), "batch_id")
        since = batches[0] if batches else None
        known = None
    recent = stored if since is None else stored.filter(F.col("batch_id") > since)
    latest = recent.groupBy(*KEY).agg(F.max("batch_id").alias("latest"))
    if known is not None:
        latest = known.unionByName(latest)
    return latest, bases[-1] if bases else None


def scan_articles(spark: SparkSession, path: str) -> DataFrame:
    """The current version of every article in the article table.

    The table is append-only and a later batch replaces the same key. The keys that replaced
    something are compacted from time to time (``compact_articles``); a read takes those and
    the keys of the batches since. The wide rows pass through an anti join with them, so
    filters reach the scan, and text is shuffled only when that list is too large to send
    to every executor.
    """
    stored = spark.read.schema(STORED).parquet(path)
    newer, _ = _newer(spark, path, stored)
    replaced = newer.select(
        F.col("user_id").alias("_u"), F.col("article_id").alias("_a"), "latest"
    )
    stale = (
        (F.col("user_id") == F.col("_u"))
        & (F.col("article_id") == F.col("_a"))
        & (F.col("batch_id") < F.col("latest"))
    )
    return stored.join(replaced, stale, "left_anti")


def compact_articles(spark: SparkSession, path: str) -> None:
    """Note which keys have several versions, up to the newest batch.

    Keys of older batches are read once, narrow, and only those that a batch since the last
    compaction brought again go on. The list is appended as a folder of its own, so a run
    that fails or is repeated changes nothing that readers use.
    """
    batches = _numbers(child_names(spark, path), "batch_id")
    if not batches:
        return
    stored = spark.read.schema(STORED).parquet(path)
    newer, base = _newer(spark, path, stored)
    if base == batches[-1]:
        return
    since = batches[0] if base is None else base
    recent = stored.filter(F.col("batch_id") > since).groupBy(*KEY).agg(
        F.max("batch_id").alias("latest"), F.min("batch_id").alias("_first")
    )
    older = stored.filter(F.col("batch_id") <= since).select(*KEY)
    again = older.join(recent.select(*KEY), KEY, "left_semi").select(*KEY, F.lit(True).alias("_again"))
    several = recent.join(again.distinct(), KEY, "left").filter(
        F.col("_again") | (F.col("_first") < F.col("latest"))
    )
    known = newer.join(recent.select(*KEY), KEY, "left_anti") if base is not None else None
    rows = several.select(*KEY, "latest")
    (
        (rows if known is None else rows.unionByName(known))
        .withColumn("base", F.lit(batches[-1]).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("base")
        .parquet(f"{path}/{REPLACED}")
    )
