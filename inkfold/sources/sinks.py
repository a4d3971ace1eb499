"""Writers of stored state. Reruns of the same batch or day replace what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.sources.corpus import STORED, markdown_document
from inkfold.sources.ordered_text import write_ordered_text
from inkfold.sources.packed import write_packed

# Keeps the files of a hot partition at a readable size.
ROWS_PER_FILE = 1_000_000


def write_articles(articles: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch of articles to the article table.

    Partitioned by batch, then crawl day: a rerun of the batch replaces its own files
    only, nothing stored earlier is read or rewritten, and a day filter prunes. There is
    no shuffle; a hot day is written by every task that holds some of it.
    """
    rows = articles.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
        "crawl_date", F.to_date("crawl_time")
    )
    (
        rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("batch_id", "crawl_date")
        .parquet(path)
    )


def write_markdown(articles: DataFrame, path: str, batch_id: int) -> None:
    """The articles of a batch as text documents ``<user_id>/<article_id>.md`` in archives.

    A later batch replaces the same document; ``corpus.scan_packed_corpus`` reads them.
    """
    name = F.concat(F.col("article_id"), F.lit(".md"))
    documents = articles.select(
        F.concat_ws("/", F.col("user_id"), name).alias("path"), markdown_document().alias("raw")
    )
    write_packed(documents, path, batch_id)


def write_index_rows(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append the rows of one batch to the index table."""
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_snapshots(snapshots: DataFrame, path: str, run_id: int) -> None:
    """Store the snapshots of one run; they replace those of the same (user, date).

    Partitioned by date and run, not by user: a day with very many users stays a few
    files, and a rerun of the run overwrites its own partition. Replacing happens on
    reading, where the latest run of a (user, date) counts.
    """
    (
        snapshots.withColumn("run_id", F.lit(run_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "run_id")
        .parquet(path)
    )


def write_report_text(texts: DataFrame, path: str) -> None:
    """Reports of any size from their ordered pieces, one folder of parts per date.

    A rerun replaces its dates. The parts of a date, in the order of their names, are the
    report; ``scan_ordered_text`` reads them.
    """
    write_ordered_text(texts, path)


def write_quality_log(daily: DataFrame, path: str) -> None:
    """Daily counters and first failures as JSON lines, a partition per day; a rerun replaces it."""
    (
        daily.withColumn("p_date", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("p_date")
        .json(path)
    )
