"""Row filters of the collection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import text
from inkfold.params import SiteParams


def filter_column_articles(rows: DataFrame, site: SiteParams) -> DataFrame:
    """Drop replies and everything that is not a column article."""
    return rows.filter(
        F.coalesce(F.col("is_column"), F.lit(False))
        & ~text("title").startswith(site.reply_prefix)
    )


def filter_user(accounts: DataFrame, user_id: str) -> DataFrame:
    """One account; an unknown id gives no rows."""
    return accounts.filter(F.col("id") == user_id)


def filter_crawl_date(
    rows: DataFrame,
    day: dt.date,
    crawl_time: str = "crawl_time",
    partition_column: str | None = None,
) -> DataFrame:
    """Rows collected on ``day``.

    A half-open range on the timestamp reaches the scan as a pushed filter. Where the
    table is partitioned by crawl day, name that column to prune partitions too.
    """
    start = F.lit(day.isoformat()).cast("timestamp")
    end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    kept = rows.filter((F.col(crawl_time) >= start) & (F.col(crawl_time) < end))
    if partition_column:
        kept = kept.filter(F.col(partition_column) == F.lit(day))
    return kept
