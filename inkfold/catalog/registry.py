"""Registered queries: a name, a Spark plan, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.catalog.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``f(views) -> DataFrame``; ``views`` names what the SQL reads."""

    def register(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return build(Views(spark, sf))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, sql) if views else sql.strip()
        return build

    return register


def stamp(c: str | Column = "crawl_time") -> Column:
    """Timestamps are compared as text to the microsecond."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(
        c if isinstance(c, str) else "crawl_time"
    )


SQL_STAMP = "strftime(crawl_time, '%Y-%m-%d %H:%M:%S.%f') as crawl_time"


def big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)
