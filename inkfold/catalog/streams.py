"""Streaming queries, run to the end of what has arrived; they return the stored table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkfold.catalog.analysis import _SQL_DAILY, _SQL_FULL
from inkfold.catalog.registry import SQL_STAMP, query, stamp
from inkfold.catalog.views import Views
from inkfold.session import run_folder
from inkfold.streaming import ingest, quality_counters

_ARRIVAL = ["article_id", "user_id", "title", "author", "publish_time", "content", "crawl_time"]


def _arrivals(v: Views, repeats: int):
    """Articles dropped as files, each ``repeats`` times."""
    path = run_folder(v.spark, "arrivals")
    rows = v.articles.select(*_ARRIVAL)
    for _ in range(repeats):
        rows.write.mode("append").parquet(path)
    return path, StructType([f for f in rows.schema.fields])


def _stored(v: Views, path: str, schema: StructType):
    return v.spark.read.schema(schema).parquet(path)


_SQL_ONCE = f"select article_id, user_id, md5(content) as content_md5, {SQL_STAMP} from articles"


def _once(table):
    return table.select("article_id", "user_id", F.md5("content").alias("content_md5"), stamp())


@query("stream_incremental_ingest", _SQL_ONCE, "articles")
def stream_incremental_ingest(v: Views):
    source, schema = _arrivals(v, 2)
    table, state = run_folder(v.spark, "ingested"), run_folder(v.spark, "ingest-state")
    arrivals = ingest.read_arrivals(v.spark, source, schema)
    ingest.stream_ingest_by_state(arrivals, table, state).awaitTermination()
    return _once(_stored(v, table, schema))


@query("stream_incremental_ingest_exact", _SQL_ONCE, "articles")
def stream_incremental_ingest_exact(v: Views):
    """Two triggers over the same articles; the second adds nothing."""
    source, schema = _arrivals(v, 1)
    table, state = run_folder(v.spark, "ingested"), run_folder(v.spark, "ingest-state")

    def run():
        arrivals = ingest.read_arrivals(v.spark, source, schema)
        ingest.stream_ingest_exact(arrivals, table, state).awaitTermination()

    run()
    # The same files arrive again.
    v.spark.read.schema(schema).parquet(source).write.mode("append").parquet(source)
    run()
    return _once(_stored(v, table, schema))


@query("stream_quality_counters", f"with g as ({_SQL_FULL}), {_SQL_DAILY} select * from daily", "articles")
def stream_quality_counters(v: Views):
    source, schema = _arrivals(v, 1)
    table, state = run_folder(v.spark, "counters"), run_folder(v.spark, "counter-state")
    arrivals = ingest.read_arrivals(v.spark, source, schema)
    quality_counters.stream_quality_counters(arrivals, table, state).awaitTermination()
    return v.spark.read.schema(
        "total_articles bigint, passed bigint, failed bigint, date date"
    ).parquet(table)
