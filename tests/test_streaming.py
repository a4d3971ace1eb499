"""Streams against their batch forms, and after a restart."""

import pytest
from pyspark.sql import functions as F

from inkfold.streaming import ingest, quality_counters

SCHEMA = "article_id string, title string, content string, author string, publish_time string, crawl_time timestamp"


def rows(spark, ids, day=1):
    return (
        spark.createDataFrame([(str(i), "title", "c" * (250 if i % 3 else 10), "a", "p") for i in ids],
                              "article_id string, title string, content string, author string, publish_time string")
        .withColumn("crawl_time", F.lit(f"2024-01-{day:02d} 10:00:00").cast("timestamp"))
    )


def arrivals(spark, path, schema, one_file_at_a_time=True):
    return ingest.read_arrivals(spark, path, schema, 1 if one_file_at_a_time else None)


@pytest.mark.parametrize("start", [ingest.stream_ingest_by_state, ingest.stream_ingest_exact])
def test_each_article_once_also_after_a_restart(spark, tmp_path, start):
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    first = rows(spark, range(40))
    first.unionByName(first).write.mode("append").parquet(source)
    first.write.mode("append").parquet(source)
    start(arrivals(spark, source, first.schema), table, state).awaitTermination()
    assert sorted(int(r.article_id) for r in spark.read.parquet(table).collect()) == list(range(40))
    rows(spark, range(30, 60), day=2).write.mode("append").parquet(source)
    start(arrivals(spark, source, first.schema), table, state).awaitTermination()
    assert sorted(int(r.article_id) for r in spark.read.parquet(table).collect()) == list(range(60))


def test_exact_ingest_knows_ids_of_any_age(spark, tmp_path):
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    schema = rows(spark, [1]).schema
    for day in (1, 28, 12):
        rows(spark, [1, 100 + day], day).write.mode("append").parquet(source)
        ingest.stream_ingest_exact(arrivals(spark, source, schema), table, state).awaitTermination()
    assert sorted(r.article_id for r in spark.read.parquet(table).collect()) == ["1", "101", "112", "128"]


def test_exact_ingest_takes_the_same_row_whatever_the_order_of_arrival(spark, tmp_path):
    """Copies in one micro-batch: the first by time, ties by content; a missing time comes first."""
    at = "2024-01-01 10:00:00"
    made = [("1", "late", "2024-01-02 10:00:00"), ("1", "early", at), ("2", "x", at), ("2", "y", at),
            (None, "no id", at), (None, "no id", at), ("3", "timed", at), ("3", "no time", None)]
    kept = set()
    for run in range(3):
        source, table, state = (str(tmp_path / f"{x}{run}") for x in ("in", "table", "state"))
        made = made[3:] + made[:3]
        df = spark.createDataFrame(made, "article_id string, content string, crawl_time string")
        df = df.withColumns({"crawl_time": F.to_timestamp("crawl_time"), "likes": F.lit(2**53 + 1)})
        df.coalesce(1 + run).write.parquet(source)
        ingest.stream_ingest_exact(
            ingest.read_arrivals(spark, source, df.schema), table, state
        ).awaitTermination()
        found = spark.read.parquet(table)
        assert found.dtypes == df.dtypes and found.filter("likes <> 9007199254740993").isEmpty()
        kept.add(tuple(sorted((str(r.article_id), r.content) for r in found.collect())))
    (rows_kept,) = kept
    assert [r for r in rows_kept if r[0] != "2"] == [("1", "early"), ("3", "no time"), ("None", "no id")]
    assert len(rows_kept) == 4


def test_exact_ingest_reads_nothing_that_earlier_batches_stored(spark, tmp_path):
    """The stored files may be gone (moved to an archive, say): the state alone knows the ids."""
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    schema = rows(spark, [1]).schema
    rows(spark, range(10)).write.mode("append").parquet(source)
    ingest.stream_ingest_exact(arrivals(spark, source, schema), table, state).awaitTermination()
    for file in (tmp_path / "table").glob("*.parquet"):
        file.write_bytes(b"unreadable")
    rows(spark, range(5, 12)).write.mode("append").parquet(source)
    query = ingest.stream_ingest_exact(arrivals(spark, source, schema), table, state)
    query.awaitTermination()
    assert sum(p["sink"]["numOutputRows"] for p in query.recentProgress if p["sink"]["numOutputRows"] > 0) in (2, 0)
    new = [f for f in (tmp_path / "table").glob("*.parquet") if f.read_bytes() != b"unreadable"]
    found = spark.read.schema(schema).parquet(*map(str, new)).select("article_id").collect()
    assert sorted(int(r.article_id) for r in found) == [10, 11]


def test_counters_equal_batch_and_grow(spark, tmp_path):
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    schema = rows(spark, [1]).schema
    total = None
    for day, ids in ((1, range(30)), (2, range(50)), (1, range(7))):
        new = rows(spark, ids, day)
        total = new if total is None else total.unionByName(new)
        new.write.mode("append").parquet(source)
        quality_counters.stream_quality_counters(
            arrivals(spark, source, schema, False), table, state
        ).awaitTermination()
        want = sorted(map(tuple, quality_counters.daily_counters(total).collect()))
        got = spark.read.parquet(table).select("date", "total_articles", "passed", "failed")
        assert sorted(map(tuple, got.collect())) == want


def test_late_articles_are_stored_and_counted(spark, tmp_path):
    """Months behind what has arrived already."""
    source, table, state, counts, kept = (str(tmp_path / x) for x in ("in", "table", "state", "counts", "kept"))
    schema = rows(spark, [1]).schema
    total = None
    for month, ids in ((12, range(20)), (11, range(15, 25)), (1, range(24, 30))):
        new = rows(spark, ids).withColumn("crawl_time", F.lit(f"2024-{month:02d}-03 10:00:00").cast("timestamp"))
        total = new if total is None else total.unionByName(new)
        new.write.mode("append").parquet(source)
        ingest.stream_ingest_by_state(arrivals(spark, source, schema, False), table, state).awaitTermination()
        quality_counters.stream_quality_counters(
            arrivals(spark, source, schema, False), counts, kept
        ).awaitTermination()
    assert sorted(int(r.article_id) for r in spark.read.parquet(table).collect()) == list(range(30))
    want = sorted(map(tuple, quality_counters.daily_counters(total).collect()))
    got = spark.read.parquet(counts).select("date", "total_articles", "passed", "failed")
    assert sorted(map(tuple, got.collect())) == want
