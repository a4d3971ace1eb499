"""Running daily quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkfold.operators.quality import quality_gate_full
from inkfold.params import GateParams


def daily_counters(arrivals: DataFrame, p: GateParams = GateParams()) -> DataFrame:
    """Totals per crawl day as a windowed aggregate; works on streams and tables."""
    gated = quality_gate_full(arrivals, p).select("crawl_time", "quality_passed")
    return (
        gated.groupBy(F.window("crawl_time", "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_articles"),
            F.count_if("quality_passed").alias("passed"),
            F.count_if(~F.col("quality_passed")).alias("failed"),
        )
        .select(F.to_date("w.start").alias("date"), "total_articles", "passed", "failed")
    )


def stream_quality_counters(
    arrivals: DataFrame, table: str, checkpoint: str, p: GateParams = GateParams()
) -> StreamingQuery:
    """Keep one partition per day with that day's counters.

    Update mode emits a day's new totals whenever they change, and each replaces the
    day's partition. The state is one row per day and kept for good, so a row counts
    however late it comes. Replacing is idempotent: a batch that runs twice does no harm.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(table)
        )

    return (
        daily_counters(arrivals, p)
        .writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
