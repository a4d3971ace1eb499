"""Articles that arrive continuously, each article once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

BUCKETS = 256  # of ids; a task holds the new rows of one bucket and micro-batch at a time
MISSING = "\0"  # stands for a missing id

# The processor travels with the task, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_arrivals(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of Parquet files dropped into a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_ingest_by_state(arrivals: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append each ``article_id`` once, however late it comes.

    There is no watermark, as that would drop late articles with the repeats. The ids are
    kept in the state store, on disk and partitioned by id; a micro-batch reads only those
    that it brings. ``stream_ingest_exact`` keeps no state but reads the stored ids.
    """
    return (
        arrivals.dropDuplicates(["article_id"])
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class FirstOfEachId(StatefulProcessor):
    """The first row of each id by a fixed order, unless an earlier batch had the id.

    A group is a bucket of ids; its state is a map with one entry per id ever seen.
    """

    def __init__(self, columns: list[str], key: int, rank: list[int]):
        self.columns, self.key, self.rank = columns, key, rank

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "id string", "stored boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first: dict[str, tuple[tuple, Row]] = {}
        for row in rows:
            # A missing value comes first and is compared with nothing.
            rank = tuple((row[i] is not None, row[i]) for i in self.rank)
            name = str(row[self.key]) if row[self.key] is not None else MISSING
            if name not in first or rank < first[name][0]:
                first[name] = rank, row
        for name, (_, row) in first.items():
            if not self.seen.containsKey((name,)):
                self.seen.updateValue((name,), (True,))
                yield Row(**dict(zip(self.columns, row)))

    def close(self) -> None:
        pass


def stream_ingest_exact(
    arrivals: DataFrame,
    table: str,
    checkpoint: str,
    order: tuple[str, ...] = ("crawl_time",),
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append each ``article_id`` once over the whole table's life, by a fixed choice.

    Of the rows that bring an id in one micro-batch the first by ``order`` is stored, then
    the one with the least hash of its columns, whatever order they arrive in; rows without
    an id count as one. The ids are state, kept by id in buckets on disk and in snapshots of
    the checkpoint; no micro-batch reads or lists what earlier ones stored. The state grows
    with the ids and is never cut, as an id may come back after any time. The sink's log makes
    a batch that runs again replace itself. ``buckets`` is fixed for a checkpoint's life.
    """
    columns = arrivals.columns
    fields = [*columns, "_hash", "_bucket"]
    keyed = arrivals.withColumns(
        {
            "_hash": F.xxhash64(*columns),
            "_bucket": F.pmod(F.xxhash64("article_id"), F.lit(buckets)).cast("int"),
        }
    )
    first = FirstOfEachId(
        columns, fields.index("article_id"), [fields.index(c) for c in (*order, "_hash")]
    )
    return (
        keyed.groupBy("_bucket")
        .transformWithState(first, arrivals.schema, outputMode="Append", timeMode="None")
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
