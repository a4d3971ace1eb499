"""Row numbers and first-K per group that hold up when one group has most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.session import materialize


def first_k(df: DataFrame, group: list[str], order: list[str], k: int, number: str) -> DataFrame:
    """Rows numbered 1..k inside each group in ascending order, the rest dropped.

    The filter on the rank lets the optimizer put a group limit before the shuffle: each
    map task sends at most k rows of a group, however large the group is. It does so up
    to a configured k; beyond that the numbering that needs no limit takes over.
    """
    largest = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > largest:
        return number_rows(df, group, order, number).filter(F.col(number) <= k)
    window = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn(number, F.row_number().over(window))
        .filter(F.col(number) <= k)
        .withColumn(number, F.col(number).cast("bigint"))
    )


def number_rows(df: DataFrame, group: list[str], order: list[str], number: str) -> DataFrame:
    """Add the row number inside each group, in ascending order of ``order``.

    A ranking window without a limit puts a whole group into one task. Here the rows
    are range-partitioned by (group, order), so a large group spans many tasks; a row's
    number is its place in its own partition plus the rows its group has in earlier
    ones. Only the per-partition totals (at most groups + partitions rows) meet again.

    ``order`` has to be unique inside a group, and the columns of ``df`` should be
    narrow: join wide ones back by key afterwards. The sorted rows are checkpointed
    because both halves of the plan must see the same partition borders.
    """
    placed = materialize(
        df.sort(*group, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", 33))
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = (
        placed.groupBy(*group, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    keys = [*group, "_part"]
    for key in keys:
        totals = totals.withColumnRenamed(key, f"_t_{key}")
    same = [F.col(key).eqNullSafe(F.col(f"_t_{key}")) for key in keys]
    return placed.join(totals, same, "left").select(
        *df.columns,
        (F.col("_before") + F.col("_slot") - F.col("_first") + 1).cast("bigint").alias(number),
    )
