"""Report text as ordered blocks of lines: numbered, cut into pages, of any size.

A *block row* is ``date, block, place, lead, lines, open``: a few lines that stay together.
Sorting by (block, place) gives the report of a date. Where ``lead`` is not NULL the row's
number among the rows of its (date, block) goes between ``lead`` and the first line. Where
``open`` holds, the last line goes on with the next row, so a line that lists very many
things is many rows. No step gathers a date or a line: the rows are sorted by range over
tasks, and numbers and offsets come from totals per task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.session import materialize

KEYS = ["block", "place"]
NO_LINES = "array<string>"
PAGE_CHARS = 1_000_000  # of a page, the largest piece of text that is one row

# The page cutter travels with the task, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def place(a: Column | None = None, b: Column | None = None, c: Column | None = None) -> Column:
    """Order key inside a block: number, then text, then number."""
    zero = F.lit(0)
    return F.named_struct(
        F.lit("a"), (zero if a is None else a).cast("bigint"),
        F.lit("b"), (F.lit("") if b is None else b).cast("string"),
        F.lit("c"), (zero if c is None else c).cast("bigint"),
    )


def article_place() -> Column:
    """Articles in the order they were collected."""
    return place(
        b=F.concat_ws(
            "/", F.date_format("crawl_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("article_id")
        )
    )


def lines_of(*items: Column | str) -> Column:
    """An array of lines from texts and columns."""
    return F.array(*[F.lit(i) if isinstance(i, str) else i for i in items])


def lines_if(condition: Column, block: Column) -> Column:
    """The lines of ``block`` where the condition holds, else none."""
    return F.when(F.coalesce(condition, F.lit(False)), block).otherwise(
        F.array().cast(NO_LINES)
    )


def keyed(
    block: int | Column,
    lines: Column,
    order: Column | None = None,
    lead: Column | None = None,
    open: bool = False,
) -> Column:
    """Lines that stay together, with their place in the report."""
    return F.named_struct(
        F.lit("block"), F.lit(block) if isinstance(block, int) else block,
        F.lit("place"), place() if order is None else order,
        F.lit("lead"), F.lit(None).cast("string") if lead is None else lead,
        F.lit("lines"), lines,
        F.lit("open"), F.lit(open),
    )


def block_rows(df: DataFrame, *parts: Column) -> DataFrame:
    """The block rows of each row of ``df``; those without lines are left out."""
    present = F.filter(F.array(*parts), lambda x: F.size(x["lines"]) > 0)
    return df.select("date", F.inline(present))


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in order over range partitions, with its ``_part`` and a rising ``_slot``.

    Checkpointed, because what is worked out per partition has to meet the same ones again.
    """
    return materialize(
        df.sort(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", 33))
    )


def with_totals(placed: DataFrame, group: list[str], total: Column, name: str) -> DataFrame:
    """``placed`` with the ``total`` of its group's earlier partitions, order unchanged.

    The totals are a row per partition and per group that begins in it, far fewer than
    groups + partitions of a report table of any size; they go to every task, as a shuffled
    join would lose the order.
    """
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = (
        placed.groupBy(*group, "_part")
        .agg(total.alias("_total"), F.min("_slot").alias("_first"))
        .withColumn(name, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).cast("bigint"))
        .drop("_total")
    )
    keys = [*group, "_part"]
    totals = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_first", name)
    same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    return placed.join(F.broadcast(totals), same).drop(*[f"_t_{k}" for k in keys])


def in_order(blocks: DataFrame) -> DataFrame:
    """Block rows in report order, with their numbers put in.

    ``number`` counts the rows of a block that have a lead; for others it is the first
    component of their place. One exchange carries the text.
    """
    counted = with_totals(ordered(blocks, "date", *KEYS), ["date", "block"], F.count(F.lit(1)), "_before")
    number = F.col("_before") + F.col("_slot") - F.col("_first") + 1
    head = F.concat(F.col("lead"), number.cast("string"), F.col("lines")[0])
    lines = F.when(
        F.col("lead").isNotNull(),
        F.concat(F.array(head), F.slice("lines", F.lit(2), F.size("lines"))),
    ).otherwise(F.col("lines"))
    return counted.select(
        "date",
        "block",
        "place",
        F.when(F.col("lead").isNotNull(), number).otherwise(F.col("place.a")).alias("number"),
        lines.alias("lines"),
        "open",
        "_slot",
        "_part",
    )


def line_rows(rows: DataFrame) -> DataFrame:
    """Every line, or piece of a line that goes on, as a row of its own."""
    return rows.select(
        "date", "block", "number", "place", "open", F.posexplode("lines").alias("line_no", "line")
    )


def pieces(rows: DataFrame) -> DataFrame:
    """The text of each block row; put together in order they are the report, to the byte."""
    end = F.when(F.col("open"), "").otherwise("\n")
    return rows.select(
        "date", F.concat(F.array_join("lines", "\n"), end).alias("text"), "_slot", "_part"
    )


def pages(texts: DataFrame, chars: int = PAGE_CHARS, column: str = "report") -> DataFrame:
    """``date, page, <column>``: the text of each date in pages of ``chars`` characters.

    ``texts`` are ordered pieces. A report of at most a page is one row. A task cuts the
    pieces of its partitions in one pass, knowing how many characters come before; only the
    parts of a page that come from several tasks meet again.
    """
    placed = with_totals(texts, ["date"], F.sum(F.char_length("text")), "_before")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = 0, None  # characters of this date so far, and where its stretch begins
        for batch in batches:
            made: list[tuple] = []
            for date, first, before, text in zip(*(c.to_pylist() for c in batch.columns)):
                if first != seen:
                    seen, at = first, before
                while text:
                    page = at // chars
                    part, text = text[: (page + 1) * chars - at], text[(page + 1) * chars - at :]
                    if made and made[-1][:2] == (first, page):
                        made[-1][-1].append(part)
                    else:
                        made.append((first, page, date, at, [part]))
                    at += len(part)
            kinds = batch.schema.types[0], pa.int64(), pa.int64(), pa.string()
            columns = (
                [m[2] for m in made], [m[1] for m in made], [m[3] for m in made],
                ["".join(m[4]) for m in made],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["date", "page", "at", "part"]
            )

    whole = placed.select("date", "_first", "_before", "text")
    kind = whole.schema["date"].dataType.simpleString()
    return (
        whole.mapInArrow(cut, f"date {kind}, page bigint, at bigint, part string")
        .groupBy("date", "page")
        .agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_parts"))
        .select("date", "page", F.array_join(F.col("_parts.part"), "").alias(column))
    )
