"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their length and then by successive bytes, most significant
first. One round looks at the next ``width`` bytes of every document that still has a
partner, and widths grow eightfold, so a document of n bytes needs about log8(n) rounds.
A group is finished when it has one member, or when its bytes have ended; what is left
together at the end is equal byte for byte. No digest decides anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import discard, neutral, stored

HEAD = 64  # bytes of the first split, which counts only
WIDTH = 512  # bytes of the first round that carries texts
GROWTH = 8


RESULTS = ["_keep_id", "_group_size", "_kept"]


def _bytes(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``_keep_id``, ``_group_size`` and ``_kept``.

    Rows with equal texts form a class; null counts as the empty text. The row with the
    largest id stays. A row that is repeated with its id is a member like any other: the
    class keeps exactly one of them, so ``_kept`` is true once in each class. A null id
    ranks below all others. An empty table gives an empty result. Columns of any name are
    carried along, but those called like a result give way to it.

    Texts pass one exchange, at every size: the joins ask for a merge join, so a small
    table takes the plan of a large one and needs no broadcast. Only documents with a partner in length and first bytes are
    written with their text for the further rounds. Group tables are written before they
    are joined back, so that the partition of a group of copies that holds a third of
    all rows is split over tasks.
    """
    docs = docs.select(*(docs[c] for c in docs.columns if c not in RESULTS))
    plain, own_id, own_text = neutral(docs, id_col, text_col)
    found = _classes(plain, own_id, own_text)
    return found.select(*plain.columns, *RESULTS).toDF(*docs.columns, *RESULTS)


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    keyed = docs.withColumns(
        {
            "_radix_n": F.octet_length(_bytes(text)),
            "_radix_head": F.substring(_bytes(text), 1, HEAD),
        }
    )
    key = ["_radix_n", "_radix_head"]
    heads = stored(
        keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("_radix_count")).filter("_radix_count > 1"),
        "radix-heads",
    )
    rows = stored(
        keyed.join(heads.hint("merge"), key, "left")
        .drop("_radix_head")
        .withColumn("_radix_row", F.monotonically_increasing_id()),
        "radix-rows",
    )
    discard(heads)
    decided = _split(
        rows.filter("_radix_count is not null").select(
            "_radix_row",
            "_radix_n",
            F.col(id_col).alias("_radix_id"),
            F.lit(0).cast("bigint").alias("_radix_group"),
            _bytes(text).alias("_radix_rest"),
        )
    )
    alone = rows.filter("_radix_count is null").withColumns(
        {
            "_keep_id": F.col(id_col),
            "_group_size": F.lit(1).cast("bigint"),
            "_kept": F.lit(True),
        }
    )
    together = rows.filter("_radix_count is not null").join(decided.hint("merge"), "_radix_row", "left")
    together = together.withColumns(
        {
            "_keep_id": F.when(F.col("_kept").isNull(), F.col(id_col)).otherwise(F.col("_keep_id")),
            "_group_size": F.coalesce("_group_size", F.lit(1).cast("bigint")),
            "_kept": F.coalesce("_kept", F.lit(True)),
        }
    )
    names = [*docs.columns, "_keep_id", "_group_size", "_kept"]
    return alone.select(*names).unionByName(together.select(*names))


def _split(rest: DataFrame) -> DataFrame:
    """Decisions by row for every class of two or more rows."""
    offset, width, ended, number = 0, WIDTH, None, 0
    while True:
        chunk = F.substring("_radix_rest", 1, width)
        keyed = rest.withColumn("_radix_chunk", chunk)
        key = ["_radix_n", "_radix_group", "_radix_chunk"]
        groups = stored(
            keyed.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("_radix_size"), F.min("_radix_row").alias("_radix_next"))
            .filter("_radix_size > 1"),
            f"radix-groups-{number}",
        )
        offset += width
        shared = stored(
            keyed.join(groups.hint("merge"), key).select(
                "_radix_row",
                "_radix_id",
                "_radix_n",
                F.col("_radix_next").alias("_radix_group"),
                F.substring("_radix_rest", width + 1, 2**31 - 1).alias("_radix_rest"),
            ),
            f"radix-shared-{number}",
        )
        discard(groups)
        done = shared.filter(F.col("_radix_n") <= offset).select(
            "_radix_row", "_radix_id", "_radix_group"
        )
        ended = done if ended is None else ended.unionByName(done)
        rest = shared.filter(F.col("_radix_n") > offset)
        if rest.isEmpty():
            break
        width, number = width * GROWTH, number + 1
    winners = stored(
        ended.groupBy("_radix_group").agg(
            F.max(F.struct("_radix_id", "_radix_row")).alias("_radix_best"),
            F.count(F.lit(1)).alias("_group_size"),
        ),
        "radix-winners",
    )
    return ended.join(winners.hint("merge"), "_radix_group").select(
        "_radix_row",
        F.col("_radix_best._radix_id").alias("_keep_id"),
        "_group_size",
        (F.col("_radix_row") == F.col("_radix_best._radix_row")).alias("_kept"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text. Any column names will do."""
    plain, own_id, own_text = neutral(docs, id_col, text_col)
    kept = classes(plain, own_id, own_text).filter("_kept")
    return kept.select(*plain.columns).toDF(*docs.columns)
