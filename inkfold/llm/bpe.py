"""Byte-level BPE over overlapping chunks.

Texts longer than a chunk are cut into chunks that overlap. Each chunk is pre-tokenised
by itself. Where a boundary of a chunk's last stretch is also a boundary of the next
chunk's first stretch, both agree on everything after it, because the pattern never looks
behind: there the two are stitched. The pieces between stitches are encoded in parallel
and their ids put together in order. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import neutral, stored

CHUNK = 16_384  # characters
OVERLAP = 256
GROWTH = 8  # of both, for texts whose chunks did not resynchronise
LOOKAHEAD = 4  # a match that ends so near a chunk's end may go on behind it
ROWS = 256  # encoded at a time in a task

# Executors get this code with their tasks; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _mapped(batches: Iterable[pa.RecordBatch], column: str, name: str, kind, f):
    """Batches with ``column`` replaced by f of its values, a few rows at a time."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            made = pa.array([f(x) for x in part.column(at).to_pylist()], kind)
            arrays = [c for i, c in enumerate(part.columns) if i != at] + [made]
            names = [n for i, n in enumerate(part.schema.names) if i != at] + [name]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _with(df: DataFrame, column: str, new: str) -> str:
    """DDL of ``df`` with ``column`` replaced by ``new``."""
    return ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column] + [new]
    )


def _encode_rows(df: DataFrame, text: str, out: str, ranks: str, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary = encoding(ranks, pattern).encode_ordinary
        return _mapped(batches, text, out, pa.list_(pa.int32()), lambda x: ordinary(x or ""))

    return df.mapInArrow(run, _with(df, text, f"`{out}` array<int>"))


def marks(text: str, compiled: regex.Pattern, step: int, overlap: int, last: bool):
    """Boundaries in the first and in the last stretch of a chunk, counted from its start.

    A boundary of the last stretch counts if no character behind the chunk can move it
    and if it does not follow white space, so that the piece before it encodes alike
    when it stands alone.
    """
    ends = [m.end() for m in compiled.finditer(text)]
    first = [0, *(e for e in ends if e <= overlap)]
    if last:
        return first, []
    sure = len(text) - LOOKAHEAD
    return first, [e for e in ends if step <= e <= sure and not text[e - 1].isspace()]


def _stitches(chunks: DataFrame, pattern: str, step: int, overlap: int) -> DataFrame:
    """(row, k, cut): where chunk k ends and chunk k + 1 takes over; null if nowhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            found = [
                marks(t, compiled, step, overlap, last)
                for t, last in zip(batch["chunk"].to_pylist(), batch["last"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_row"],
                    batch["k"],
                    batch["last"],
                    pa.array([f for f, _ in found], pa.list_(pa.int32())),
                    pa.array([t for _, t in found], pa.list_(pa.int32())),
                ],
                names=["_row", "k", "last", "head", "tail"],
            )

    found = stored(
        chunks.mapInArrow(
            run, "_row bigint, k int, last boolean, head array<int>, tail array<int>"
        ),
        "bpe-marks",
    )
    after = found.filter("k > 0").select(
        "_row", (F.col("k") - 1).alias("k"), F.transform("head", lambda x: x + step).alias("next")
    )
    return (
        found.filter("not last")
        .join(after, ["_row", "k"])
        .select("_row", "k", F.array_min(F.array_intersect("tail", "next")).alias("cut"))
    )


def _encode_long(long: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, ids) of texts over one chunk long."""
    done = None
    while True:
        parts = F.expr(f"regexp_extract_all(text, '(?s).{{1,{chunk}}}', 0)")
        cut = long.select("_row", parts.alias("p")).select(
            "_row",
            F.expr("size(p)").alias("n"),
            F.posexplode(
                F.expr(f"transform(p, (x, i) -> concat(x, left(coalesce(get(p, i + 1), ''), {overlap})))")
            ).alias("k", "chunk"),
        )
        chunks = stored(
            cut.select("_row", "k", "chunk", (F.col("k") == F.col("n") - 1).alias("last")),
            "bpe-chunks",
        )
        stitches = stored(_stitches(chunks, pattern, chunk, overlap), "bpe-stitches")
        failed = stitches.filter("cut is null").select("_row").distinct()
        begins = stitches.select("_row", (F.col("k") + 1).alias("k"), (F.col("cut") - chunk).alias("begin"))
        sure = chunks.join(failed, "_row", "left_anti")
        pieces = (
            sure.join(stitches.withColumnRenamed("cut", "end"), ["_row", "k"], "left")
            .join(begins, ["_row", "k"], "left")
            .withColumns(
                {
                    "begin": F.coalesce("begin", F.lit(0)),
                    "end": F.coalesce("end", F.char_length("chunk")),
                }
            )
            .select("_row", "k", F.expr("substring(chunk, begin + 1, end - begin)").alias("piece"))
        )
        ids = (
            _encode_rows(pieces, "piece", "ids", ranks, pattern)
            .groupBy("_row")
            .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("p"))
            .select("_row", F.flatten(F.col("p.ids")).alias("ids"))
        )
        done = ids if done is None else done.unionByName(ids)
        if failed.isEmpty():
            return done
        long = long.join(stored(failed, "bpe-failed"), "_row")
        chunk, overlap = chunk * GROWTH, overlap * GROWTH


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with the text replaced by its token ids (``array<int>``).

    Null and empty texts have no ids. Repeated rows and repeated document ids are encoded
    row by row. Texts of any length are taken whole; one whose chunks do not
    resynchronise (a run of one kind of character longer than the overlap) is cut again
    with longer chunks and overlaps, until it does or is one chunk. Columns other than
    the text pass unchanged, whatever their names; one called ``ids_col`` gives way to the
    ids. An empty table gives an empty result.
    """
    docs = docs.select(*(docs[c] for c in docs.columns if c == text_col or c != ids_col))
    outer = [*(c for c in docs.columns if c != text_col), ids_col]
    docs, text_col = neutral(docs, text_col)
    ids_col = "ids"
    size = F.char_length(F.coalesce(F.col(text_col), F.lit("")))
    names = [*(c for c in docs.columns if c != text_col), ids_col]
    short = _encode_rows(docs.filter(size <= chunk), text_col, ids_col, ranks, pattern)
    rest = docs.filter(size > chunk)
    long = stored(
        rest.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(text_col).alias("text"),
            F.struct(*(rest[c] for c in docs.columns if c != text_col), F.lit(1).alias("_one")).alias("_rest"),
        ),
        "bpe-long",
    )
    ids = _encode_long(long.select("_row", "text"), ranks, pattern, chunk, overlap)
    together = (
        ids.withColumnRenamed("ids", "_ids")
        .join(long.select("_row", "_rest"), "_row")
        .select(*(F.col("_rest").getField(c).alias(c) for c in names[:-1]), F.col("_ids").alias(ids_col))
    )
    return short.select(*names).unionByName(together).toDF(*outer)


def decode(
    docs: DataFrame, ranks: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded"
) -> DataFrame:
    """``docs`` with the ids replaced by the concatenated bytes of all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoding(ranks, pattern).decode_bytes
        return _mapped(batches, ids_col, bytes_col, pa.binary(), lambda x: of(x or []))

    return docs.mapInArrow(run, _with(docs, ids_col, f"`{bytes_col}` binary"))
