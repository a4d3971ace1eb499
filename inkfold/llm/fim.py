"""Fill-in-the-middle over content-defined chunks whose line counts are remembered.

A rolling hash of eight bytes cuts a text into chunks where the content says so, hence a
passage that many documents share falls into the same chunks in all of them. What a chunk
adds to a count of lines (its characters, and where lines end in it) is its boundary
summary. A task remembers summaries by the chunk's bytes, so a chunk it has met is looked
up, and the lookup compares contents, not digests. Summed up, the chunks' counts say which
chunk holds a cut, and its summary says where. Python hands back three numbers a document;
texts are put together, and taken apart again, by expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import neutral

LEAST = 256  # bytes of a chunk
MOST = 8_192
BITS = 10  # a chunk ends with one in 2^BITS of the hashes
BLOCK = 1 << 20  # bytes hashed at a time
MEMORY = 32 << 20  # bytes of chunks whose summaries a task remembers

FACTOR = np.uint64(0x9E3779B97F4A7C15)
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULTS = ["_fim_units", "_fim_form", "_fim_prefix_chars", "_fim_middle_chars", "_fim_output"]

# Executors get this code with their tasks; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _hits(data: np.ndarray) -> np.ndarray:
    """Ends of the windows of eight bytes whose hash says to cut."""
    found = []
    for start in range(0, len(data) - 7, BLOCK):
        w = data[start : start + BLOCK + 7].astype(np.uint64)
        for shift in (1, 2, 4):
            w = w[shift:] | (w[:-shift] << np.uint64(8 * shift))
        found.append(np.flatnonzero((w * FACTOR) >> np.uint64(64 - BITS) == 0) + start + 8)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of UTF-8 bytes end, never inside a character."""
    n, last, ends = len(data), 0, []
    for hit in [*_hits(data).tolist(), n]:
        while hit - last > MOST:
            last += MOST
            while last < n and data[last] & 0xC0 == 0x80:
                last += 1
            ends.append(last)
        if hit == n or (hit - last >= LEAST and data[hit] & 0xC0 != 0x80):
            if hit > last:
                ends.append(hit)
                last = hit
    return ends


class Summaries(dict):
    """chunk -> (characters, characters up to and with each delimiter), remembered by content."""

    def __init__(self, delimiter: int, memory: int = MEMORY):
        super().__init__()
        self.delimiter, self.memory, self.used = delimiter, memory, 0

    def __missing__(self, chunk: bytes) -> tuple[int, np.ndarray]:
        data = np.frombuffer(chunk, np.uint8)
        chars = np.cumsum(data & 0xC0 != 0x80, dtype=np.int32)
        made = int(chars[-1]), chars[data == self.delimiter]
        self.used += len(chunk) + made[1].nbytes
        if self.used > self.memory:
            self.clear()
            self.used = len(chunk) + made[1].nbytes
        self[chunk] = made
        return made


class Lines:
    """Counts over one text by its chunks."""

    def __init__(self, text: str, summaries: Summaries):
        raw = text.encode()
        begins = [0, *chunk_ends(np.frombuffer(raw, np.uint8))]
        parts = [summaries[raw[a:b]] for a, b in zip(begins, begins[1:])]
        self.ends = [ends for _, ends in parts]
        self.chars = np.cumsum([0, *(chars for chars, _ in parts)])
        self.closed = np.cumsum([0, *(len(ends) for ends in self.ends)])
        ended = not raw or raw[-1] == summaries.delimiter
        self.n = int(self.closed[-1]) + (not ended)

    def stop(self, k: int) -> int:
        """Characters of the first ``k`` lines."""
        if k <= 0:
            return 0
        if k > self.closed[-1]:
            return int(self.chars[-1])
        at = int(np.searchsorted(self.closed, k)) - 1
        return int(self.chars[at] + self.ends[at][k - self.closed[at] - 1])


def _cuts(delimiter: str):
    """A UDF (text, one, other) -> units, characters before the first and the second cut."""
    kind = pa.struct([("units", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])

    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        summaries = Summaries(ord(delimiter))
        for texts, ones, others in batches:
            rows = []
            for text, one, other in zip(texts, ones.to_pylist(), others.to_pylist()):
                lines = Lines(text.as_py() or "", summaries)
                first, second = sorted((one % (lines.n + 1), other % (lines.n + 1)))
                rows.append((lines.n, lines.stop(first), lines.stop(second)))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], fields=list(kind)
            )

    return F.arrow_udf(cuts, "units bigint, first bigint, second bigint")


def _number(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def transform(
    docs: DataFrame,
    text_col: str = "text",
    key_col: str = "doc_id",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    delimiter: str = "\n",
) -> DataFrame:
    """``docs`` with the columns RESULTS: units, form, characters of prefix and middle, output.

    A text is cut at two of its unit boundaries that a SHA-256 of ``seed:key`` picks; units
    end with ``delimiter`` (one ASCII character) or with the text. Of all texts ``rate`` per
    cent are rearranged, ``spm`` per cent of these suffix first, the others prefix first.
    Form is ``plain`` for the rest, for empty and null texts, whose output is empty, and for
    texts with a marker in them, which could not be taken apart again; a plain text has no
    lengths. A null key counts as an empty one. Rows are treated one by one, so repeated rows
    and keys have equal results; an empty table gives an empty one. Columns pass unchanged,
    whatever their names, but those called like a result give way to it. Nothing is
    shuffled, and a text of any length is one row of one task.
    """
    docs = docs.select(*(docs[c] for c in docs.columns if c not in RESULTS))
    outer = [*docs.columns, *RESULTS]
    docs, text_col, key_col = neutral(docs, text_col, key_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    marked = docs.withColumns(
        {"_text": text, "_digest": F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)}
    )
    one, other = _number(F.col("_digest"), 0), _number(F.col("_digest"), 1)
    cut = marked.withColumn("_cut", _cuts(delimiter)("_text", one, other))
    plain = (
        (F.col("_text") == "")
        | F.contains("_text", F.lit(PREFIX))
        | F.contains("_text", F.lit(SUFFIX))
        | F.contains("_text", F.lit(MIDDLE))
        | (_number(F.col("_digest"), 2) % 100 >= rate)
    )
    form = (
        F.when(plain, "plain").when(_number(F.col("_digest"), 3) % 100 < spm, "spm").otherwise("psm")
    )
    formed = cut.withColumn("_form", form)
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    rest = F.lit(2**31 - 1)
    prefix = F.substr("_text", F.lit(1), first)
    middle = F.substr("_text", first + 1, second - first)
    suffix = F.substr("_text", second + 1, rest)
    head, tail, mid = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    shaped = F.col("_form") != "plain"
    return formed.select(
        *docs.columns,
        F.col("_cut.units"),
        "_form",
        F.when(shaped, F.col("_cut.first")),
        F.when(shaped, F.col("_cut.second") - F.col("_cut.first")),
        F.when(F.col("_form") == "psm", F.concat(head, prefix, tail, suffix, mid, middle))
        .when(F.col("_form") == "spm", F.concat(tail, suffix, head, prefix, mid, middle))
        .otherwise(F.col("_text")),
    ).toDF(*outer)


def restore(output: Column | str, form: Column | str) -> Column:
    """The text that ``transform`` made ``output`` from.

    Neither the text nor a seam between a piece and a marker holds another marker, so the
    first occurrence of each is the one that was put there.
    """
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    width = len(PREFIX)
    rest = F.lit(2**31 - 1)

    def parts(inner: str) -> tuple[Column, Column, Column]:
        at, mid = F.instr(output, F.lit(inner)), F.instr(output, F.lit(MIDDLE))
        return (
            F.substr(output, F.lit(width + 1), at - width - 1),
            F.substr(output, at + width, mid - at - width),
            F.substr(output, mid + width, rest),
        )

    prefix, suffix, middle = parts(SUFFIX)
    suffix_2, prefix_2, middle_2 = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
        .otherwise(output)
    )
