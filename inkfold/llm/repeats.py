"""Removal of strings that an earlier document has, by run-compressed indexes.

Every byte covered by a string of ``length`` bytes that also begins in a document with a
smaller id goes. Windows of that length are narrowed down twice before they are indexed:

1. Texts are cut into chunks where their content says so. Of equal chunks only the first
   document's is looked into; in the others every window is a repeat.
2. Windows meet by their anchors (``anchors.py``). Only contexts whose anchor occurs in
   two documents can hold a repeat.

The contexts that remain go by their anchor to tasks that build a run-compressed
Burrows-Wheeler index of them and stream each through it; a window goes if the least
document of its class is smaller than its own.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm import anchors
from inkfold.llm.run_index import RunIndex
from inkfold.llm.storage import stored

LENGTH = 50  # bytes of a string
EVERY = 512  # windows of a chunk, about
SLICE = 4_000_000  # bytes of texts a task looks at together
BLOCK = 200_000  # bytes of contexts in an index, but an anchor's are never divided
LEAST_ID = -(2**63)  # stands for a null id

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPAN = "id bigint, key bigint, begin int, stop int"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have about SLICE bytes."""
    for batch in batches:
        sizes = np.cumsum([len(t) for t in batch["text"].cast(pa.binary()).to_pylist()])
        begin = 0
        while begin < batch.num_rows:
            base = sizes[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(sizes, base + SLICE)))
            yield batch.slice(begin, stop - begin)
            begin = stop


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch["text"].cast(pa.binary()).to_pylist()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    )


def _chunked(rows: DataFrame, length: int) -> DataFrame:
    """(id, key, begin, stop, digest) of the chunks of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = _texts(batch)
            number, begin, stop = anchors.chunks(texts, length, EVERY)
            digests = [
                hashlib.blake2b(texts[t][b : s + length - 1], digest_size=16).digest()
                for t, b, s in zip(number, begin, stop)
            ]
            at = pa.array(number)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(at),
                    batch["key"].take(at),
                    pa.array(begin.astype(np.int32)),
                    pa.array(stop.astype(np.int32)),
                    pa.array(digests, pa.binary()),
                ],
                names=["id", "key", "begin", "stop", "digest"],
            )

    return rows.mapInArrow(run, _SPAN + ", digest binary")


def _packed(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    full = np.zeros((len(six), 8), np.uint8)
    full[:, :6] = six
    return full.view("<u8").ravel()


def _ranges(batch: pa.RecordBatch) -> list[np.ndarray]:
    made = []
    for part in batch["ranges"].to_pylist():
        made.append(np.array([(r["begin"], r["stop"]) for r in part or []], np.int64).reshape(-1, 2))
    return made


_MARK = pa.schema([("bucket", pa.int32()), ("anchors", pa.binary()), ("ids", pa.binary()), ("which", pa.binary())])


def _marks(bucket: int, h: np.ndarray, ids: np.ndarray) -> dict:
    """Anchors of one bucket with their documents, each of which is written once."""
    own, which = np.unique(ids, return_inverse=True)
    which = which.astype("<u4").view(np.uint8).reshape(-1, 4)
    size = 2 if len(own) <= 2**16 else 4
    return {
        "bucket": bucket,
        "anchors": _packed(h),
        "ids": own.tobytes(),
        "which": np.ascontiguousarray(which[:, :size]).tobytes(),
    }


def _marked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    h = _unpacked(row["anchors"])
    kind = "<u2" if len(row["which"]) == 2 * len(h) else "<u4"
    return h, np.frombuffer(row["ids"], np.int64)[np.frombuffer(row["which"], kind)]


def _both(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether another document has the anchor too, in the order given."""
    order = np.lexsort((ids, h))
    h, ids = h[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    last = np.append(first[1:], len(h)) - 1
    found = np.empty(len(h), bool)
    found[order] = np.repeat(ids[first] != ids[last], last - first + 1)
    return found


def _shared(ranged: DataFrame, length: int) -> DataFrame:
    """(id, anchors): the anchors of each document that another one has too.

    Anchors that two documents of a slice have are known at once; they go on once a slice,
    so a passage of a third of all documents is not gathered anywhere.
    """
    buckets = int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = 2**63 - 1

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            number, _, _, h = anchors.contexts(_texts(batch), _ranges(batch), length)
            if not len(h):
                continue
            ids = batch["id"].to_numpy()[number]
            both = _both(h, ids)
            once = np.unique(h[both])
            # Known here: passes through under a negative number. The anchor alone goes on
            # under the two ends of the ids, so any other document finds it shared.
            out = [_marks(-1 - int(h[0] % np.uint64(buckets)), h[both], ids[both])] if len(once) else []
            ends = np.repeat([LEAST_ID, top], len(once))
            h, ids = np.concatenate([h[~both], once, once]), np.concatenate([ids[~both], ends])
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                out.append(_marks(int(bucket[part[0]]), h[part], ids[part]))
            yield pa.RecordBatch.from_pylist(out, schema=_MARK)

    def answer(h: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        h, ids = h[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        raw, ends = _packed(h), np.append(first[1:], len(h))
        found = [raw[6 * a : 6 * b] for a, b in zip(first, ends)]
        return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(found, pa.binary())], names=["id", "anchors"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            parts = [_marked(r) for r in rows]
            h, ids = (np.concatenate(x) for x in zip(*parts))
            if rows[0]["bucket"] >= 0:
                keep = _both(h, ids) & (ids != top)
                # The least id may be a document's own (a null id); a mark it did not ask
                # for does no harm.
                h, ids = h[keep], ids[keep]
            if len(h):
                yield answer(h, ids)

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["bucket"] != held[0]["bucket"] or row["bucket"] < 0):
                    yield from flush(held)
                    held = []
                held.append(row)
        if held:
            yield from flush(held)

    marks = ranged.mapInArrow(local, "bucket int, anchors binary, ids binary, which binary")
    placed = marks.repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(meet, "id bigint, anchors binary")


_CONTEXT = pa.schema(
    [("anchor", pa.int64()), ("context", pa.binary()), ("id", pa.int64()), ("key", pa.int64()), ("begin", pa.int32()), ("stop", pa.int32())]
)
_CONTEXT_DDL = "anchor bigint, context binary, id bigint, key bigint, begin int, stop int"


def _gathered(marked: DataFrame, length: int) -> DataFrame:
    """Contexts under shared anchors; where a slice has one in a smaller document, its span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = _texts(batch)
            number, begin, end, h = anchors.contexts(texts, _ranges(batch), length)
            flags = [np.concatenate([_unpacked(x) for x in f or [b""]]) for f in batch["anchors"].to_pylist()]
            wanted = np.zeros(len(h), bool)
            edges = np.searchsorted(number, np.arange(len(texts) + 1))
            for t, f in enumerate(flags):
                part = slice(edges[t], edges[t + 1])
                wanted[part] = np.isin(h[part], f)
            ids, keys = batch["id"].to_numpy(), batch["key"].to_numpy()
            rows, least = [], {}
            for i in np.flatnonzero(wanted):
                t = number[i]
                context = texts[t][begin[i] : end[i]]
                rows.append((int(h[i]), context, int(ids[t]), int(keys[t]), int(begin[i]), int(end[i])))
                least[context] = min(least.get(context, ids[t]), ids[t])
            out = []
            for anchor, context, own, key, b, e in rows:
                repeat = least[context] < own
                out.append(
                    # A span has no context; its anchor only spreads it over tasks.
                    (anchor, None if repeat else context, own, key, b, e)
                )
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _CONTEXT)], schema=_CONTEXT
            )

    return marked.mapInArrow(run, _CONTEXT_DDL)


def _indexed(contexts: DataFrame, length: int) -> DataFrame:
    """(id, key, begin, stop): bytes of each row that an earlier document has."""

    def spans(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """``rows``: (context, id, key, begin). Equal contexts are one string of the index."""
        of: dict[bytes, int] = {}
        which_string = np.array([of.setdefault(r[0], len(of)) for r in rows])
        ids = np.array([r[1] for r in rows], np.int64)
        owners = np.full(len(of), 2**63 - 1)
        np.minimum.at(owners, which_string, ids)
        index = RunIndex(list(of), owners, length)
        strings, places, least = (np.concatenate(x) for x in zip(*index.stream()))
        # By string; all rows of a string then look at its places.
        order = np.lexsort((places, strings))
        strings, places, least = strings[order], places[order], least[order]
        begin = np.searchsorted(strings, which_string)
        count = np.searchsorted(strings, which_string, "right") - begin
        row = np.repeat(np.arange(len(rows)), count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        gone = least[at] < ids[row]
        row, place = row[gone], places[at[gone]]
        if not len(row):
            return
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        begins = np.array([r[3] for r in rows], np.int64)[row[first]]
        keys = np.array([r[2] for r in rows], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[row[first]]),
                pa.array(keys[row[first]]),
                pa.array((begins + place[first]).astype(np.int32)),
                pa.array((begins + place[last] + length).astype(np.int32)),
            ],
            names=["id", "key", "begin", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of finished anchors
        group: list[tuple] = []  # of the anchor at hand
        size, current = 0, None
        for batch in batches:
            yield batch.filter(batch["context"].is_null()).select(["id", "key", "begin", "stop"])
            rest = batch.filter(batch["context"].is_valid())
            columns = (rest[c].to_pylist() for c in ("anchor", "context", "id", "key", "begin"))
            for anchor, *row in zip(*columns):
                if anchor != current:
                    # An anchor that one document alone still has holds no repeat.
                    if any(r[1] != group[0][1] for r in group):
                        held += group
                        size += sum(len(r[0]) for r in group)
                        if size > BLOCK:
                            yield from spans(held)
                            held, size = [], 0
                    group, current = [], anchor
                group.append(row)
        if any(r[1] != group[0][1] for r in group):
            held += group
        if held:
            yield from spans(held)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _SPAN)


def _removed(docs: DataFrame) -> DataFrame:
    """(id, n_bytes, spans, kept): merged spans, and the bytes outside of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kept, spans, sizes = [], [], []
            for text, found in zip(_texts(batch), batch["spans"].to_pylist()):
                merged: list[list[int]] = []
                for b, s in sorted((x["begin"], x["stop"]) for x in found or []):
                    if merged and b <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s)
                    else:
                        merged.append([b, s])
                edges = [0, *(x for pair in merged for x in pair), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"begin": b, "stop": s} for b, s in merged])
                sizes.append(len(text))
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return docs.mapInArrow(
        run, "id bigint, n_bytes bigint, spans array<struct<begin:int,stop:int>>, kept binary"
    )


def _by_id(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with what ``other`` has for the same id and key.

    Only the id is a key of the join, so that all joins of texts share one exchange; the
    other equality is written so that it stays a condition beside it.
    """
    other = other.withColumnsRenamed({"id": "_id", "key": "_key"}).hint("merge")
    same = F.col("key").bitwiseXOR(F.col("_key")) == 0
    return rows.join(other, (F.col("id") == F.col("_id")) & same, how).drop("_id", "_key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row of ``docs``.

    ``spans`` are the maximal runs of removed bytes, ``kept`` what is left. Strings are
    sought in the texts as they came, never across documents, and only documents with a
    smaller id count: not a repeat in the same text, and not rows that share its id. A
    null id is smaller than all others. Null counts as empty; texts shorter than
    ``length`` are kept. Repeated rows get a row each. Other columns are not read. An empty
    table gives an empty result. ``length`` is at least 24.

    Texts pass one exchange, by id: all three joins that need them read it.
    """
    rows = _rows(docs, id_col, text_col)
    chunks = stored(_chunked(rows, length), "repeat-chunks")
    least = stored(chunks.groupBy("digest").agg(F.min("id").alias("least")), "repeat-digests")
    judged = stored(chunks.join(least.hint("merge"), "digest").drop("digest"), "repeat-judged")
    per_row = ["id", "key"]
    place = F.struct("begin", "stop")
    # Equal rows list equal chunks; a chunk of a row is listed once.
    fresh = judged.filter("id = least").groupBy(*per_row).agg(F.collect_set(place).alias("ranges"))
    copied = judged.filter("id > least").select(
        "id", "key", "begin", (F.col("stop") + length - 1).cast("int").alias("stop")
    )
    fresh = stored(fresh, "repeat-fresh")
    ranged = _by_id(rows, fresh).select("id", "key", "text", "ranges")
    # Rows that share an id share marks: one that is not their own finds nothing in them.
    shared = _shared(ranged, length).groupBy("id").agg(F.collect_list("anchors").alias("anchors"))
    marked = ranged.join(shared.hint("merge"), "id")
    found = _indexed(_gathered(marked, length), length)
    spans = found.unionByName(copied).groupBy(*per_row).agg(F.collect_set(place).alias("spans"))
    joined = _by_id(rows, spans, "left").select("id", "key", "text", "spans")
    return _removed(joined).withColumn("id", F.nullif("id", F.lit(LEAST_ID)))
