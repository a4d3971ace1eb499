"""Token-id files: one zstandard frame per document, a shared dictionary, an offset index.

A folder holds

* ``dictionary``: the dictionary, trained on serialised id arrays; may be empty
* ``shards/<name>.tok``: frames one after another, in ascending id order; a frame is
  the document's ids as little-endian unsigned 32-bit integers
* ``shards/<name>.idx``: a record (``INDEX``) per document: where its frame is, how many
  ids it has, and how many the shard holds before it
* ``manifest``: a Parquet row per shard: its place in the order, first and last id, sizes,
  and the SHA-256 of the dictionary that its frames need

A document is read by two lookups and one frame. A task that is run again writes under
another name; only the shards in the manifest count.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

INDEX = np.dtype(
    [("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("bytes", "<u8"), ("tokens", "<u8"), ("start", "<u8")]
)
DICTIONARY = 64 * 1024  # bytes
SAMPLE = 1000  # documents the dictionary is trained on, at most
SAMPLE_IDS = 4096  # ids of one of them, at most; longer ones need no dictionary
LEVEL = 3
ROWS = 256
MEMO = 800_000  # units whose ids a worker process remembers
UNIT = 64  # characters of a unit that is remembered

MANIFEST = (
    "part int, name string, first bigint, last bigint, documents bigint, tokens bigint, "
    "bytes bigint, dictionary string"
)

# A cut between other characters and one of these four is a boundary of pre-tokens, as no
# part of the pattern runs from the one into the other; nothing looks across it.
_UNITS = re.compile("[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# Texts with white space of other kinds are encoded in one piece.
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")


def _memo(tokenizer: str, special: bool) -> dict[str, bytes]:
    """Ids of units, kept for the next tasks of the process.

    The code of a task comes with it and has globals of its own; a module stays.
    """
    kept = sys.modules.setdefault("_inkfold_units", types.ModuleType("_inkfold_units"))
    return kept.__dict__.setdefault(f"{special}:{tokenizer}", {})


class Encoder:
    """Ids of whole texts through the library, whose result for a unit is remembered.

    ``special``: special tokens written out in a text are those tokens, as the library does
    by default; else ordinary pieces.
    """

    def __init__(self, tokenizer: str, end: int | None, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.library.encode_special_tokens = not special
        # A text with one of these is encoded in one piece, as they may take in what is beside them.
        marks = [t.content for t in self.library.get_added_tokens_decoder().values()] if special else []
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.end = b"" if end is None else int(end).to_bytes(4, "little")
        self.memo = _memo(tokenizer, special)

    def _fresh(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _whole(self, text: str) -> bool:
        return bool(_OTHER_SPACE.search(text) or self.marks and self.marks.search(text))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [[t] if t and self._whole(t) else _UNITS.findall(t or "") for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        missing = list({u for units in cut for u in units if u not in memo})
        memo.update(zip(missing, self._fresh(missing)))
        made = [b"".join(map(memo.__getitem__, units)) + self.end for units in cut]
        for unit in missing:
            if len(unit) > UNIT:
                del memo[unit]
        return made


def _codec(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def train(
    docs: DataFrame, tokenizer: str, end: int | None, id_col: str, text_col: str, special: bool = False
) -> bytes:
    """A dictionary from a bounded sample: the ids with the smallest hashes.

    At most ``SAMPLE`` documents of at most ``SAMPLE_IDS`` ids come to the driver. It is
    empty where there is too little to train on; frames then stand by themselves.
    """
    chosen = docs.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, end, special)
        for batch in batches:
            raw = [x for x in encode(batch[text_col].to_pylist()) if len(x) <= 4 * SAMPLE_IDS]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["ids"])

    texts = docs.join(chosen, id_col, "left_semi").select(text_col)
    rows = texts.mapInArrow(run, "ids binary").orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE).collect()
    samples = [bytes(r["ids"]) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _put(target: fs.FileSystem, path: str, data: bytes) -> None:
    with target.open_output_stream(path) as out:
        out.write(data)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    special: bool = False,
) -> None:
    """Encode ``docs`` and write the files; ``folder`` must be new and reachable by all.

    Ids ascend over all shards, null first. Rows that share an id follow each other by
    the hash of their text, so a repeated row is written as often as it comes. Null and
    empty texts have only the end id. ``special``: see ``Encoder``. Columns other than id and text are not read. An
    empty table makes an empty manifest.
    """
    docs = docs.select(id_col, text_col)
    dictionary = train(docs, tokenizer, end, id_col, text_col, special)
    digest = hashlib.sha256(dictionary).hexdigest()
    target, root = fs.FileSystem.from_uri(folder)
    target.create_dir(f"{root}/shards", recursive=True)
    _put(target, f"{root}/dictionary", dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, at = fs.FileSystem.from_uri(folder)
        encode = Encoder(tokenizer, end, special)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_codec(dictionary))
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        records, offset, start = [], 0, 0
        with to.open_output_stream(f"{at}/shards/{name}.tok") as out:
            for whole in batches:
                for begin in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(begin, ROWS)
                    for key, raw in zip(batch["id"].to_pylist(), encode(batch["text"].to_pylist())):
                        frame = press.compress(raw)
                        out.write(frame)
                        records.append((key or 0, key is None, offset, len(frame), len(raw) // 4, start))
                        offset += len(frame)
                        start += len(raw) // 4
        table = np.array(records, INDEX)
        _put(to, f"{at}/shards/{name}.idx", table.tobytes())
        if len(table):
            known = table["id"][table["null"] == 0]
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "name": name,
                        "first": int(known[0]) if len(known) else None,
                        "last": int(known[-1]) if len(known) else None,
                        "documents": len(table),
                        "tokens": start,
                        "bytes": offset,
                        "dictionary": digest,
                    }
                ],
                schema=pa.schema(
                    [("part", pa.int32()), ("name", pa.string())]
                    + [(c, pa.int64()) for c in ("first", "last", "documents", "tokens", "bytes")]
                    + [("dictionary", pa.string())]
                ),
            )

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    placed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")


def _dictionary(source: fs.FileSystem, root: str, digest: str) -> bytes:
    with source.open_input_stream(f"{root}/dictionary") as file:
        data = file.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"{root}/dictionary is not the one its frames were made with")
    return data


def _index(source: fs.FileSystem, root: str, name: str) -> np.ndarray:
    with source.open_input_stream(f"{root}/shards/{name}.idx") as file:
        return np.frombuffer(file.read(), INDEX)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids) of all documents; ids are bytes as in the frames.

    ``start`` counts the ids of all documents before it. Shards are read by as many
    tasks, frame by frame.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # A row per shard: small next to the data, and the only thing that is summed in order.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select(
        "part", "name", "dictionary", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                table = _index(source, root, shard["name"])
                codec = _codec(_dictionary(source, root, shard["dictionary"]))
                press = zstandard.ZstdDecompressor(dict_data=codec)
                with source.open_input_stream(f"{root}/shards/{shard['name']}.tok") as file:
                    for begin in range(0, len(table), ROWS):
                        part = table[begin : begin + ROWS]
                        raw = [press.decompress(file.read(int(n))) for n in part["bytes"]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part["id"].copy(), pa.int64(), mask=part["null"] == 1),
                                pa.array((part["start"] + np.uint64(shard["base"])).astype(np.int64)),
                                pa.array(part["tokens"].astype(np.int64)),
                                pa.array(raw, pa.binary()),
                            ],
                            names=["id", "start", "n_tokens", "ids"],
                        )

    return shards.repartition("part").mapInArrow(run, "id bigint, start bigint, n_tokens bigint, ids binary")


def fetch(spark: SparkSession, folder: str, key: int) -> list[np.ndarray]:
    """The ids of one document (of all rows with its id), by the index alone."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    source, root = fs.FileSystem.from_uri(folder)
    found = []
    for shard in manifest.filter((F.col("first") <= key) & (F.col("last") >= key)).orderBy("part").collect():
        table = _index(source, root, shard["name"])
        codec = _codec(_dictionary(source, root, shard["dictionary"]))
        with source.open_input_file(f"{root}/shards/{shard['name']}.tok") as file:
            for row in table[(table["id"] == key) & (table["null"] == 0)]:
                frame = file.read_at(int(row["bytes"]), int(row["offset"]))
                raw = zstandard.ZstdDecompressor(dict_data=codec).decompress(frame)
                found.append(np.frombuffer(raw, "<u4"))
    return found
