"""Texts of any size under dates, written in order by many tasks and read in slices.

A date's text lies in ``date=…/part-00000.txt``, ``part-00001.txt`` and so on; put together
they are the text, to the byte. Tasks write the pieces of their partition to a folder of
the attempt and report the bytes of each date. When all have, the commit sums the bytes up
to offsets, moves the parts to their names and lists them in ``date=…/_parts.json``, so a
date is replaced as a whole and a failed or repeated task leaves nothing behind.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "inkfold_ordered_text"
SCHEMA = "date string, offset bigint, text string"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # folder name that Spark, too, gives a missing value
LIST = "_parts.json"
SLICE = 32 << 20  # bytes a task reads
BLOCK = 1 << 20  # bytes of a row that is read

# Tasks get this code with them, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else path
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """Parts of one task: (date, file, bytes) each."""

    partition: int
    parts: list[tuple[str, str, int]]


class OrderedTextWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        fs, folder = file_system(f"{self.temporary}/{task.partitionId():07d}-{task.taskAttemptId()}")
        fs.create_dir(folder)
        parts: list[list] = []
        out = None
        try:
            for batch in iterator:
                for date, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    name = NO_DATE if date is None else str(date)
                    if not parts or parts[-1][0] != name:
                        if name in (p[0] for p in parts):
                            raise ValueError(f"pieces of {name} are not in order")
                        if out:
                            out.close()
                        out = fs.open_output_stream(f"{folder}/{name}.txt")
                        parts.append([name, f"{folder}/{name}.txt", 0])
                    raw = (text or "").encode()
                    out.write(raw)
                    parts[-1][2] += len(raw)
        finally:
            if out:
                out.close()
        return Written(task.partitionId(), [tuple(p) for p in parts])

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        dates: dict[str, list[tuple[str, int]]] = {}
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for date, file, size in message.parts:
                dates.setdefault(date, []).append((file, size))
        for date, files in dates.items():
            folder, offset, listed = f"{root}/date={date}", 0, []
            if fs.get_file_info(folder).type == pafs.FileType.Directory:
                fs.delete_dir(folder)
            fs.create_dir(folder)
            for i, (file, size) in enumerate(files):
                fs.move(file, f"{folder}/part-{i:05d}.txt")
                listed.append({"name": f"part-{i:05d}.txt", "offset": offset, "bytes": size})
                offset += size
            with fs.open_output_stream(f"{folder}/{LIST}") as out:
                out.write(json.dumps(listed).encode())
        self._clean()

    def abort(self, messages: list[Written | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        fs, folder = file_system(self.temporary)
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


@dataclass
class Slice(InputPartition):
    date: str
    file: str
    offset: int  # of the file in the text of its date
    start: int
    stop: int
    size: int


class OrderedTextReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[Slice]:
        fs, root = file_system(self.path)
        found = []
        for folder in fs.get_file_info(pafs.FileSelector(root)):
            if not folder.base_name.startswith("date="):
                continue
            with fs.open_input_stream(f"{folder.path}/{LIST}") as listed:
                for part in json.loads(listed.read()):
                    for start in range(0, part["bytes"], SLICE):
                        found.append(
                            Slice(
                                folder.base_name.removeprefix("date="), f"{folder.path}/{part['name']}",
                                part["offset"], start, min(start + SLICE, part["bytes"]), part["bytes"],
                            )
                        )
        return found

    def read(self, partition: Slice) -> Iterator[tuple]:
        """Blocks of whole characters; one that begins in front of an edge belongs there."""
        fs, _ = file_system(self.path)
        date = None if partition.date == NO_DATE else partition.date
        with fs.open_input_file(partition.file) as file:
            def edge(at: int) -> int:
                """The next beginning of a character."""
                if at <= 0 or at >= partition.size:
                    return at
                file.seek(at)
                for i, byte in enumerate(file.read(4)):
                    if byte & 0xC0 != 0x80:
                        return at + i
                return partition.size

            begin, last = edge(partition.start), edge(partition.stop)
            while begin < last:
                end = min(edge(min(begin + BLOCK, last)), last)
                file.seek(begin)
                yield date, partition.offset + begin, file.read(end - begin).decode()
                begin = end


class OrderedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> OrderedTextWriter:
        return OrderedTextWriter(self.options["path"])

    def reader(self, schema: StructType) -> OrderedTextReader:
        return OrderedTextReader(self.options["path"])


def write_ordered_text(texts: DataFrame, path: str) -> None:
    """Write ``date, text`` pieces, in order over their partitions; each date is replaced."""
    texts.sparkSession.dataSource.register(OrderedText)
    (
        texts.selectExpr("cast(date as string) as date", "text")
        .write.format(FORMAT)
        .mode("append")
        .save(path)
    )


def scan_ordered_text(spark: SparkSession, path: str) -> DataFrame:
    """``date, offset, text``: the stored texts in blocks of about a megabyte."""
    spark.dataSource.register(OrderedText)
    return spark.read.format(FORMAT).load(path).selectExpr("cast(date as date) as date", "offset", "text")
