"""Text documents packed into few files, with their paths: tar archives of about equal size.

A corpus of one small file per article costs a request and a listing entry each. Here every
task writes its documents into archives of its own and begins the next one at a size, so an
archive is a unit of work for a reader. The usual tools unpack them into the one-file layout.
Archives are written to a folder of the attempt; the commit moves those of the tasks that
count and lists them under the name of the batch, so a failed or repeated task leaves nothing
behind and a batch that runs again replaces its own archives. Of the same path in several
batches the last one counts (``scan_packed``).
"""

from __future__ import annotations

import io
import json
import sys
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from inkfold.session import stored
from inkfold.sources import ordered_text
from inkfold.sources.ordered_text import file_system

FORMAT = "inkfold_packed_documents"
SCHEMA = "path string, raw string, batch bigint"
ARCHIVE = 128 << 20  # bytes from which a task begins another archive

# Tasks get this code with them, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(ordered_text)


@dataclass
class Packed(WriterCommitMessage):
    partition: int
    archives: list[str]


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: int, size: int):
        self.path, self.batch, self.size = path.rstrip("/"), batch, size
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Packed:
        task = TaskContext.get()
        fs, folder = file_system(f"{self.temporary}/{task.partitionId():07d}-{task.taskAttemptId()}")
        fs.create_dir(folder)
        names: list[str] = []
        archive = out = None
        written = 0
        try:
            for batch in iterator:
                for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if archive is None or written >= self.size:
                        if archive:
                            archive.close()
                            out.close()
                        names.append(f"{folder}/{len(names):05d}.tar")
                        out = fs.open_output_stream(names[-1])
                        archive = tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT)
                        written = 0
                    data = (raw or "").encode()
                    entry = tarfile.TarInfo(path)
                    entry.size = len(data)
                    archive.addfile(entry, io.BytesIO(data))
                    written += len(data)
        finally:
            if archive:
                archive.close()
                out.close()
        return Packed(task.partitionId(), names)

    def commit(self, messages: list[Packed | None]) -> None:
        fs, root = file_system(self.path)
        folder = f"{root}/batch={self.batch}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)
        fs.create_dir(folder)
        listed = []
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for file in message.archives:
                listed.append(f"{message.partition:07d}-{file.rsplit('/', 1)[1]}")
                fs.move(file, f"{folder}/{listed[-1]}")
        with fs.open_output_stream(f"{folder}/_archives.json") as out:
            out.write(json.dumps(listed).encode())
        self._clean()

    def abort(self, messages: list[Packed | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        fs, folder = file_system(self.temporary)
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


@dataclass
class Archive(InputPartition):
    batch: int
    file: str


def batch_folders(path: str) -> list[tuple[int, str]]:
    """The stored batches and their folders."""
    fs, root = file_system(path.rstrip("/"))
    return [
        (int(folder.base_name.removeprefix("batch=")), folder.path)
        for folder in fs.get_file_info(pafs.FileSelector(root))
        if folder.base_name.startswith("batch=")
    ]


class PackedReader(DataSourceReader):
    def __init__(self, path: str, after: int | None):
        self.path, self.after = path, after

    def partitions(self) -> list[Archive]:
        fs, _ = file_system(self.path)
        found = []
        for batch, folder in batch_folders(self.path):
            if self.after is None or batch > self.after:
                with fs.open_input_stream(f"{folder}/_archives.json") as listed:
                    found += [Archive(batch, f"{folder}/{name}") for name in json.loads(listed.read())]
        return found

    def read(self, partition: Archive) -> Iterator[tuple]:
        fs, _ = file_system(self.path)
        with fs.open_input_stream(partition.file) as file:
            with tarfile.open(fileobj=file, mode="r|") as archive:
                for entry in archive:
                    if entry.isfile():
                        yield entry.name, archive.extractfile(entry).read().decode(), partition.batch


class PackedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> PackedWriter:
        size = int(self.options.get("archiveBytes", ARCHIVE))
        return PackedWriter(self.options["path"], int(self.options["batch"]), size)

    def reader(self, schema: StructType) -> PackedReader:
        after = self.options.get("after")
        return PackedReader(self.options["path"], None if after is None else int(after))


def write_packed(documents: DataFrame, path: str, batch: int, archive_bytes: int = ARCHIVE) -> None:
    """Store ``path, raw`` documents as the archives of a batch; nothing is shuffled."""
    documents.sparkSession.dataSource.register(PackedDocuments)
    (
        documents.select("path", "raw")
        .write.format(FORMAT)
        .option("batch", batch)
        .option("archiveBytes", archive_bytes)
        .mode("append")
        .save(path)
    )


def scan_packed(spark: SparkSession, path: str) -> DataFrame:
    """``path, raw`` of all stored documents, of each path as the last batch left it.

    The first batch cannot have replaced anything, so its archives are read once; the paths
    of the others are stored and meet the documents in an anti join, where texts move only
    if those paths are too many to send around.
    """
    spark.dataSource.register(PackedDocuments)
    reader = spark.read.format(FORMAT)
    documents = reader.load(path)
    batches = sorted(batch for batch, _ in batch_folders(path))
    if len(batches) < 2:
        return documents.select("path", "raw")
    later = reader.option("after", batches[0]).load(path)
    newer = stored(
        later.groupBy(F.col("path").alias("_path")).agg(F.max("batch").alias("_latest")), "replaced"
    )
    stale = (F.col("path") == F.col("_path")) & (F.col("batch") < F.col("_latest"))
    return documents.join(newer, stale, "left_anti").select("path", "raw")
