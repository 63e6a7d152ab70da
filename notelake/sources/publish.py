"""Publications: a file for each document and arrays in order, written to a staging folder that one rename puts in place."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .layers import files, renamed

#: Bytes that are copied at a time when the parts of an array are put together.
CHUNK = 1 << 20


def _at(path: str) -> tuple[arrow.FileSystem, str]:
    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    return arrow.FileSystem.from_uri(uri)


@dataclass
class _Written(WriterCommitMessage):
    part: int
    names: list[str]
    size: int


class _Documents(DataSourceWriter):
    """Each row (path, document) becomes a file; a task that is run again writes the same files."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        fs, root = _at(self.path)
        names, size, folders = [], 0, set()
        for r in iterator:
            name = f"{root}/{r['path']}"
            folder = name.rpartition("/")[0]
            if folder not in folders:
                fs.create_dir(folder, recursive=True)
                folders.add(folder)
            data = r["document"].encode()
            with fs.open_output_stream(name) as out:
                out.write(data)
            size += len(data)
        return _Written(TaskContext.get().partitionId(), names, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _at(self.path)
        if fs.get_file_info(root).type != arrow.FileType.NotFound:
            fs.delete_dir(root)


class _Array(DataSourceWriter):
    """The documents of all rows as one JSON array, in the order of partitions and rows: each task writes its part, the commit puts them together."""

    def __init__(self, options: dict[str, str]):
        self.path, self.name, self.run = options["path"], options["array"], uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        fs, root = _at(self.path)
        context = TaskContext.get()
        name, n = f"{root}/.parts-{self.run}/{context.partitionId()}-{context.taskAttemptId()}", 0
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(name) as out:
            for r in iterator:
                out.write((",\n" if n else "").encode() + r["document"].encode())
                n += 1
        return _Written(context.partitionId(), [name] if n else [], n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _at(self.path)
        target = f"{root}/{self.name}"
        fs.create_dir(target.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(target) as out:
            out.write(b"[")
            parts = [name for m in sorted(messages, key=lambda m: m.part) for name in m.names]
            for k, name in enumerate(parts):
                out.write(b",\n" if k else b"\n")
                with fs.open_input_stream(name) as part:
                    while data := part.read(CHUNK):
                        out.write(data)
            out.write(b"\n]\n" if parts else b"]\n")
        self._clear(fs, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*_at(self.path))

    def _clear(self, fs: arrow.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/.parts-{self.run}").type != arrow.FileType.NotFound:
            fs.delete_dir(f"{root}/.parts-{self.run}")


class Documents(DataSource):
    """Sink of documents: a file for each row at `path`/its own path, or with the option `array` one file of all."""

    @classmethod
    def name(cls) -> str:
        return "notelake_documents"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return (_Array if "array" in self.options else _Documents)(self.options)


class Publication:
    """Files that are published together: `with Publication(spark, target) as p`, then documents, arrays and text.

    All go to a staging folder beside the target. At the end of the block it takes the target's place: what was there is moved
    aside, and the staging folder is renamed, so that a reader finds the old files or the new ones, whole; then the old ones go. If anything fails,
    or a writing task does, the staging folder goes and the target stays as it was. A publication that died between the two renames is put right by the next one.
    """

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.staging, self.aside = f"{self.target}.staging-{uuid.uuid4().hex}", f"{self.target}.previous"
        spark.dataSource.register(Documents)

    def __enter__(self) -> Publication:
        fs, aside = files(self.spark, self.aside)
        if fs.exists(aside):
            if fs.exists(files(self.spark, self.target)[1]):
                fs.delete(aside, True)
            else:
                renamed(self.spark, self.aside, self.target)
        fs.mkdirs(files(self.spark, self.staging)[1])
        return self

    def documents(self, rows: DataFrame) -> None:
        """A file for each row of (path, document)."""
        self._write(rows.select("path", "document"), {})

    def array(self, rows: DataFrame, order: list, name: str) -> None:
        """One file with the `document` of all rows as an array by `order`. Ranges of the order are sorted apart; no task sorts all."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._write(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("document"), {"array": name})

    def text(self, name: str, content: str) -> None:
        """A small file."""
        fs, at = files(self.spark, f"{self.staging}/{name}")
        out = fs.create(at, True)
        out.write(bytearray(content.encode()))
        out.close()

    def _write(self, rows: DataFrame, options: dict[str, str]) -> None:
        fs, at = files(self.spark, self.staging)
        rows.write.format(Documents.name()).mode("append").options(path=fs.makeQualified(at).toString(), **options).save()

    def __exit__(self, kind, error, trace) -> None:
        fs, staging = files(self.spark, self.staging)
        if kind is not None:
            fs.delete(staging, True)
            return
        target, aside = files(self.spark, self.target)[1], files(self.spark, self.aside)[1]
        if fs.exists(target):
            renamed(self.spark, self.target, self.aside)
        if not renamed(self.spark, self.staging, self.target):
            raise FileExistsError(f"{self.target} was published by another writer")
        if fs.exists(aside):
            fs.delete(aside, True)
