"""Archives of raw pages: large record-framed files that are split, appended to and streamed.

A file starts with a mark of the format and 16 random bytes of its own. Each record repeats those
bytes, then gives the length and checksum of its payload, a deflated JSON object of the row's
columns. So a task can start at any byte: it looks for the next mark and reads the records that
begin in its own stretch. Compressed pages are split this way too, and one large file serves
many tasks, where a file for each page costs a listing and a task each.

    register(spark)
    pages.write.format("page_archive").mode("append").save("/lake/raw")
    spark.read.format("page_archive").load("/lake/raw")
    spark.readStream.format("page_archive").load("/lake/raw")     # follows files that grow

The stream's offset is the byte reached in each file, so what a crawler appends to an archive is
read without a new file; the offset log grows with the number of files, not of pages. A record
that is only half written is not there yet, in batch and in streams. Tasks write to a folder aside;
committing moves the files of the attempts that won, so lost executors leave no rows behind.

Cases: null cells and empty texts come back as they were; a column that a record lacks is null, one that
is not asked for is skipped; an empty table writes no file; a folder without archives, or none at all, has
no rows; bytes that do not match their checksum, or a gap between records, fail with file and byte.
Columns are strings, booleans, whole or floating numbers; others have to be cast first. Folders are
reached through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition,
    WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT, SUFFIX = "page_archive", ".pages"
MAGIC, MARK = b"PGA1", 16
HEAD = len(MAGIC) + MARK
LENGTHS = struct.Struct("<QI")  # bytes of the payload, its checksum
FRAME = MARK + LENGTHS.size
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
LISTERS = 16


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder there."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


class Archive:
    """Appends rows to one open file."""

    def __init__(self, sink: pa.NativeFile, mark: bytes | None = None):
        self.sink, self.mark = sink, mark or os.urandom(MARK)
        if mark is None:
            sink.write(MAGIC + self.mark)

    def add(self, row: dict) -> None:
        payload = zlib.compress(json.dumps(row, ensure_ascii=False).encode())
        self.sink.write(self.mark + LENGTHS.pack(len(payload), zlib.crc32(payload)) + payload)


def mark_of(source: pa.NativeFile, name: str) -> bytes:
    source.seek(0)
    head = source.read(HEAD)
    if len(head) < HEAD or not head.startswith(MAGIC):
        raise ValueError(f"{name} is not a page archive")
    return head[len(MAGIC):]


def whole_end(source: pa.NativeFile, mark: bytes, size: int) -> int:
    """Where the last whole record ends; only the last records are looked at."""
    back = 1 << 16
    while True:
        start = max(HEAD, size - back)
        source.seek(start)
        tail = source.read(size - start)
        at = tail.rfind(mark)
        if at >= 0:
            if at + FRAME <= len(tail):
                end = at + FRAME + LENGTHS.unpack_from(tail, at + MARK)[0]
                if end <= len(tail):
                    return start + end
            return start + at
        if start == HEAD:
            return HEAD
        back *= 4


def first_mark(source: pa.NativeFile, mark: bytes, start: int, end: int) -> int:
    """The first record that begins in [start, end); `end` if there is none."""
    at, kept = start, b""
    while at < end + MARK:
        source.seek(at)
        block = source.read(min(1 << 20, end + MARK - at))
        if not block:
            break
        found = (kept + block).find(mark)
        if found >= 0:
            return min(end, at - len(kept) + found)
        kept = (kept + block)[-(MARK - 1):]
        at += len(block)
    return end


@dataclass
class Stretch(InputPartition):
    """The records of a file that begin in [start, end)."""
    file: str
    start: int
    end: int


def payloads(files: fs.FileSystem, part: Stretch) -> Iterator[bytes]:
    with files.open_input_file(part.file) as source:
        mark = mark_of(source, part.file)
        at = first_mark(source, mark, part.start, part.end)
        source.seek(at)
        stream = pa.BufferedInputStream(source, 1 << 20)
        while at < part.end:
            frame = stream.read(FRAME)
            if len(frame) < FRAME or not frame.startswith(mark):
                raise ValueError(f"{part.file}: no record at byte {at}")
            length, check = LENGTHS.unpack_from(frame, MARK)
            payload = stream.read(length)
            if len(payload) < length or zlib.crc32(payload) != check:
                raise ValueError(f"{part.file}: record at byte {at} is damaged")
            yield payload
            at += FRAME + length


def record_batches(rows: Iterator[bytes], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of about BATCH_BYTES of text."""
    def batch(own: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(f.name) for r in own], f.type) for f in schema], schema=schema)

    own, size = [], 0
    for payload in rows:
        text = zlib.decompress(payload)
        own.append(json.loads(text))
        size += len(text)
        if size >= BATCH_BYTES:
            yield batch(own)
            own, size = [], 0
    if own:
        yield batch(own)


class _Reader:
    """What batch and stream share: ends of files, stretches and their rows."""

    def __init__(self, schema: StructType, options: dict):
        self.path, self.kind = options["path"], to_arrow_schema(schema)
        self.split = max(1, int(options.get("split_bytes", SPLIT_BYTES)))

    def ends(self) -> dict[str, int]:
        """The end of the last whole record by file."""
        files, folder = place(self.path)
        listed = [i for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                  if i.type == fs.FileType.File and i.path.endswith(SUFFIX) and i.size >= HEAD]

        def end(info: fs.FileInfo) -> int:
            with files.open_input_file(info.path) as source:
                return whole_end(source, mark_of(source, info.path), info.size)
        with ThreadPoolExecutor(LISTERS) as pool:
            return dict(zip([i.path for i in listed], pool.map(end, listed)))

    def stretches(self, start: dict[str, int], end: dict[str, int]) -> list[Stretch]:
        return [Stretch(file, at, min(at + self.split, last)) for file, last in sorted(end.items())
                for at in range(max(HEAD, start.get(file, HEAD)), last, self.split)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return record_batches(payloads(place(self.path)[0], partition), self.kind)


class ArchiveReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Stretch]:
        return self.stretches({}, self.ends())

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition is None else super().read(partition)


class ArchiveStream(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return self.stretches(start, end)


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.aside = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = place(self.path)
        name, sink = uuid.uuid4().hex + SUFFIX, None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if sink is None:
                        files.create_dir(f"{folder}/{self.aside}")
                        sink = files.open_output_stream(f"{folder}/{self.aside}/{name}")
                        archive = Archive(sink)
                    archive.add(row)
        finally:
            if sink is not None:
                sink.close()
        return Written(None if sink is None else name)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = place(self.path)
        files.create_dir(folder)
        old = [i.path for i in files.get_file_info(fs.FileSelector(folder)) if i.path.endswith(SUFFIX)]
        for message in messages:
            if message is not None and message.file:
                files.move(f"{folder}/{self.aside}/{message.file}", f"{folder}/{message.file}")
        for path in old if self.overwrite else []:
            files.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = place(self.path)
        if files.get_file_info(f"{folder}/{self.aside}").type == fs.FileType.Directory:
            files.delete_dir(f"{folder}/{self.aside}")


class PageArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "page_id long, url string, html string"

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(schema, self.options)

    def streamReader(self, schema: StructType) -> ArchiveStream:
        return ArchiveStream(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(PageArchive)
