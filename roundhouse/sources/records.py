"""Annotation records as a data source: one JSON file per video, replaced whole when it is written again.

    spark.dataSource.register(AnnotationRecords)
    records.write.format("annotation_records").mode("append").save(path)          # video_name, record (JSON)
    spark.read.format("annotation_records").load(path).where("video_name = 'a'")  # reads that video's file alone

Files lie in folders that follow from a hash of the video's name, so a task lists and reads one folder, and a filter on names
prunes folders and files. Tasks write under a folder of their own; only when all have ended do their files move to their
places, a rename each, so a failed or stopped run changes nothing and a reader sees an old or a new record, never half of
one. mode("overwrite") also deletes the videos that weren't written. Of several records of one video in a run, one stays.
Paths are those of all machines: local or shared folders, or addresses that pyarrow.fs knows. Rows without a name, or with
a null record, aren't written.

option("compression", "gzip") compresses the records of a run that get shorter by it. Names stay the same, so a rename still
replaces a record that was written in the other way, and a reader tells both by their first bytes.
"""

from __future__ import annotations

import gzip
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FOLDERS = 64
ENDING = "_annotations.json"
_SCHEMA = "video_name string, record string"
_STAGED = "_writing-"
#: Records that a reader hands over at a time.
BATCH = 256
#: How a compressed record begins; no JSON text does.
_GZIP = b"\x1f\x8b"


def packed(record: str, compression: str) -> bytes:
    text = record.encode()
    return min(text, gzip.compress(text, mtime=0), key=len) if compression == "gzip" else text


def unpacked(data: bytes) -> str:
    return (gzip.decompress(data) if data.startswith(_GZIP) else data).decode()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), urllib.parse.urlparse(path).path
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def place_of(video: str) -> str:
    """A video's file under the path; the name is quoted, so that any text is one."""
    return f"part={zlib.crc32(video.encode()) % FOLDERS:02d}/{urllib.parse.quote(video, safe=' ')}{ENDING}"


def files_in(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [x for x in found if x.type == fs.FileType.File and x.base_name.endswith(ENDING)]


@dataclass
class Folder(InputPartition):
    """One folder to read: all of its videos, or the named ones."""

    number: int
    videos: tuple[str, ...] | None


@dataclass
class Staged(WriterCommitMessage):
    """Where a task has written its files, and how many."""

    folder: str
    files: int


class RecordReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.videos = path, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("video_name",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.videos = wanted if self.videos is None else self.videos & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.videos is None:
            return [Folder(k, None) for k in range(FOLDERS)]
        by_folder: dict[int, list[str]] = {}
        for video in sorted(x for x in self.videos if x is not None):
            by_folder.setdefault(zlib.crc32(video.encode()) % FOLDERS, []).append(video)
        return [Folder(k, tuple(x)) for k, x in by_folder.items()] or [Folder(0, ())]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, base = opened(self.path)
        if partition.videos is None:
            paths = [x.path for x in files_in(store, f"{base}/part={partition.number:02d}")]
        else:
            paths = [x.path for x in store.get_file_info([f"{base}/{place_of(v)}" for v in partition.videos]) if x.type == fs.FileType.File]
        for at in range(0, len(paths), BATCH):
            names, texts = [], []
            for path in paths[at : at + BATCH]:
                with store.open_input_stream(path) as f:
                    texts.append(unpacked(f.read()))
                names.append(urllib.parse.unquote(path.rsplit("/", 1)[1][: -len(ENDING)]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["video_name", "record"])


class RecordWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, compression: str = "none"):
        if compression not in ("none", "gzip"):
            raise ValueError(f"compression is none or gzip, not {compression}")
        self.path, self.overwrite, self.compression, self.run = path, overwrite, compression, f"{_STAGED}{uuid.uuid4().hex}"

    def write(self, iterator) -> Staged:
        store, base = opened(self.path)
        folder, files, made = f"{base}/{self.run}/{uuid.uuid4().hex}", 0, set()
        for row in iterator:
            if row["video_name"] is None or row["record"] is None:
                continue
            path = f"{folder}/{place_of(row['video_name'])}"
            if (part := path.rsplit("/", 1)[0]) not in made:  # a folder once, not once per record
                store.create_dir(part, recursive=True)
                made.add(part)
            with store.open_output_stream(path) as f:
                f.write(packed(row["record"], self.compression))
            files += 1
        return Staged(folder, files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, base = opened(self.path)
        written: set[str] = set()
        for task in messages:
            if not task or not task.files:  # a failed attempt's folder isn't among them
                continue
            for part in store.get_file_info(fs.FileSelector(task.folder)):
                store.create_dir(f"{base}/{part.base_name}", recursive=True)
                for x in files_in(store, part.path):
                    store.move(x.path, f"{base}/{part.base_name}/{x.base_name}")
                    if self.overwrite:
                        written.add(f"{part.base_name}/{x.base_name}")
        if self.overwrite:
            for part in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if part.type == fs.FileType.Directory and part.base_name.startswith("part="):
                    for x in files_in(store, part.path):
                        if f"{part.base_name}/{x.base_name}" not in written:
                            store.delete_file(x.path)
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        store, base = opened(self.path)
        if store.get_file_info(f"{base}/{self.run}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.run}")


class AnnotationRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "annotation_records"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return RecordReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return RecordWriter(self.options["path"], overwrite, self.options.get("compression", "none").lower())


def use_records(spark: SparkSession) -> None:
    """Register the source in a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(AnnotationRecords)
