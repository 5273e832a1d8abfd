"""The ``zip_lines`` data source: one row per line of every archive member.

Each member is read by a task of its own, as a stream, in Arrow batches. The
members of an archive cannot be split further, so their number bounds the
parallelism of the scan (not of what follows it).

Where Arrow knows the file system, members are streamed by the data source. All
other file systems of Spark are read through ``binaryFile``: a task holds an
archive then, which may have 2 GB at most.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO, TextIOWrapper
from zipfile import ZIP_DEFLATED, ZipFile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from earshot.operators.sizing import listed, qualified

SCHEMA = "archive string, member int, name string, line bigint, value string"
ARROW_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.int32()),
        ("name", pa.string()),
        ("line", pa.int64()),
        ("value", pa.string()),
    ]
)
BATCH_BYTES = 1 << 20
"""Bytes of text read at once; short lines take several times as much as Python texts."""


@dataclass
class Member(InputPartition):
    archive: str
    index: int
    name: str

    def __init__(self, archive: str, index: int, name: str):
        self.archive, self.index, self.name = archive, index, name


# Arrow's names for schemes that Spark knows under another one.
ARROW_SCHEMES = {"s3a:": "s3:", "s3n:": "s3:"}


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path, and the path on it; plain paths are local."""
    scheme, colon, rest = uri.partition(":")
    uri = ARROW_SCHEMES.get(scheme + colon, scheme + colon) + rest
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _open(uri: str) -> pa.NativeFile:
    system, path = _system(uri)
    return system.open_input_file(path)


def arrow_knows(uri: str) -> bool:
    """Whether Arrow has a driver for the path's scheme."""
    try:
        _system(uri)
    except (pa.ArrowException, OSError, NotImplementedError):
        return False
    return True


def _members(archive: ZipFile) -> list[str]:
    return [info.filename for info in archive.infolist() if not info.is_dir()]


def _lines(archive: ZipFile, path: str, index: int, name: str) -> Iterator[pa.RecordBatch]:
    """The lines of one member in batches."""
    with archive.open(name) as member, TextIOWrapper(member, encoding="utf-8") as text:
        number = 0
        while lines := text.readlines(BATCH_BYTES):
            count = len(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(path, pa.string()), count),
                    pa.repeat(pa.scalar(index, pa.int32()), count),
                    pa.repeat(pa.scalar(name, pa.string()), count),
                    pa.array(np.arange(number, number + count)),
                    pc.utf8_rtrim(pa.array(lines, pa.string()), "\n"),
                ],
                schema=ARROW_SCHEMA,
            )
            number += count


class ZipLinesReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        # reads the directories of the archives, not their content
        found = []
        for path in self.paths:
            with _open(path) as file, ZipFile(file) as archive:
                found += [Member(path, i, name) for i, name in enumerate(_members(archive))]
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        with _open(partition.archive) as file, ZipFile(file) as archive:
            yield from _lines(archive, partition.archive, partition.index, partition.name)


def _whole_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            with ZipFile(BytesIO(content.as_py())) as archive:
                for i, name in enumerate(_members(archive)):
                    yield from _lines(archive, path.as_py(), i, name)


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the archives at a path, which may be a glob pattern, on any file system of Spark."""
    place = qualified(spark, path)
    if not arrow_knows(place):
        return spark.read.format("binaryFile").load(place).select("path", "content").mapInArrow(_whole_archives, SCHEMA)
    spark.dataSource.register(ZipLines)
    paths = listed(spark, place) or [place]
    return spark.read.format("zip_lines").option("archives", json.dumps(paths)).load()


def write_archives(lines: DataFrame, folder: str) -> None:
    """Write the texts of ``value`` as lines of archives, one streamed by each task.

    The folder is on a file system that Arrow knows. A task that runs again
    writes the same file anew; a null is an empty line.
    """
    place = qualified(lines.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(place)
        system.create_dir(root, recursive=True)
        path = f"{root}/part-{TaskContext.get().partitionId():06d}.zip"
        with system.open_output_stream(path) as file, ZipFile(file, "w", ZIP_DEFLATED) as archive:
            with archive.open("lines.txt", "w", force_zip64=True) as member:
                for batch in batches:
                    for value in batch.column("value"):
                        member.write(f"{value.as_py() or ''}\n".encode())
        yield pa.RecordBatch.from_pydict({"path": pa.array([path])})

    lines.select("value").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


class ZipLines(DataSource):
    """``spark.read.format("zip_lines").load(path)``, or a JSON list of paths in the option ``archives``."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipLinesReader:
        archives = self.options.get("archives")
        return ZipLinesReader(json.loads(archives) if archives else [self.options["path"]])
