"""Zip archives of many small text files, as a data source: one archive is one partition, read entry by entry.

A folder of a million small files costs a listing and an open call each; packed into archives it costs as many tasks
as there are archives. Folders must be mounted alike on driver and executors; archives in other stores are fetched by
Spark's own reader (`scan_text_archives`).
"""

from __future__ import annotations

import io
import os
import sys
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "document string, full_text string"
BATCH_CHARS = 4_000_000  # of text handed over at once

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package


def local_path(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def entries(archive: zipfile.ZipFile, suffix: str) -> Iterator[tuple[str, str]]:
    """(name, text) of the entries with the suffix; a folder's name is not part of it. Malformed bytes become U+FFFD."""
    for info in archive.infolist():
        if not info.is_dir() and info.filename.endswith(suffix):
            yield info.filename.rsplit("/", 1)[-1], archive.read(info).decode("utf-8", "replace")


def batched(rows: Iterator[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], pa.string()) for i in (0, 1)], ["document", "full_text"])

    for row in rows:
        held.append(row)
        chars += len(row[1])
        if chars >= BATCH_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class ZipTexts(DataSource):
    """`spark.read.format("zip_texts").load(folder)`; option suffix (.txt). Writing makes one archive for each task."""

    @classmethod
    def name(cls) -> str:
        return "zip_texts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(local_path(self.options["path"]), self.options.get("suffix", ".txt"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ZipWriter(local_path(self.options["path"]))


class ZipReader(DataSourceReader):
    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix = folder, suffix

    def partitions(self) -> list[Archive]:
        if os.path.isfile(self.folder):
            return [Archive(self.folder)]
        found = [os.path.join(d, f) for d, _, files in os.walk(self.folder) for f in files if f.endswith(".zip")]
        return [Archive(p) for p in sorted(found)] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if partition.path:
            with zipfile.ZipFile(partition.path) as archive:
                yield from batched(entries(archive, self.suffix))


class ZipWriter(DataSourceWriter):
    """A task writes a file that no reader takes; the ones that the job accepts are given their names at the end."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows) -> Written:
        os.makedirs(self.folder, exist_ok=True)
        path, n = os.path.join(self.folder, f"part-{uuid.uuid4().hex}.zip"), 0
        with zipfile.ZipFile(f"{path}.open", "w", zipfile.ZIP_DEFLATED) as archive:
            for n, row in enumerate(rows, 1):
                archive.writestr(row["document"], row["full_text"] or "")
        return Written(path if n else None)

    def commit(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and m.path:
                os.replace(f"{m.path}.open", m.path)

    def abort(self, messages: list[Written | None]) -> None:
        """Leftovers carry a name that is never read."""


def write_text_archives(df: DataFrame, folder: str) -> None:
    """df: document, full_text (null: empty). One archive for each partition that has rows."""
    df.sparkSession.dataSource.register(ZipTexts)
    df.select("document", "full_text").write.format("zip_texts").mode("append").save(folder)


def scan_text_archives(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """(document, full_text) of all text files in the zip archives below a folder; one archive is one task's."""
    if "://" not in folder.removeprefix("file://"):
        spark.dataSource.register(ZipTexts)
        return spark.read.format("zip_texts").option("suffix", suffix).load(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(folder)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    yield from batched(entries(archive, suffix))

    return files.select(F.col("content")).mapInArrow(unpack, SCHEMA)
