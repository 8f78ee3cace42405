"""Exactly the files that a table of paths names: a data source whose partitions are parts of that table.

Nothing is listed, and no file is opened that isn't named, however many lie beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Paths of a part of the table, which is one task's.
PART = 500
#: Names that Spark's own reader gets at a time, where the file system is one that only Spark opens.
_NAMES = 10_000
_OPENED = ("", "file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    scheme, sign, rest = path.partition(":")
    if not sign or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri("s3" + path[3:] if scheme == "s3a" else path)


@dataclass
class Part(InputPartition):
    """A row group of a file of the table of paths."""

    file: str
    group: int


class WantedFiles(DataSource):
    """``load(table)``: (path, content) of the files that the Parquet table's column ``path`` names; content is null where there is none.

    With the option ``look`` contents aren't read: those of files that are there are empty.
    """

    @classmethod
    def name(cls) -> str:
        return "wanted_files"

    def schema(self) -> str:
        return "path string, content binary"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("look", "false").lower() == "true")


class _Reader(DataSourceReader):
    def __init__(self, table: str, look: bool) -> None:
        self.table, self.look = table, look

    def partitions(self) -> list[Part]:
        """Row groups by the footers of the table's files: what comes to the driver is their number, not the paths."""
        system, root = opened(self.table)
        found = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet")]
        parts = []
        for file in sorted(found):
            with system.open_input_file(file) as source:
                parts += [Part(file, g) for g in range(pq.ParquetFile(source).num_row_groups)]
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.table)
        with system.open_input_file(partition.file) as source:
            paths = pq.ParquetFile(source).read_row_group(partition.group, ["path"]).column("path").to_pylist()
        for path in paths:
            of, at = opened(path)
            there = of.get_file_info(at).type == fs.FileType.File
            content = None
            if there:
                content = b""
                if not self.look:
                    with of.open_input_stream(at) as source:
                        content = source.read()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.binary())], names=["path", "content"])


def read_wanted(spark: SparkSession, paths: DataFrame, staged: str) -> tuple[DataFrame, DataFrame]:
    """(files as (path, content), missing as (path)) of a table (path). ``staged`` is a new folder for the table, to be removed when both are used.

    Paths are dealt evenly, ``PART`` to a task; a task holds one file at a time. Paths that repeat are taken once.
    """
    wanted = paths.where("path is not null").select("path").distinct()
    count = wanted.count()
    wanted.repartition(max(1, -(-count // PART))).write.parquet(staged)
    table = spark.read.schema("path string").parquet(staged)
    first = table.limit(1).collect()
    if not first:
        return spark.createDataFrame([], "path string, content binary"), table
    scheme = first[0][0].partition(":")[0] if "://" in first[0][0] or first[0][0].startswith("file:") else ""
    if scheme not in _OPENED:
        return _by_names(spark, table)
    spark.dataSource.register(WantedFiles)
    source = spark.read.format("wanted_files")
    return source.load(staged).where("content is not null"), source.option("look", "true").load(staged).where("content is null").select("path")


def _by_names(spark: SparkSession, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same through Spark's reader, which takes names: a block of them at a time is on the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf, files, there, block = spark._jsc.hadoopConfiguration(), spark.createDataFrame([], "path string, content binary"), spark.createDataFrame([], "path string"), []

    def take() -> None:
        nonlocal files, there
        named, empty = [], []
        for p in block:
            at = path(p)
            system = at.getFileSystem(conf)
            if system.exists(at):  # the reader gives no row for an empty file
                (named if system.getFileStatus(at).getLen() else empty).append((p, system.makeQualified(at).toString()))
        if named:
            quoted = [p.translate({ord(c): f"\\{c}" for c in "[]{}*?\\"}) for p, _ in named]
            real = spark.createDataFrame(named, "path string, real string")
            read = spark.read.format("binaryFile").load(quoted).select(F.col("path").alias("real"), "content")
            files = files.unionByName(real.join(read, "real").select("path", "content"))
        if empty:
            files = files.unionByName(spark.createDataFrame([(p, b"") for p, _ in empty], "path string, content binary"))
        if named or empty:
            there = there.union(spark.createDataFrame([(p,) for p, _ in named + empty], "path string"))
        block.clear()

    for row in table.toLocalIterator():
        block.append(row["path"])
        if len(block) == _NAMES:
            take()
    take()
    return files, table.join(there, "path", "left_anti")
