"""JSON lines in a folder for each source hash, written in transactions: a Python data source with commit messages.

A task writes files of its own, beside those that are there, and a table of the folders that it wrote or
emptied. Its message is the name of its attempt. The commit, on the driver, is one small file that names
the attempts: files of attempts that were killed or lost a race are named nowhere and don't count. Of a
folder the files of the last commit that wrote or emptied it count, so what a commit rewrites and what it
empties is seen at once, and until then all is as it was. Files that no commit wrote count in folders that
none has touched. ``fold`` puts the tables of all commits into one, ``vacuum`` removes files that don't count.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .files import opened

LOG = "_log"
_DONE, _FOLDED = ".done", ".all"
_LISTED = "hash string, folder string, token string, attempt string"
#: Characters that Spark escapes in names of partition folders (fixed values).
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


def folder(of: str) -> str:
    """The name of a hash's folder, as Spark's own writers have it."""
    return "hash=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in of)


@dataclass
class _Attempt(WriterCommitMessage):
    name: str


class JsonlFolders(DataSource):
    """Sink of (hash, line), in order of hash within a partition. A null line writes nothing, but its folder counts as written."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_folders"

    def schema(self) -> str:
        return "hash string, line string"

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options["token"])


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, token: str) -> None:
        self.path, self.token = path, token

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Attempt:
        """One file for each run of a hash; at most one is open."""
        system, root = opened(self.path)
        attempt = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        seen: dict[str, str] = {}
        current, out = None, None
        try:
            for batch in iterator:
                for of, line in zip(batch.column("hash").to_pylist(), batch.column("line").to_pylist(), strict=True):
                    seen.setdefault(of, folder(of))
                    if line is None:
                        continue
                    if out is None or of != current:
                        if out is not None:
                            out.close()
                        system.create_dir(f"{root}/{seen[of]}", recursive=True)
                        current, out = of, system.open_output_stream(f"{root}/{seen[of]}/{self.token}.{attempt}.jsonl")
                    out.write(line.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        listed = pa.table({"hash": list(seen), "folder": list(seen.values()), "token": [self.token] * len(seen), "attempt": [attempt] * len(seen)}, schema=pa.schema([(n, pa.string()) for n in ("hash", "folder", "token", "attempt")]))
        system.create_dir(f"{root}/{LOG}/{self.token}", recursive=True)
        with system.open_output_stream(f"{root}/{LOG}/{self.token}/{attempt}.parquet") as table:
            pq.write_table(listed, table)
        return _Attempt(attempt)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """A rename makes all visible. If another write was committed since this one began, none of this one is."""
        system, root = opened(self.path)
        number = self.token.partition("-")[0]
        system.create_dir(f"{root}/{LOG}", recursive=True)
        others = [f.base_name for f in system.get_file_info(fs.FileSelector(f"{root}/{LOG}")) if f.base_name.endswith((_DONE, _FOLDED)) and f.base_name >= number]
        if others:
            raise RuntimeError(f"another write was committed meanwhile: {others[0]}")
        made = f"{root}/{LOG}/.{self.token}"
        with system.open_output_stream(made) as out:
            out.write("".join(f"{m.name}\n" for m in messages if m is not None).encode())
        system.move(made, f"{root}/{LOG}/{self.token}{_DONE}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files stay where they are, named nowhere, until ``vacuum``."""
        system, root = opened(self.path)
        if system.get_file_info(f"{root}/{LOG}/{self.token}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{LOG}/{self.token}")


def _commits(path: str) -> tuple[str | None, list[str]]:
    """The last fold, and the commits after it."""
    system, root = opened(path)
    found = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(f"{root}/{LOG}", allow_not_found=True)))
    folded = max((n.removesuffix(_FOLDED) for n in found if n.endswith(_FOLDED)), default=None)
    return folded, [n.removesuffix(_DONE) for n in found if n.endswith(_DONE) and (folded is None or n.removesuffix(_DONE) > folded)]


def next_token(path: str) -> str:
    """Its order is that of commits."""
    folded, done = _commits(path)
    last = max([*done, *([folded] if folded else [])], default="0")
    return f"{int(last.partition('-')[0]) + 1:012d}-{uuid.uuid4().hex}"


def write_lines(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Commits rows (hash, line): their folders hold these lines afterwards and no others."""
    spark.dataSource.register(JsonlFolders)
    ordered = rows.select("hash", "line").hint("rebalance", F.col("hash")).sortWithinPartitions("hash")
    ordered.write.format("jsonl_folders").mode("append").option("token", next_token(path)).save(path)


def live(spark: SparkSession, path: str) -> DataFrame | None:
    """(hash, folder, token, attempt) of what counts in folders that commits have touched; None without commits."""
    folded, done = _commits(path)
    parts = [spark.read.schema(_LISTED).parquet(f"{path}/{LOG}/{folded}")] if folded else []
    if done:
        named = spark.read.text([f"{path}/{LOG}/{t}{_DONE}" for t in done]).select(F.regexp_replace("_metadata.file_name", r"\.done$", "").alias("token"), F.col("value").alias("attempt"))
        listed = spark.read.schema(_LISTED).parquet(*[f"{path}/{LOG}/{t}" for t in done if _listed(path, t)]) if any(_listed(path, t) for t in done) else None
        if listed is not None:
            parts.append(listed.join(named, ["token", "attempt"], "left_semi").select("hash", "folder", "token", "attempt"))
    if not parts:
        return None
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return every.join(every.groupBy("hash").agg(F.max("token").alias("token")), ["hash", "token"], "left_semi")


def _listed(path: str, token: str) -> bool:
    system, root = opened(path)
    return system.get_file_info(f"{root}/{LOG}/{token}").type == fs.FileType.Directory


def _mark(name: Column) -> Column:
    """Token and attempt of a file that a commit can have written, by its name; empty for others."""
    return F.regexp_extract(name, r"^([0-9]{12}-[0-9a-f]{32}\.[0-9]+-[0-9a-f]{32})\.jsonl$", 1)


def counting(rows: DataFrame, found: DataFrame | None, by: str, key: Column) -> DataFrame:
    """Rows of files that count, of ``rows`` with ``_metadata``; ``key`` is what the column ``by`` of ``found`` holds.

    One join on the key with the marks that count there: a few for each hash.
    """
    if found is None:
        return rows
    marks = found.groupBy(F.col(by).alias("_key")).agg(F.collect_set(F.concat_ws(".", "token", "attempt")).alias("_marks"))
    marked = rows.withColumns({"_key": key, "_mark": _mark(F.col("_metadata.file_name"))})
    kept = marked.join(marks, "_key", "left").where("if(_marks is null, _mark = '', array_contains(_marks, _mark))")
    return kept.drop("_key", "_mark", "_marks")


def folder_of(path: Column) -> Column:
    """The folder in a file's URI (``_metadata``'s are encoded once), as it is named."""
    return F.regexp_extract(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"(hash=[^/]*)/[^/]*$", 1)


def fold(spark: SparkSession, path: str) -> None:
    """One table of what counts, in place of those of all commits so far."""
    found = live(spark, path)
    if found is None:
        return
    token = next_token(path)
    found.write.parquet(f"{path}/{LOG}/{token}")
    system, root = opened(path)
    with system.open_output_stream(f"{root}/{LOG}/{token}{_FOLDED}"):
        pass


def vacuum(spark: SparkSession, path: str, older_than: float = 7 * 24 * 3600.0) -> int:
    """Folds the log, and removes what doesn't count and is ``older_than`` seconds old; how many data files. Tasks remove the files."""
    fold(spark, path)
    found = live(spark, path)
    if found is None:
        return 0
    before = time.time() - older_than
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.unix_timestamp("modificationTime").alias("at"), folder_of(F.col("_metadata.file_path")).alias("_key"), _mark(F.col("_metadata.file_name")).alias("_mark"))
    marks = found.groupBy(F.col("folder").alias("_key")).agg(F.collect_set(F.concat_ws(".", "token", "attempt")).alias("_marks"))
    stale = names.join(marks, "_key", "left").where(F.col("at") <= before).where("if(_marks is null, _mark <> '', not array_contains(_marks, _mark))")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("path").to_pylist():
                system, name = opened(at)
                if system.get_file_info(name).type == fs.FileType.File:
                    system.delete_file(name)
            yield batch

    removed = stale.select("path").mapInArrow(delete, "path string").count()
    folded, _ = _commits(path)
    system, root = opened(path)
    for info in system.get_file_info(fs.FileSelector(f"{root}/{LOG}")):
        if info.base_name.lstrip(".").split(".")[0] < (folded or "") and info.mtime.timestamp() <= before:
            (system.delete_dir if info.type == fs.FileType.Directory else system.delete_file)(info.path)
    return removed
