"""The store of enriched chunks: a log of committed versions on plain Parquet, and the JSONL layout.

A version holds new rows and the keys whose older rows it replaces or deletes. Its number is claimed by
creating a file that must not be there, so two writers never share one. It counts once its commit marker
is created, the last thing done, so readers see a version whole or not at all, and a write costs what it
brings, not what is there. What a version holds stands in the marker's name: a listing is all that a
reader needs before its scan. ``compact`` folds the log into one version, on its own after
``COMPACT_AFTER`` of them; ``vacuum`` removes what was folded.

Rows lie in files by document, and each version has an index of its files: the range of their keys and
blocked Bloom filters. A lookup by document or by hash tests the index and opens the files that can
hold the key.
"""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from dataclasses import dataclass
from typing import Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import ENRICHED, REQUIRED
from . import jsonl_log
from .manifest import exists

_ROWS, _KEYS, _CLAIM, _INDEX = "rows", "keys", "claim", "index"
#: Columns that lookups go by.
INDEXED = ("document_id", "source_hash")
#: A Bloom filter is blocks of so many bits (what one bitmap of Spark holds), for so many keys each on average, of so many bits.
_BLOCK_BITS, _BLOCK_KEYS, _KEY_BITS = 32_768, 2_500, 6
#: A marker: rows or not, document keys or not, chunk keys or not, and the version up to which it holds all, or 0.
_MARK = re.compile(r"done-r([01])-d([01])-c([01])-w([0-9]+)")
#: A folder of a flat table: its number, and a name of its own.
_FLAT = re.compile(r"v([0-9]+)-[0-9a-f]{32}")
#: Versions beyond the last whole one after which a write compacts the log.
COMPACT_AFTER = 32


def file_index(rows: DataFrame) -> DataFrame:
    """(file, column, low, high, blocks, block, bits): for each file of ``rows`` and indexed column the range of its keys, and its filter blocks.

    Sizes and bits are partial aggregates; what moves is a row per file and distinct key, and a bitmap per block.
    """
    placed = rows.select(F.col("_metadata.file_path").alias("file"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("key")) for c in INDEXED])).alias("e"))
    keys = placed.select("file", "e.*").where(F.col("key").isNotNull()).distinct()
    ranges = keys.groupBy("file", "column").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.ceil(F.count("*") / _BLOCK_KEYS).cast("int").alias("blocks"))
    marked = keys.join(ranges, ["file", "column"]).select("file", "column", _block_of(F.col("key"), F.col("blocks")).alias("block"), F.explode(F.array(*_bits_of(F.col("key")))).alias("bit"))
    return marked.groupBy("file", "column", "block").agg(F.bitmap_construct_agg("bit").alias("bits")).join(ranges, ["file", "column"])


def _block_of(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def _bits_of(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(n)), F.lit(_BLOCK_BITS)).cast("long") for n in range(1, _KEY_BITS + 1)]


def can_hold(column: str, value: str) -> Column:
    """Whether a row of a file index says that its file can hold ``value``."""
    key = F.lit(value)
    found = (F.col("column") == column) & (F.col("low") <= key) & (F.col("high") >= key) & (F.col("block") == _block_of(key, F.col("blocks")))
    for bit in _bits_of(key):
        byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        found = found & (F.getbit(byte, bit % 8) == 1)
    return found


class Store(Protocol):
    """Where chunks are kept: one commit replaces and deletes."""

    def read(self) -> DataFrame: ...

    def replace(self, rows: DataFrame | None, documents: DataFrame, by: str = "document_id", together: bool = False) -> int: ...

    def upsert(self, chunks: DataFrame, by: str = "document_id") -> None: ...

    def delete_documents(self, documents: DataFrame) -> int: ...


class _Reads:
    """What can be asked of any store that can be read."""

    def by_hash(self, source_hash: str) -> DataFrame:
        return self.read().where(F.col("source_hash") == source_hash)

    def by_document(self, document_id: str) -> DataFrame:
        return self.read().where(F.col("document_id") == document_id)

    def hashes(self) -> DataFrame:
        return self.read().select("source_hash").distinct()

    def document_ids(self) -> DataFrame:
        return self.read().select("document_id").distinct()

    def count(self) -> int:
        return self.read().count()

    def raw_count(self) -> int:
        """All rows, valid or not."""
        return self.count()

    def page(self, limit: int, offset: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` by chunk_id."""
        return self.read().orderBy("chunk_id").offset(offset).limit(limit)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new folder's path where ``spark.checkpoint.dir`` of the session is; without one, on a single machine only, a local one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="chunkmill-")
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def complete(rows: DataFrame) -> DataFrame:
    """Valid rows in the store's columns: required values there, the others defaulted."""
    defaults = {"dataset_name": "", "section_heading": "", "absolute_address": "", "source_hash": "", "split_reason": "none"}
    columns: list[Column] = []
    for f in ENRICHED:
        c = F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        if f.name == "cross_refs":
            c = F.coalesce(c, F.array().cast("array<string>"))
        columns.append(c.alias(f.name))
    valid = F.col("token_count") >= 0
    for name in REQUIRED:
        valid = valid & F.col(name).isNotNull()
    return rows.select(columns).where(valid)


def flat_metadata(rows: DataFrame) -> DataFrame:
    """The 13 flat fields of a chunk, and its id, text and vector: references joined by commas, the file's path rebuilt.

    References that hold commas themselves don't survive that; ``cross_refs_list`` keeps them apart.
    """
    path = F.when(F.col("dataset_name") != "", F.concat(F.lit("data/extracted/"), "dataset_name", F.lit("/"), "document_id", F.lit(".xml"))).otherwise("")
    return rows.select(
        "chunk_id", "document_id", "dataset_name", "content", "token_count", "section_heading", "absolute_address", "split_reason",
        F.coalesce("parent_chunk_id", F.lit("")).alias("parent_chunk_id"), "source_hash", F.array_join("cross_refs", ",").alias("cross_refs"),
        "embedding_model", "embedded_at", path.alias("file_path"), "embedding", F.col("cross_refs").alias("cross_refs_list"),
    )


def from_flat(rows: DataFrame) -> DataFrame:
    """Flat rows back to chunk rows: references as listed, or else cut at commas, trimmed, blanks dropped; counts cast where they can be."""
    refs = F.filter(F.transform(F.split(F.coalesce("cross_refs", F.lit("")), ","), lambda x: F.trim(x)), lambda r: r != "")
    if "cross_refs_list" in rows.columns:
        refs = F.coalesce("cross_refs_list", refs)
    return complete(rows.withColumns({"cross_refs": refs, "token_count": F.coalesce(F.col("token_count").cast("string").try_cast("int"), F.lit(0)), "parent_chunk_id": F.nullif("parent_chunk_id", F.lit(""))}))


def without(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key isn't among ``keys``."""
    return rows.join(keys.select(on).distinct(), on, "left_anti")


def upserted(existing: DataFrame, new: DataFrame, key: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    """``existing`` with rows of equal key replaced; of several new rows of one key, the last by embedded_at."""
    latest = Window.partitionBy(*key).orderBy(F.col("embedded_at").desc_nulls_last(), F.col("content").desc_nulls_last())
    new = new.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
    return existing.join(new.select(*key), list(key), "left_anti").unionByName(new)


@dataclass(frozen=True)
class ChunkStore(_Reads):
    spark: SparkSession
    path: str

    def _marks(self) -> dict[int, tuple[bool, bool, bool, int]]:
        """version -> (has rows, has document keys, has chunk keys, whole up to), by one listing."""
        fs, root = _file_system(self.spark, self.path)
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/done-*")) if fs.exists(root) else []
        marks = {}
        for status in found or []:
            at = status.getPath()
            if (m := _MARK.fullmatch(at.getName())) and at.getParent().getName()[1:].isdigit():
                marks[int(at.getParent().getName()[1:])] = (m[1] == "1", m[2] == "1", m[3] == "1", int(m[4]))
        return dict(sorted(marks.items()))

    def version(self) -> int:
        """The last committed version, 0 if there is none."""
        return max(self._marks(), default=0)

    def _claim(self) -> int:
        """A number of its own for a new version, above all that are there or in the making."""
        fs, root = _file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        version = max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0) + 1
        while True:
            try:
                fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{version}/{_CLAIM}"), False).close()
                return version
            except Py4JJavaError as error:
                if "AlreadyExists" not in str(error.java_exception):
                    raise
                version += 1

    def _commit(self, version: int, rows: bool, by_document: bool, by_chunk: bool, whole: int = 0) -> None:
        fs, at = _file_system(self.spark, f"{self.path}/v{version}/done-r{rows:d}-d{by_document:d}-c{by_chunk:d}-w{whole}")
        fs.create(at, False).close()

    def _live(self, version: int | None = None) -> tuple[int, int, dict[int, tuple[bool, bool, bool, int]]]:
        """The last whole version, the version up to which it holds all, and the marks of all that count."""
        marks = {v: m for v, m in self._marks().items() if version is None or v <= version}
        last = max((v for v, m in marks.items() if m[3]), key=lambda v: marks[v][3], default=0)
        since = marks[last][3] if last else 0
        return last, since, {v: m for v, m in marks.items() if v == last or (v > since and not m[3])}

    def read(self, version: int | None = None) -> DataFrame:
        """All chunks as of a version, the last by default."""
        last, since, live = self._live(version)
        return self._rows(last, since, live, [f"{self.path}/v{v}/{_ROWS}" for v, m in live.items() if m[0]])

    def _rows(self, last: int, since: int, live: dict[int, tuple[bool, bool, bool, int]], kept: list[str], only: Column | None = None) -> DataFrame:
        """The rows of the folders or files ``kept`` that later versions left; ``only`` limits the rows first."""
        number = lambda part: F.regexp_extract(F.col("_metadata.file_path"), rf"/v([0-9]+)/{part}/[^/]*$", 1).cast("int")
        if not kept:
            return self.spark.createDataFrame([], ENRICHED)
        rows = self.spark.read.schema(ENRICHED).parquet(*kept).select("*", number(_ROWS).alias("_version"))
        if only is not None:
            rows = rows.where(only)
        rows = rows.withColumn("_version", F.when(F.col("_version") == last, since).otherwise(F.col("_version")))
        for name, place in (("document_id", 1), ("chunk_id", 2)):
            holding = [f"{self.path}/v{v}/{_KEYS}" for v, m in live.items() if m[place]]
            if holding:
                keys = self.spark.read.schema("document_id string, chunk_id string").parquet(*holding).where(F.col(name).isNotNull())
                gone = keys.select(name, number(_KEYS).alias("_until")).groupBy(name).agg(F.max("_until").alias("_until"))
                rows = rows.join(gone, name, "left").where("_until is null or _version >= _until").drop("_until")
        return rows.select(*ENRICHED.names)

    def files_for(self, column: str, value: str, live: dict[int, tuple[bool, bool, bool, int]] | None = None) -> list[str]:
        """Files that can hold ``value`` in an indexed column; folders of versions that have no index, whole."""
        fs, _ = _file_system(self.spark, self.path)
        live = self._live()[2] if live is None else live
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/{_INDEX}/_SUCCESS")) or []
        indexed = {int(s.getPath().getParent().getParent().getName()[1:]) for s in found}
        holding = [v for v, m in live.items() if m[0]]
        whole = [f"{self.path}/v{v}/{_ROWS}" for v in holding if v not in indexed]
        tested = [f"{self.path}/v{v}/{_INDEX}" for v in holding if v in indexed]
        if not tested:
            return whole
        return whole + [r["file"] for r in self.spark.read.parquet(*tested).where(can_hold(column, value)).select("file").collect()]  # files of one key

    def _lookup(self, column: str, value: str) -> DataFrame:
        last, since, live = self._live()
        return self._rows(last, since, live, self.files_for(column, value, live), F.col(column) == value)

    def by_document(self, document_id: str) -> DataFrame:
        """Opens only files that can hold the document."""
        return self._lookup("document_id", document_id)

    def by_hash(self, source_hash: str) -> DataFrame:
        """Opens only files that can hold the hash."""
        return self._lookup("source_hash", source_hash)

    def _write_rows(self, rows: DataFrame, at: str) -> DataFrame:
        """Writes rows, in order of document_id in their files, and the files' index; what was written."""
        rows.sortWithinPartitions("document_id").write.parquet(f"{at}/{_ROWS}")
        written = self.spark.read.schema(ENRICHED).parquet(f"{at}/{_ROWS}")
        file_index(written).write.parquet(f"{at}/{_INDEX}")
        return written

    def replace(self, rows: DataFrame | None, documents: DataFrame, by: str = "document_id", together: bool = False) -> int:
        """One commit: stores ``rows`` and drops all else of their keys and of ``documents`` (document_id); the version, or 0 if nothing changes.

        ``rows`` are computed once, when they are written; their keys are read from what was written. Those of a
        document are shuffled together first, unless they already are (``together``).
        """
        version = self._claim()
        at, none = f"{self.path}/v{version}", F.lit(None).cast("string")
        keys = documents.select("document_id").where("document_id <> ''").select("document_id", none.alias("chunk_id"))
        has_rows = False
        if rows is not None:
            rows = complete(rows)
            if by == "chunk_id":
                rows = upserted(self.spark.createDataFrame([], ENRICHED), rows)
            # by document, and balanced by size: a document with very many chunks is several files
            written = self._write_rows(rows if together and by == "document_id" else rows.hint("rebalance", F.col("document_id")), at)
            keys = keys.unionByName(written.select(*[(F.col(n) if n == by else none).alias(n) for n in ("document_id", "chunk_id")]))
            has_rows = not written.isEmpty()
        keys.distinct().write.parquet(f"{at}/{_KEYS}")
        written = self.spark.read.schema("document_id string, chunk_id string").parquet(f"{at}/{_KEYS}").agg(F.count("document_id"), F.count("chunk_id")).first()
        if not (has_rows or any(written)):
            remove(self.spark, at)
            return 0
        self._commit(version, has_rows, written[0] > 0, written[1] > 0)
        marks = self._marks()
        if sum(v > max((m[3] for m in marks.values()), default=0) for v in marks) > COMPACT_AFTER:
            self.compact()
        return version

    def upsert(self, chunks: DataFrame, by: str = "document_id") -> None:
        """Stores chunks. By document, all that was there of these documents goes; by chunk_id, only equal ids."""
        self.replace(chunks, self.spark.createDataFrame([], "document_id string"), by)

    def delete_documents(self, documents: DataFrame) -> int:
        """Deletes all chunks of the documents listed by document_id; how many there were. Blank ids delete nothing."""
        listed = documents.select("document_id").where("document_id <> ''").distinct()
        count = self.read().join(listed, "document_id", "left_semi").count()
        if count:
            self.replace(None, listed)
        return count

    def compact(self) -> None:
        """Writes all that is there as one version. What others commit meanwhile stays in force, as later than what it holds."""
        upto = self.version()
        if upto:
            version = self._claim()
            self._write_rows(self.read(upto).repartitionByRange("document_id"), f"{self.path}/v{version}")
            self._commit(version, True, False, False, whole=upto)

    def vacuum(self, older_than: float = 7 * 24 * 3600.0) -> int:
        """Removes versions that a compaction folded, and writes that broke off, ``older_than`` seconds ago; how many.

        The last whole version and all after it stay, so every read that begins now is served. A reader that
        is still on an older version after that time loses its files.
        """
        fs, root = _file_system(self.spark, self.path)
        if not fs.exists(root):
            return 0
        last, since, live = self._live()
        marks, now = self._marks(), int(time.time() * 1000)
        removed = 0
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if not (name[:1] == "v" and name[1:].isdigit()) or int(name[1:]) in live:
                continue
            # a version that isn't committed may be in the making, a folded one has been superseded for as long as the whole one is there
            superseded = int(name[1:]) in marks and int(name[1:]) <= max(since, last)
            age = now - (self._committed(last) if superseded else status.getModificationTime())
            if (superseded or int(name[1:]) not in marks) and age >= older_than * 1000:
                fs.delete(status.getPath(), True)
                removed += 1
        return removed

    def _committed(self, version: int) -> int:
        """When a version was committed, in milliseconds."""
        fs, _ = _file_system(self.spark, self.path)
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{version}/done-*"))
        return max(s.getModificationTime() for s in found)


@dataclass(frozen=True)
class JsonlStore(_Reads):
    """Chunks as JSON lines in a folder for each source hash (``unknown`` where it is empty), written in transactions.

    A write merges the folders that it touches, and one commit shows what it rewrote and what it emptied
    (see ``jsonl_log``); one that breaks off leaves all as it was. Of two at a time the second fails. To find
    the documents' folders a write reads all rows.
    """

    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        return read_jsonl(self.spark, self.path)

    def by_hash(self, source_hash: str) -> DataFrame:
        """Reads that hash's folder only."""
        return read_jsonl(self.spark, self.path, source_hash or "unknown").where(F.col("source_hash") == source_hash)

    def replace(self, rows: DataFrame | None, documents: DataFrame, by: str = "document_id", together: bool = False) -> int:
        staged = f"{self.path}.staged-{uuid.uuid4().hex}"
        try:
            new = None
            keys = documents.select("document_id").where("document_id <> ''")
            have = self.read().withColumn("hash", _folder())
            if rows is not None:
                new = complete(rows)
                if by == "chunk_id":
                    new = upserted(self.spark.createDataFrame([], ENRICHED), new, ("source_hash", "chunk_id"))
                new.withColumn("hash", _folder()).write.parquet(f"{staged}/new")
                new = self.spark.read.parquet(f"{staged}/new")
                if by == "document_id":
                    keys = keys.union(new.select("document_id"))
            gone = have.join(keys.distinct(), "document_id", "left_semi").select("hash", "chunk_id", "document_id")
            if new is not None and by == "chunk_id":
                gone = gone.union(have.join(new.select("hash", "chunk_id"), ["hash", "chunk_id"], "left_semi").select("hash", "chunk_id", "document_id"))
            gone.distinct().write.parquet(f"{staged}/gone")
            gone = self.spark.read.parquet(f"{staged}/gone")
            touched = gone.select("hash") if new is None else gone.select("hash").union(new.select("hash"))
            touched = touched.distinct()
            if touched.isEmpty():
                return 0
            kept = have.join(touched, "hash", "left_semi").join(gone, ["hash", "chunk_id", "document_id"], "left_anti")
            merged = kept if new is None else kept.unionByName(new)
            lines = merged.select("hash", F.to_json(F.struct(*ENRICHED.names), {"ignoreNullFields": "false"}).alias("line"))
            jsonl_log.write_lines(self.spark, lines.unionByName(touched.select("hash", F.lit(None).cast("string").alias("line"))), self.path)
            return 1
        finally:
            remove(self.spark, staged)

    def upsert(self, chunks: DataFrame, by: str = "chunk_id") -> None:
        self.replace(chunks, self.spark.createDataFrame([], "document_id string"), by)

    def delete_documents(self, documents: DataFrame) -> int:
        listed = documents.select("document_id").where("document_id <> ''").distinct()
        count = self.read().join(listed, "document_id", "left_semi").count()
        if count:
            self.replace(None, listed)
        return count

    def raw_count(self) -> int:
        return raw_line_count(self.spark, self.path)

    def vacuum(self, older_than: float = 7 * 24 * 3600.0) -> int:
        """Removes files that no longer count, ``older_than`` seconds old; how many. A reader on them loses them."""
        return jsonl_log.vacuum(self.spark, self.path, older_than)


@dataclass(frozen=True)
class FlatTable(_Reads):
    """Chunks in their flat form, as a Parquet table: a write makes a new folder of it, and the last whole one counts.

    A plain Parquet table at the path is read as what was there before the first write. The folder before the
    last stays for who reads it, older ones are removed by the next write.
    """

    spark: SparkSession
    path: str

    def _versions(self) -> list[str]:
        """Folders that are whole, in their order."""
        fs, _ = _file_system(self.spark, self.path)
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/_SUCCESS")) or []
        return sorted((n for s in found if _FLAT.fullmatch(n := s.getPath().getParent().getName())), key=lambda n: (int(_FLAT.fullmatch(n)[1]), n))

    def read(self) -> DataFrame:
        whole = self._versions()
        if whole:
            return from_flat(self.spark.read.parquet(f"{self.path}/{whole[-1]}"))
        return from_flat(self.spark.read.parquet(self.path)) if self._plain() else self.spark.createDataFrame([], ENRICHED)

    def raw_count(self) -> int:
        whole = self._versions()
        return self.spark.read.parquet(f"{self.path}/{whole[-1]}" if whole else self.path).count() if whole or self._plain() else 0

    def _plain(self) -> bool:
        """Whether there is more than folders of writes that broke off."""
        fs, root = _file_system(self.spark, self.path)
        return fs.exists(root) and any(not _FLAT.fullmatch(s.getPath().getName()) for s in fs.listStatus(root))

    def _swap(self, rows: DataFrame) -> None:
        whole = self._versions()
        number = int(_FLAT.fullmatch(whole[-1])[1]) + 1 if whole else 1
        flat_metadata(rows).write.parquet(f"{self.path}/v{number}-{uuid.uuid4().hex}")
        for name in whole[:-1]:
            remove(self.spark, f"{self.path}/{name}")

    def replace(self, rows: DataFrame | None, documents: DataFrame, by: str = "document_id", together: bool = False) -> int:
        have = without(self.read(), documents.where("document_id <> ''"), "document_id")
        if rows is not None:
            rows = complete(rows)
            have = upserted(have, rows) if by == "chunk_id" else without(have, rows, by).unionByName(rows)
        self._swap(have)
        return 1

    def upsert(self, chunks: DataFrame, by: str = "chunk_id") -> None:
        self.replace(chunks, self.spark.createDataFrame([], "document_id string"), by)

    def delete_documents(self, documents: DataFrame) -> int:
        count = self.read().join(documents.where("document_id <> ''").select("document_id").distinct(), "document_id", "left_semi").count()
        if count:
            self.replace(None, documents)
        return count


#: The layouts by name, and the folder of each below the data folder.
LAYOUTS = {"store": (ChunkStore, "store"), "jsonl": (JsonlStore, "jsonl_chunks"), "flat": (FlatTable, "flat")}


def open_store(spark: SparkSession, data_dir: str, layout: str, path: str | None = None) -> ChunkStore | JsonlStore | FlatTable:
    if layout not in LAYOUTS:
        raise ValueError(f"a layout is one of {', '.join(LAYOUTS)}, not {layout!r}")
    kind, folder = LAYOUTS[layout]
    return kind(spark, path or f"{data_dir.rstrip('/')}/{folder}")


def _folder() -> Column:
    return F.when(F.col("source_hash") == "", "unknown").otherwise(F.col("source_hash"))


def _write_folders(rows: DataFrame, path: str) -> None:
    """Folders of the rows' hashes are replaced, others stay. Rows are balanced by size, so a hash with very many is several files."""
    rows.hint("rebalance", F.col("hash")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("hash").json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One folder of JSON lines per source hash (``unknown`` where it is empty); only folders of ``rows`` are replaced."""
    _write_folders(rows.withColumn("hash", _folder()), path)


def read_jsonl(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """Valid rows, of the folder of one hash with ``only``; blank lines, bad JSON and rows without required values are skipped. Nothing there: no rows."""
    at = path if only is None else f"{path}/{jsonl_log.folder(only)}"
    if not exists(spark, at):
        return spark.createDataFrame([], ENRICHED)
    found = jsonl_log.live(spark, path)
    if found is not None and only is not None:
        found = found.where(F.col("hash") == only)
    # the option tells scans of the same folder at different times apart, which Spark else takes for one where it reuses exchanges
    rows = spark.read.schema(ENRICHED).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("commits", jsonl_log.next_token(path).partition("-")[0]).json(at)
    return complete(jsonl_log.counting(rows, found, "hash", F.coalesce(_folder(), F.lit("unknown"))))


def raw_line_count(spark: SparkSession, path: str) -> int:
    """All lines of files that count, valid or not."""
    if not exists(spark, path):
        return 0
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return jsonl_log.counting(lines, jsonl_log.live(spark, path), "folder", jsonl_log.folder_of(F.col("_metadata.file_path"))).count()
