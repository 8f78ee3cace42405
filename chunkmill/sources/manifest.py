"""The upstream manifest as rows, and its listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_dataset, stem
from ..schema import MANIFEST, MANIFEST_JSON


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per file of ``state.json``; no rows if the manifest isn't there. Missing hashes are empty."""
    path = f"{data_dir.rstrip('/')}/state.json"
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST_JSON).alias("m"))
    sets = parsed.select(F.posexplode("m.raw_datasets").alias("set_position", "archive", "content"))
    files = sets.select("set_position", "archive", F.posexplode("content.files").alias("file_position", "relative_path", "file"))
    dataset = plain_dataset(F.col("archive"))
    return files.select(
        (F.col("set_position").cast("long") * 2**32 + F.col("file_position")).alias("position"),
        stem(F.col("relative_path")).alias("doc_id"), dataset.alias("dataset"), "relative_path",
        F.concat(F.lit(f"{data_dir.rstrip('/')}/extracted/"), dataset, F.lit("/"), "relative_path").alias("path"),
        F.col("file.status").alias("status"), F.coalesce("file.sha256", F.lit("")).alias("hash"),
    )


def changed_files(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status").isin("added", "modified"))


def all_files(manifest: DataFrame) -> DataFrame:
    """All but removed files; an unknown or missing status counts as there."""
    return manifest.where(~F.col("status").eqNullSafe("removed"))


def removed_files(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") == "removed").select("doc_id", "dataset")


def sync_statistics(manifest: DataFrame) -> DataFrame:
    """One row: added, modified, removed, total_changed. Other statuses count nowhere."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("added", "modified", "removed")]
    return manifest.agg(*counts).withColumn("total_changed", F.col("added") + F.col("modified"))


def in_dataset(manifest: DataFrame, pattern: str) -> DataFrame:
    """Files whose data set matches a shell pattern; a plain name also matches what it begins."""
    escaped = "".join(".*" if c == "*" else "." if c == "?" else f"\\{c}" if not c.isalnum() else c for c in pattern)
    return manifest.where(F.col("dataset").rlike(f"^{escaped}" + ("$" if "*" in pattern or "?" in pattern else "(?:$|-)")))
