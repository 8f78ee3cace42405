"""Streams: files as they arrive into the store, and the latest status of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import stem
from ..operators.chunking import Limits, chunk_rows, chunk_units
from ..operators.embed import EmbeddingProvider, embed_chunks
from ..sources.pull_xml import parse_needed
from ..sources.store import ChunkStore, remove, scratch_path

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(spark: SparkSession, files: str, store: ChunkStore, checkpoint: str, provider: EmbeddingProvider, limits: Limits, max_files: int = 1000, outcomes: str | None = None) -> StreamingQuery:
    """Parses, chunks, embeds and stores new XML files, a micro-batch at a time, and stops when none are left.

    A micro-batch is one commit: its documents' chunks replace what was stored of them, of those that became
    empty or don't parse nothing stays, and those that fail to embed keep what they had. With ``outcomes``
    (doc_id, hash, error) of each batch go to a folder of that table. A batch that is replayed stores the same
    rows under a new version, by document, so it changes nothing.
    """
    arriving = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(files)

    def write(batch: DataFrame, number: int) -> None:
        named = batch.withColumn("doc_id", stem(F.col("path"))).withColumn("dataset", F.lit("")).withColumn("hash", F.sha2("content", 256))
        units = parse_needed(named.select(F.col("doc_id").alias("document_id"), "content"), limits.maximum).cache()
        staged = scratch_path(spark, "ingest")
        try:
            embed_chunks(chunk_rows(chunk_units(units, limits), named), provider, errors=True).write.parquet(staged)
            embedded = spark.read.parquet(staged)
            refused = embedded.where("error is not null").groupBy("document_id").agg(F.min("error").alias("error"))
            documents = named.select(F.col("doc_id").alias("document_id"), "hash").distinct()
            rows = embedded.join(refused, "document_id", "left_anti").drop("error")
            store.replace(rows, documents.join(refused, "document_id", "left_anti").select("document_id"))
            if outcomes is not None:
                errors = refused.unionByName(units.where("error is not null").select("document_id", "error"))
                documents.join(errors, "document_id", "left").select(F.col("document_id").alias("doc_id"), "hash", "error").write.mode("overwrite").parquet(f"{outcomes}/batch={number}")
        finally:
            units.unpersist()
            remove(spark, staged)

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_status(events: DataFrame, key: str = "user_id", at: str = "ts", value: str = "event_type", id_col: str = "event_id") -> DataFrame:
    """The last value of each key. On a batch or inside foreachBatch; ties in time go to the larger id."""
    newest = events.groupBy(key).agg(F.max(F.struct(F.col(at).alias("at"), F.col(id_col).alias("id"), F.col(value).alias("status"))).alias("last"))
    return newest.select(key, F.col("last.at").alias(at), F.col("last.status").alias("status"))


def windowed_counts(events: DataFrame, at: str = "ts", value: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each kind in tumbling windows; on a stream, what comes later than ``late`` is dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), value).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), value, "n")
