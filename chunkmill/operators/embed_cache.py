"""Vectors by content: a text is embedded once for each model, however many chunks and runs have it.

A cache is Parquet (key, embedding, embedded_at) for each model, where the key is the SHA-256 of the text.
Texts whose key isn't there go to the provider, once each, and what comes back is a folder of its own, which
counts once it is whole; chunks then meet their vectors by key. What a provider refuses isn't kept, so it is tried again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ENRICHED
from .embed import BATCH, EmbeddingProvider, vectors_of

_CACHED = "key string, embedding array<float>, embedded_at string"


@dataclass(frozen=True)
class EmbeddingCache:
    spark: SparkSession
    path: str

    def _folder(self, model: str) -> str:
        return f"{self.path}/{quote(model, safe='')}"

    def read(self, model: str) -> DataFrame:
        """(key, embedding, embedded_at), a key once: two runs at a time can both have added it."""
        rows = self.rows(model)
        return rows.groupBy("key").agg(F.min_by(F.struct("embedding", "embedded_at"), "embedded_at").alias("v")).select("key", "v.*")

    def rows(self, model: str) -> DataFrame:
        """What is kept, as it was added."""
        # whole folders by name: two scans of one folder with more files in it are the same to Spark where it reuses exchanges
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(model)}/*/_SUCCESS")
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(root) or []
        names = sorted(s.getPath().getParent().toString() for s in found)
        return self.spark.read.schema(_CACHED).parquet(*names) if names else self.spark.createDataFrame([], _CACHED)

    def add(self, texts: DataFrame, provider: EmbeddingProvider, staged: str, batch: int = BATCH) -> DataFrame:
        """Embeds those of ``texts`` (key, content) that aren't there and keeps them; (key, error) of those refused.

        Only keys of the cache are read. ``staged`` is a new folder, to be removed when the errors are used.
        """
        todo = texts.dropDuplicates(["key"]).join(self.rows(provider.model_name()).select("key"), "key", "left_anti")
        todo.select("key", "content").mapInArrow(_embedding(provider, batch), f"{_CACHED}, error string").write.parquet(staged)
        done = self.spark.read.parquet(staged)
        done.where("error is null").drop("error").write.parquet(f"{self._folder(provider.model_name())}/{uuid.uuid4().hex}")
        return done.where("error is not null").select("key", "error")


def _embedding(provider: EmbeddingProvider, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.slice(at, batch)
                keys = part.column("key").to_pylist()
                vectors, errors = vectors_of(provider, keys, part.column("content").to_pylist())
                now = [datetime.now(UTC).isoformat()] * len(part)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(vectors, pa.list_(pa.float32())), pa.array(now), pa.array(errors, pa.string())], names=["key", "embedding", "embedded_at", "error"])

    return run


def embed_by_content(chunks: DataFrame, provider: EmbeddingProvider, cache: EmbeddingCache, staged: str, batch: int = BATCH, keep_refs: bool = True) -> DataFrame:
    """Chunks with embedding, model, time and ``error``, as ``embed_chunks`` with ``errors`` gives them; each distinct text is embedded once.

    A null text is embedded as an empty one. ``staged`` is a new folder for what the provider gives, to be
    removed when the chunks are used. A text that very many chunks have is one row before the provider; in
    the join by key Spark splits it.
    """
    keyed = chunks.withColumn("_key", F.sha2(F.coalesce("content", F.lit("")), 256))
    refused = cache.add(keyed.select(F.col("_key").alias("key"), F.coalesce("content", F.lit("")).alias("content")), provider, staged, batch)
    # every key is in one of the two
    outcomes = cache.read(provider.model_name()).withColumn("error", F.lit(None).cast("string")).unionByName(refused, allowMissingColumns=True)
    made = {"embedding", "embedding_model", "embedded_at"}
    given = [F.array().cast("array<string>").alias(n) if n == "cross_refs" and not keep_refs else F.col(n) for n in ENRICHED.names if n not in made]
    rows = keyed.select("_key", *given).join(outcomes, keyed["_key"] == outcomes["key"])
    return rows.withColumn("embedding_model", F.lit(provider.model_name())).select(*ENRICHED.names, "error")


def staged_folder(root: str) -> str:
    return f"{root.rstrip('/')}/embedding-{uuid.uuid4().hex}"
