"""Embedding: texts to vectors in batches, through a pluggable provider, and exact nearest neighbours."""

from __future__ import annotations

import hashlib
import importlib
import re
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from itertools import islice
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENRICHED

#: Texts of one call to a provider.
BATCH = 100
#: Similarities that a task holds at a time.
_SCORES = 1 << 22


class EmbeddingProvider(Protocol):
    """Shipped to executors, so it must pickle; called again when a task is retried, so it must repeat itself."""

    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...

    def model_name(self) -> str: ...


class HashEmbedding:
    """Signed hashing of words to a unit vector: no network, no state, equal for equal texts."""

    def __init__(self, dimensions: int = 1024) -> None:
        self.dimensions = dimensions

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            for word in re.findall(r"\w+", text.lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                row[h % self.dimensions] += 1 if h >> 63 else -1
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norms == 0, 1, norms)).tolist()

    def model_name(self) -> str:
        return f"local-hash-{self.dimensions}"


class _KeyedHash(HashEmbedding):
    """As ``HashEmbedding``, with words hashed under a key."""

    def __init__(self, dimensions: int, api_key: str) -> None:
        super().__init__(dimensions)
        self.key = hashlib.blake2b(api_key.encode(), digest_size=16).hexdigest()

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        return super().embed_batch([re.sub(r"\w+", lambda m: m[0] + self.key, t) for t in texts])

    def model_name(self) -> str:
        return f"local-keyed-hash-{self.dimensions}-{self.key[:8]}"


def keyed_hash(dimensions: int, api_key: str = "") -> EmbeddingProvider:
    """A factory for ``embedding_model``: vectors that only who has the key can make."""
    return _KeyedHash(dimensions, api_key)


def provider_for(model: str, dimensions: int, api_key: str = "") -> EmbeddingProvider:
    """The provider that settings name: ``local-hash``, or ``module:factory``, which is called with ``dimensions`` and ``api_key``.

    The module must be importable on executors. A key stays in the provider, which is shipped to tasks.
    """
    if model == "local-hash":
        return HashEmbedding(dimensions)
    module, sign, name = model.partition(":")
    if not sign or not module or not name:
        raise ValueError(f"embedding_model is local-hash or module:factory, not {model!r}")
    try:
        factory = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError) as error:
        raise ValueError(f"embedding_model {model!r}: {error}") from error
    return factory(dimensions=dimensions, api_key=api_key)


def vectors_of(provider: EmbeddingProvider, documents: list[str], texts: list[str]) -> tuple[list[list[float] | None], list[str | None]]:
    """Vectors and errors of a batch; ``documents`` says whose each text is. Where a batch of several documents fails, each is tried alone: its failure is its own."""
    try:
        found = provider.embed_batch(texts)
        if len(found) != len(texts):
            raise ValueError(f"{len(texts)} texts, {len(found)} vectors")
        return list(found), [None] * len(texts)
    except Exception as error:  # noqa: BLE001  whatever a provider raises is the documents' outcome
        if len(set(documents)) == 1:
            return [None] * len(texts), [f"embedding failed: {type(error).__name__}: {error}"] * len(texts)
    vectors: list[list[float] | None] = [None] * len(texts)
    errors: list[str | None] = [None] * len(texts)
    for name in dict.fromkeys(documents):
        at = [i for i, d in enumerate(documents) if d == name]
        for i, v, e in zip(at, *vectors_of(provider, [name] * len(at), [texts[i] for i in at]), strict=True):
            vectors[i], errors[i] = v, e
    return vectors, errors


def embed_chunks(chunks: DataFrame, provider: EmbeddingProvider, batch: int = BATCH, keep_refs: bool = True, errors: bool = False) -> DataFrame:
    """Chunks with embedding, model and time (one for each batch).

    A provider that fails, or gives a wrong number of vectors, fails the run; with ``errors`` its failure
    is a column ``error`` of the chunks of that document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.slice(at, batch)
                texts = [t or "" for t in part.column("content").to_pylist()]
                failed: list[str | None] = [None] * len(texts)
                if errors:
                    vectors, failed = vectors_of(provider, part.column("document_id").to_pylist(), texts)
                elif len(vectors := provider.embed_batch(texts)) != len(texts):
                    raise ValueError(f"{len(texts)} texts, {len(vectors)} vectors")
                now = datetime.now(UTC).isoformat()
                added = [pa.array(vectors, pa.list_(pa.float32())), pa.array([provider.model_name()] * len(part)), pa.array([now] * len(part))]
                names = [*part.schema.names, "embedding", "embedding_model", "embedded_at"]
                if errors:
                    added, names = [*added, pa.array(failed, pa.string())], [*names, "error"]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)

    given = [f for f in ENRICHED.names if f not in ("embedding", "embedding_model", "embedded_at")]
    refs = F.col("cross_refs") if keep_refs else F.array().cast("array<string>")
    schema = T.StructType([ENRICHED[n] for n in ENRICHED.names] + [T.StructField("error", T.StringType())] * errors)
    return chunks.select(*[refs.alias(c) if c == "cross_refs" else F.col(c) for c in given]).mapInArrow(run, schema)


def batch_ids(order: Column, partition: Column | None = None, size: int = BATCH) -> Column:
    """0-based batch of each row when rows are taken ``size`` at a time in order."""
    window = Window.partitionBy(partition).orderBy(order) if partition is not None else Window.orderBy(order)
    return F.floor((F.row_number().over(window) - 1) / size)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", max_queries: int = 10_000) -> DataFrame:
    """(query_id, id, similarity, rank): exact cosine top-k of each query against all rows but itself, similarities to nine places.

    Queries are dealt to blocks of at most ``max_queries``, and the driver holds one block at a time. A block
    is sent to every task, and each task keeps its own k best of each query over all its batches, so rows
    moved are tasks times queries times k (and ties of the k-th). The vectors are read once for each block.
    """
    q = queries.select(F.col(id_col).alias("query_id"), F.col(vector_col).cast("array<float>").alias("q")).where(F.col("q").isNotNull())
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"))
    dealt = q.repartition(max(1, -(-queries.count() // max_queries))).toLocalIterator()
    found = None
    while (block := list(islice(dealt, max_queries))) or found is None:
        best = rows.mapInArrow(_best_rows([r["query_id"] for r in block], [r["q"] for r in block], k), "query_id long, id long, similarity double")
        found = best if found is None else found.union(best)
    window = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _best_rows(ids: list[int], vectors: list[list[float]], k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    matrix = np.array(vectors, dtype=np.float64).reshape(len(ids), -1 if ids else 0)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    names = np.array(ids, dtype=np.int64)

    step = max(1, _SCORES // max(len(ids), 1))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        for batch in (whole.slice(at, step) for whole in batches for at in range(0, len(whole), step)):
            if not len(ids):
                continue
            have = batch.column("id").to_numpy()
            rows = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
            scores = np.round(matrix @ rows.T, 9)  # ranked as they are given, so that ties are ties everywhere
            scores[names[:, None] == have[None, :]] = -np.inf
            for i, score in enumerate(scores):
                old_ids, old = kept[i]
                if len(old) >= k:
                    some = np.flatnonzero(score >= old.min())
                    score, new = score[some], have[some]
                else:
                    new = have
                score, new = np.concatenate([old, score]), np.concatenate([old_ids, new])
                # rows as good as the k-th, ties included: the final rank decides between them
                kth = np.partition(score, -k)[-k] if len(score) > k else -np.inf
                top = np.flatnonzero((score >= kth) & np.isfinite(score))
                if len(top) > 4 * k:  # of many ties, the least ids can still be among the first k
                    top = top[np.lexsort((new[top], -score[top]))[:k]]
                kept[i] = (new[top], score[top])
        for i, (found, score) in enumerate(kept):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), ids[i], dtype=np.int64)), pa.array(found, pa.int64()), pa.array(score)], ["query_id", "id", "similarity"])

    return best
