"""Lookups in the log store by its file index, and what compaction leaves behind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F


from chunkmill.sources.store import ChunkStore, complete, remove


def chunks(spark, low: int, high: int, content: str = "text"):
    """Five chunks for each document; seven documents share a hash."""
    rows = spark.range(low * 5, high * 5, 1, 8).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"), F.concat(F.lit("doc"), F.floor(F.col("id") / 5)).alias("document_id"), F.lit(content).alias("content"), F.lit(3).alias("token_count"),
        F.concat(F.lit("h"), F.floor(F.col("id") / 35)).alias("source_hash"), F.array(F.lit(0.5).cast("float")).alias("embedding"), F.lit("m").alias("embedding_model"), F.lit("t").alias("embedded_at"),
    )
    return complete(rows)


@pytest.fixture
def small_files(spark):
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    yield
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)


def test_lookup_opens_only_files_that_can_hold_the_key(spark, tmp_path, small_files):
    store = ChunkStore(spark, str(tmp_path / "s"))
    store.upsert(chunks(spark, 0, 4000))
    store.upsert(chunks(spark, 4000, 8000))
    total = len(store.read().inputFiles())
    assert total >= 12
    for name in ("doc0", "doc3999", "doc4000", "doc7777"):
        found = store.by_document(name)
        assert len(store.files_for("document_id", name)) == 1 and found.count() == 5
        assert len([f for f in found.inputFiles() if "/rows/" in f]) == 1
        assert found.exceptAll(store.read().where(F.col("document_id") == name)).isEmpty()
    assert store.files_for("document_id", "doc8000") == [] == store.files_for("document_id", "") and store.by_document("doc8000").isEmpty()
    # documents of one hash lie apart
    assert store.by_hash("h100").count() == 35 and len(store.files_for("source_hash", "h100")) <= 7
    assert sum(len(store.files_for("document_id", f"none{i}")) for i in range(40)) <= 2  # false positives are rare


def test_lookup_sees_replaced_and_deleted_rows(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "s"))
    store.upsert(chunks(spark, 0, 50))
    store.upsert(chunks(spark, 10, 12, "new"))
    store.delete_documents(spark.createDataFrame([("doc11",)], "document_id string"))
    store.upsert(chunks(spark, 20, 21, "by chunk"), by="chunk_id")
    for _ in range(2):
        seen = lambda name: sorted({r["content"] for r in store.by_document(name).collect()})
        assert (seen("doc9"), seen("doc10"), seen("doc11"), seen("doc20")) == (["text"], ["new"], [], ["by chunk"])
        assert store.by_hash("h1").count() == 30 and store.read().count() == 245
        store.compact()


def test_lookup_in_versions_without_an_index(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "s"))
    store.upsert(chunks(spark, 0, 20))

    remove(spark, f"{store.path}/v1/index")
    store.upsert(chunks(spark, 20, 40))
    assert store.by_document("doc3").count() == 5 and store.by_document("doc33").count() == 5
    assert [f.rsplit("/", 1)[1] for f in store.files_for("document_id", "doc3")] == ["rows"]


def test_vacuum_keeps_what_counts(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "s"))
    for k in range(3):
        store.upsert(chunks(spark, k * 10, k * 10 + 10))
    assert store.vacuum(0) == 0
    store.compact()
    store.upsert(chunks(spark, 5, 6, "later"))
    (tmp_path / "s" / "v9").mkdir()
    (tmp_path / "s" / "v9" / "claim").touch()
    before = sorted(map(tuple, store.read().select("chunk_id", "content").collect()))
    assert store.vacuum() == 0 and store.vacuum(0) == 4
    assert sorted(map(tuple, store.read().select("chunk_id", "content").collect())) == before and store.by_document("doc5").count() == 5
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["v4", "v5"]
    assert ChunkStore(spark, str(tmp_path / "none")).vacuum(0) == 0


def test_rows_that_are_together_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Rows staged document by document go to the store as they are, and it holds the same."""
    rows = spark.range(0, 200, 1, 2).selectExpr("concat('d', id div 10) AS document_id", "concat('c', id) AS chunk_id", "repeat('x', 10) AS content", "1 AS token_count", "array(1F) AS embedding", "'m' AS embedding_model", "'t' AS embedded_at")
    none, plans = spark.createDataFrame([], "document_id string"), []
    written = ChunkStore._write_rows
    monkeypatch.setattr(ChunkStore, "_write_rows", lambda self, df, at: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(self, df, at))
    for together in (False, True):
        store = ChunkStore(spark, str(tmp_path / str(together)))
        store.replace(rows, none, together=together)
        assert store.read().count() == 200 and store.by_document("d3").count() == 10
    assert ["Rebalance" in p for p in plans] == [True, False]
