"""Flat tables that a broken write leaves as they were, migration in batches, and what settings name reaching a run."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chunkmill.cli import main
from chunkmill.operators.embed import HashEmbedding, provider_for
from chunkmill.plans import pipeline
from chunkmill.sources import store as stores
from chunkmill.sources.store import ChunkStore, FlatTable, JsonlStore, complete, flat_metadata


def chunks(spark, ids, content="text"):
    rows = spark.createDataFrame([(i,) for i in ids], "id int").select(
        F.concat(F.lit("c"), "id").alias("chunk_id"), F.concat(F.lit("d"), F.floor(F.col("id") / 2)).alias("document_id"), F.lit(content).alias("content"), F.lit(3).alias("token_count"),
        F.concat(F.lit("h"), F.col("id") % 3).alias("source_hash"), F.array(F.lit(0.5).cast("float")).alias("embedding"), F.lit("m").alias("embedding_model"), F.lit("t").alias("embedded_at"),
    )
    return complete(rows)


def seen(store):
    return sorted((r["chunk_id"], r["content"]) for r in store.read().collect())


def test_a_flat_table_is_whole_at_any_time(spark, tmp_path, monkeypatch):
    flat = FlatTable(spark, str(tmp_path / "f"))
    assert flat.read().isEmpty() and flat.raw_count() == 0
    flat.upsert(chunks(spark, range(6)))
    before, reader = seen(flat), flat.read()
    with monkeypatch.context() as m:  # a write that breaks off leaves a folder that isn't whole
        m.setattr(stores, "flat_metadata", lambda rows: flat_metadata(rows).withColumn("content", F.expr("if(chunk_id = 'c3', raise_error('gone'), content)")))
        with pytest.raises(Exception, match="gone"):
            flat.upsert(chunks(spark, range(3), "lost"))
    assert seen(flat) == before
    flat.upsert(chunks(spark, [1], "new"))
    assert dict(seen(flat))["c1"] == "new" and len(seen(flat)) == 6 and reader.count() == 6
    assert flat.delete_documents(spark.createDataFrame([("d0",)], "document_id string")) == 2 and len(seen(flat)) == 4
    assert len([p for p in Path(flat.path).glob("v*/_SUCCESS")]) == 2


def test_a_plain_table_is_a_flat_one(spark, tmp_path):
    flat_metadata(chunks(spark, range(4))).write.parquet(str(tmp_path / "p"))
    flat = FlatTable(spark, str(tmp_path / "p"))
    assert len(seen(flat)) == 4 == flat.raw_count()
    flat.upsert(chunks(spark, [0], "new"))
    assert len(seen(flat)) == 4 and dict(seen(flat))["c0"] == "new"


class Heard(pipeline.Silent):
    def __init__(self):
        self.warnings, self.batches = [], []

    def warning(self, message):
        self.warnings.append(message)

    def counts(self, **values):
        self.batches.append(values["batch"])


@pytest.mark.parametrize("size", [None, 7, 1000])
def test_migration_in_batches(spark, tmp_path, size):
    root = str(tmp_path / "d")
    JsonlStore(spark, f"{root}/jsonl_chunks").upsert(chunks(spark, range(20)))
    (tmp_path / "d" / "jsonl_chunks" / "hash=h7").mkdir()
    (tmp_path / "d" / "jsonl_chunks" / "hash=h7" / "x.jsonl").write_text('{"chunk_id": "bad"}\nnot json\n')
    ChunkStore(spark, f"{root}/store").upsert(chunks(spark, [3, 50], "old"))
    heard = Heard()
    assert pipeline.migrate(spark, "jsonl", "store", root, batch_size=size, progress=heard) == 20
    assert seen(ChunkStore(spark, f"{root}/store")) == sorted([(f"c{i}", "text") for i in range(20)] + [("c50", "old")])
    assert heard.batches == list(range(1, 4 if size == 7 else 2)) and len(heard.warnings) == 1 and heard.warnings[0].startswith("2 ")
    assert main(["migrate", "--source", "jsonl", "--target", "flat", "--data-dir", root, "--batch-size", "0"], spark) == 1


def test_validate_another_path(spark, tmp_path):
    root = str(tmp_path / "d")
    ChunkStore(spark, f"{root}/elsewhere").upsert(chunks(spark, range(4)))
    pipeline.write_state(spark.createDataFrame([("d0", "processed", "h", None, "t"), ("d1", "processed", "h", None, "t")], "doc_id string, status string, hash string, error string, at string"), f"{root}/state")
    assert main(["validate", "--data-dir", root], spark) == 1
    assert main(["validate", "--data-dir", root, "--store-path", f"{root}/elsewhere"], spark) == 0


def test_settings_name_the_provider(spark, tmp_path):
    assert provider_for("local-hash", 300).dimensions == 300
    for bad in ("other", "json:", ":x", "json:nothing", "no_such_module:x"):
        with pytest.raises(ValueError, match="embedding_model"):
            provider_for(bad, 256)
    made = provider_for("chunkmill.operators.embed:keyed_hash", 256, "sk-key")
    assert isinstance(made, HashEmbedding) and made.embed_batch(["a b"]) != HashEmbedding(256).embed_batch(["a b"])
    root = tmp_path / "d"
    (root / "extracted" / "x").mkdir(parents=True)
    (root / "extracted" / "x" / "a.xml").write_text('<html><body><main class="documentBody"><article class="legalP">One two three.</article></main></body></html>')
    (root / "state.json").write_text(json.dumps({"raw_datasets": {"x.tar.bz2": {"files": {"a.xml": {"status": "added", "sha256": "h1"}}}}}))
    run = ["process", "--data-dir", str(root), "--dataset-filter", "x", "--embedding-cache", str(tmp_path / "cache")]
    assert main([*run, "--embedding-model", "chunkmill.operators.embed:keyed_hash"], spark) == 0
    rows = ChunkStore(spark, str(root / "store")).read().collect()
    assert [r["embedding_model"] for r in rows] == [provider_for("chunkmill.operators.embed:keyed_hash", 1024).model_name()] and len(list((tmp_path / "cache").glob("*/*/_SUCCESS"))) == 1
    assert main([*run, "--embedding-model", "nothing"], spark) == 1
