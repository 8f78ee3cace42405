"""Texts are embedded once for each model, and vectors meet chunks by content."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import functions as F

from chunkmill.operators.embed import HashEmbedding, embed_chunks
from chunkmill.operators.embed_cache import EmbeddingCache, embed_by_content, staged_folder
from chunkmill.sources.store import complete


def noted(folder: str, model: str = "noted"):
    """Notes each text that it gets in a file of its own, and refuses texts with ``bad``. Made here, so that workers needn't import this module."""

    class Noted(HashEmbedding):
        def embed_batch(self, texts):
            if any("bad" in t for t in texts):
                raise ValueError("refused")
            for t in texts:
                Path(folder, uuid.uuid4().hex).write_text(t)
            return HashEmbedding.embed_batch(self, texts)

        def model_name(self):
            return model

    return Noted(8)


def chunks(spark, texts):
    rows = spark.createDataFrame([(f"c{i}", f"d{i}", t) for i, t in enumerate(texts)], "chunk_id string, document_id string, content string")
    columns = {"token_count": F.lit(1), "embedding": F.array().cast("array<float>"), "embedding_model": F.lit(""), "embedded_at": F.lit("")}
    return rows.withColumns(columns | {n: F.lit("") for n in ("dataset_name", "section_heading", "absolute_address", "split_reason", "parent_chunk_id", "source_hash")} | {"cross_refs": F.array(F.lit("r"))})


def test_each_text_is_embedded_once_over_runs(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    cache, provider = EmbeddingCache(spark, str(tmp_path / "cache")), noted(str(notes))
    texts = ["one", "two", "one", "", None, *["often"] * 500]
    run = lambda given, p=provider: embed_by_content(chunks(spark, given).repartition(5), p, cache, staged_folder(str(tmp_path)), 2)
    first = {r["chunk_id"]: r for r in run(texts).collect()}
    assert sorted(p.read_text() for p in notes.iterdir()) == ["", "often", "one", "two"]
    again = {r["chunk_id"]: r for r in run(["two", "new", *texts]).collect()}
    assert sorted(p.read_text() for p in notes.iterdir()) == ["", "new", "often", "one", "two"]
    assert len(first) == len(texts) and len(again) == len(texts) + 2
    # vectors as those made chunk by chunk, with what else the rows have
    plain = {r["chunk_id"]: r for r in embed_chunks(chunks(spark, texts), HashEmbedding(8)).collect()}
    for name, r in first.items():
        assert r["embedding"] == plain[name]["embedding"] and r["content"] == plain[name]["content"] and r["error"] is None
        assert r["cross_refs"] == ["r"] and r["embedding_model"] == "noted"
    assert again["c0"]["embedded_at"] == first["c1"]["embedded_at"]
    # another model has its own
    run(["one"], noted(str(notes), "a/b")).collect()
    assert len(list(notes.iterdir())) == 6 and cache.read("a/b").count() == 1 and cache.read("noted").count() == 5


def test_refused_texts_are_outcomes_and_not_kept(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    cache, provider = EmbeddingCache(spark, str(tmp_path / "cache")), noted(str(notes))
    for _ in range(2):
        rows = embed_by_content(chunks(spark, ["fine", "bad one", "fine", "bad one"]), provider, cache, staged_folder(str(tmp_path)))
        found = {r["chunk_id"]: r["error"] for r in rows.collect()}
        assert found["c0"] is None is found["c2"] and "refused" in found["c1"] and "refused" in found["c3"]
    assert cache.read("noted").count() == 1 == len(list(notes.iterdir()))
    assert complete(rows.where("error is null")).count() == 2


def test_nothing_to_embed(spark, tmp_path):
    cache = EmbeddingCache(spark, str(tmp_path / "cache"))
    assert embed_by_content(chunks(spark, ["x"]).where("false"), HashEmbedding(8), cache, staged_folder(str(tmp_path))).isEmpty()
