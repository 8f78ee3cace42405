import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkmill.cli import main
from chunkmill.config import Settings
from chunkmill.functions.tokens import Vocabulary
from chunkmill.operators.chunking import Limits, chunk_units
from chunkmill.operators.embed import HashEmbedding, nearest
from chunkmill.plans import pipeline
from chunkmill.sources.legal_xml import parse_documents, parse_units
from chunkmill.sources.store import ChunkStore, read_jsonl, write_jsonl
from chunkmill.streaming.ingest import ingest_stream

UNIT = '<article class="legalP" id="{}" data-absoluteaddress="adr/{}">{}</article>'


def law(*units: str, section: bool = True) -> str:
    inside = "".join(units)
    article = f'<article class="legalArticle"><h3><span class="legalArticleValue">§ 1</span><span class="legalArticleTitle">Scope</span></h3>{inside}</article>'
    return f'<html><body><main class="documentBody"><h1>Act</h1><section class="section"><h2>Chapter</h2>{article}</section></main></body></html>'


def chunks_of(spark, content: str, limits: Limits):
    units = parse_documents(spark.createDataFrame([("d", content)], "document_id string, content string"))
    return chunk_units(units, limits).orderBy("position").collect()


def test_standard_law(spark):
    first, second = (UNIT.format(f"u{i}", i, " ".join(["word"] * 40)) for i in (1, 2))
    (chunk,) = chunks_of(spark, law(first, second), Limits(100, 500, 50))
    assert (chunk["chunk_id"], chunk["token_count"], chunk["merged_with"], chunk["merged_count"]) == ("u1", 80, ["u2"], 2)
    assert (chunk["paragraph_ref"], chunk["paragraph_title"], chunk["section_heading"], chunk["document_title"], chunk["chapter_path"]) == ("§ 1", "Scope", "Chapter", "Act", ["Chapter"])


def test_tiers(spark):
    change = '<html><body><section class="section"><h2>I</h2>' + "".join(UNIT.format(f"c{i}", i, " ".join(["w"] * 60)) for i in range(4)) + "</section></body></html>"
    rows = chunks_of(spark, change, Limits(130, 500, 50))
    assert [(r["tier"], r["chunk_id"], r["token_count"], r["section_heading"]) for r in rows] == [(2, "section-c0", 120, "I"), (2, "section-c2", 120, "I")]
    simple = '<html><main class="documentBody"><h1>Old</h1>' + UNIT.format("s1", 1, " ".join(["w"] * 60)) + "</main></html>"
    # main below the root only: html is the root here
    assert [(r["tier"], r["chunk_id"], r["document_title"]) for r in chunks_of(spark, simple, Limits(100, 500, 50))] == [(3, "ledd-1", "Old")]
    assert chunks_of(spark, "<html><body/></html>", Limits()) == []


def test_large_units(spark):
    sentences = " ".join("Nine words are in this short sentence right here." for _ in range(20))
    rows = chunks_of(spark, law(UNIT.format("u", 1, sentences)), Limits(50, 100, 10, 0.2))
    assert rows[0]["chunk_id"] == "§ 1-ledd1-1" and all(r["token_count"] <= 50 for r in rows[:-1]) and len(rows) > 4
    listed = UNIT.format("u", 1, 'Lead in. <ol><li data-name="a">' + "one " * 30 + '</li></ol><p class="leddfortsettelse">' + "two " * 30 + "</p><ul><li>" + "three " * 200 + "</li></ul>")
    rows = chunks_of(spark, law(listed), Limits(50, 50, 10))
    assert [r["chunk_id"] for r in rows] == ["§ 1-ledd1-part1", "§ 1-ledd1-part2"]
    assert rows[0]["text"].startswith("a one one") and rows[1]["text"].startswith("two two")


def test_parse_details():
    rows = parse_units("d", law(UNIT.format("u", 1, 'see <a href="lov/1">x</a> tail <ol><li data-name="1.">a<ul><li>b</li></ul></li></ol> end')).encode())
    assert rows[0]["text"] == "see x tail 1. ab\nb end" and rows[0]["cross_refs"] == ["lov/1"] and rows[0]["address"] == "adr/1"
    assert parse_units("d", b"not xml")[0]["error"].startswith("not well-formed")


@pytest.fixture
def data(tmp_path):
    def write(**files: tuple[str, str | None]) -> str:
        found = {}
        for name, (status, content) in files.items():
            found[f"{name}.xml"] = {"status": status, "sha256": str(hash(content))}
            if content is not None:
                path = tmp_path / "extracted/laws" / f"{name}.xml"
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_text(content)
        (tmp_path / "state.json").write_text(json.dumps({"raw_datasets": {"laws.tar.bz2": {"files": found}}}))
        return str(tmp_path)

    return write


def text(word: str) -> str:
    return law(UNIT.format("u", 1, " ".join([word] * 60)))


def settings(root: str, **more) -> Settings:
    return Settings(data_dir=root, embedding_dimensions=256, chunk_min_tokens=50, chunk_target_tokens=100, **more)


def test_incremental_runs(spark, data):
    root = data(doc1=("added", text("one")), doc2=("added", text("two")), doc3=("added", text("three")), bad=("added", "not xml"), gone=("added", None))
    first = pipeline.process(spark, settings(root))
    assert (first.processed, first.failed, first.removed) == (3, 2, 0)
    store = ChunkStore(spark, f"{root}/store")
    assert {r["chunk_id"] for r in store.read().collect()} == {"doc1_chunk_0", "doc2_chunk_0", "doc3_chunk_0"}
    assert main(["validate", "--data-dir", root], spark) == 0

    root = data(doc1=("unchanged", text("one")), doc2=("modified", text("changed")), doc3=("removed", None), doc4=("added", text("four")), bad=("unchanged", text("mended")))
    second = pipeline.process(spark, settings(root))
    assert (second.processed, second.failed, second.removed) == (3, 0, 1)
    rows = {r["document_id"]: r for r in store.read().collect()}
    assert set(rows) == {"doc1", "doc2", "doc4", "bad"} and rows["doc2"]["content"].startswith("changed") and rows["doc1"]["dataset_name"] == "laws"
    state = {r["doc_id"]: r["status"] for r in pipeline.read_state(spark, f"{root}/state").collect()}
    assert state == {"doc1": "processed", "doc2": "processed", "doc4": "processed", "bad": "processed", "gone": "failed"}
    assert pipeline.process(spark, settings(root)).processed == 0
    assert pipeline.process(spark, settings(root, force=True, limit=2)).processed == 2
    with pytest.raises(RuntimeError):
        pipeline.process(spark, settings(f"{root}/nowhere"))

    assert pipeline.migrate(spark, "store", "jsonl", root) == 4
    assert pipeline.migrate(spark, "jsonl", "flat", root) == 4
    assert {r["document_id"] for r in read_jsonl(spark, f"{root}/jsonl_chunks").collect()} == set(rows)
    assert main(["migrate", "--source", "flat", "--target", "flat", "--data-dir", root], spark) == 1
    store.delete_documents(spark.createDataFrame([("doc1",)], "document_id string"))
    assert main(["validate", "--data-dir", root], spark) == 1


def chunk(spark, *rows):
    fixed = ", ".join(f"'{k}' AS {k}" for k in ("dataset_name", "section_heading", "absolute_address", "split_reason", "embedding_model", "embedded_at"))
    df = spark.createDataFrame(rows, "chunk_id string, document_id string, content string, source_hash string")
    return df.selectExpr("*", fixed.split(", ")[0], *fixed.split(", ")[1:], "1 AS token_count", "array(1f, 2f) AS embedding")


def test_store_log(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "s"))
    assert store.count() == 0
    store.upsert(chunk(spark, ("a", "d1", "x", "h"), ("b", "d1", "y", "h"), ("c", "d2", "z", "h2")))
    store.upsert(chunk(spark, ("a", "d1", "new", "h")), by="chunk_id")
    assert {(r["chunk_id"], r["content"]) for r in store.read().collect()} == {("a", "new"), ("b", "y"), ("c", "z")}
    store.upsert(chunk(spark, ("a2", "d1", "only", "h")))
    assert {r["chunk_id"] for r in store.by_document("d1").collect()} == {"a2"}
    assert store.delete_documents(spark.createDataFrame([("d2",), ("",), ("none",)], "document_id string")) == 1
    store.compact()
    assert [r["chunk_id"] for r in store.read().collect()] == ["a2"]
    assert store.read(version=1).count() == 3
    write_jsonl(store.read(), str(tmp_path / "j"))
    with open(tmp_path / "j" / "hash=h" / "broken.json", "w") as f:
        f.write('\n{"chunk_id": \n{"chunk_id": "no more"}\n')
    assert read_jsonl(spark, str(tmp_path / "j")).count() == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/d1.xml").write_text(text("one"))
    store = ChunkStore(spark, str(tmp_path / "store"))
    for expected in (1, 2):
        ingest_stream(spark, str(tmp_path / "in"), store, str(tmp_path / "check"), HashEmbedding(64), Limits(100, 500, 50)).awaitTermination(120)
        assert store.count() == expected
        (tmp_path / "in/d2.xml").write_text(text("two"))


def test_settings(tmp_path):
    assert Settings.load({"limit": None}, {"CHUNK_MAX_TOKENS": "500", "other": "1"}, str(tmp_path / "none")).chunk_max_tokens == 500
    assert Settings(dataset_filter=" laws ").dataset_filter == "laws"
    for bad in ({"storage": "x"}, {"api_key": "sk-1"}, {"chunk_overlap_ratio": 0.6}, {"embedding_dimensions": 255}, {"dataset_filter": " "}, {"chunk_min_tokens": 49}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_enrichers(spark):
    from chunkmill.functions.enrich import Registry

    registry = Registry()
    registry.add("broken", lambda df: df.select("nothing"))
    registry.add("last", lambda df: df.withColumn("depth_level", F.lit(9)))
    assert registry.remove("document_info") and not registry.remove("document_info")
    row = registry.enrich(spark.createDataFrame([("a-b", "see lov/2005-05-20-28")], "chunk_id string, text string")).first()
    assert row["depth_level"] == 9 and row["outgoing_refs"] == ["lov/2005-05-20-28"] and registry.names()[-1] == "last"


def test_nearest_in_blocks_of_queries(spark):
    """More queries than a block holds give what one block gives, which is the plain top-k; no queries give nothing."""
    made = np.random.default_rng(3).normal(size=(60, 5)).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<float>").repartition(3)
    unit = made.astype(np.float64) / np.linalg.norm(made.astype(np.float64), axis=1, keepdims=True)
    scores = unit @ unit.T
    expected = {(i, int(j), n) for i in range(0, 60, 3) for n, j in enumerate([j for j in np.argsort(-scores[i], kind="stable") if j != i][:4], 1)}
    for size in (7, 10_000):
        found = nearest(vectors, vectors.where("vec_id % 3 = 0"), 4, max_queries=size)
        assert {(r["query_id"], r["id"], r["rank"]) for r in found.collect()} == expected and found.count() == len(expected)
    assert nearest(vectors, vectors.limit(0), 4).count() == 0


def flaky(path):
    """A provider that fails on texts with a word, and counts what it is given in a file; local, so that it is shipped by value."""

    class Flaky:
        def embed_batch(self, texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("refused")
            with open(path, "a") as f:
                f.write("x" * len(texts))
            return [[1.0, 0.0]] * len(texts)

        def model_name(self):
            return "flaky"

    return Flaky()


def corpus(spark, texts: dict[str, str]):
    rows = [(i, d, "laws", f"{d}.xml", f"extracted/laws/{d}.xml", "added", f"h{hash(t)}") for i, (d, t) in enumerate(texts.items())]
    manifest = spark.createDataFrame(rows, "position long, doc_id string, dataset string, relative_path string, path string, status string, hash string")
    files = [(f"extracted/laws/{d}.xml", law(*[UNIT.format(f"{d}u{i}", i, " ".join(["word"] * 80) + f" {t}") for i in range(3)])) for d, t in texts.items() if t is not None]
    return manifest, spark.createDataFrame(files, "path string, content string")


@pytest.mark.parametrize("storage", ["store", "jsonl", "flat"])
def test_process_and_validate_mean_the_same_store(spark, tmp_path, storage):
    root = tmp_path / "d"
    (root / "extracted" / "x").mkdir(parents=True)
    (root / "extracted" / "x" / "a.xml").write_text(law(UNIT.format("u", 1, " ".join(["word"] * 80))))
    (root / "state.json").write_text(json.dumps({"raw_datasets": {"x.tar.bz2": {"files": {"a.xml": {"status": "added", "sha256": "h1"}}}}}))
    assert pipeline.process(spark, Settings(data_dir=str(root), storage=storage, dataset_filter="x")).processed == 1
    report, differences = pipeline.validate(spark, str(root), storage)
    assert report.first()["is_consistent"] and differences.isEmpty()
    assert main(["validate", "--data-dir", str(root), "--storage", storage], spark) == 0


@pytest.mark.parametrize("storage", ["store", "jsonl", "flat"])
def test_failures_are_documents_own(spark, tmp_path, storage):
    settings = Settings(data_dir=str(tmp_path / "d"), storage=storage, chunk_min_tokens=60)
    provider = flaky(str(tmp_path / "calls"))
    calls = lambda: len((tmp_path / "calls").read_text())
    store = pipeline.open_store(spark, settings.data_dir, settings.storage)
    result = pipeline.process(spark, settings, provider, corpus=corpus(spark, {"a": "one", "b": "poison", "c": "three", "d": None}))
    assert (result.processed, result.failed) == (2, 2)
    assert {r["document_id"] for r in store.document_ids().collect()} == {"a", "c"} and calls() == store.count() == 6  # every chunk once
    state = {r["doc_id"]: (r["status"], r["error"]) for r in pipeline.read_state(spark, f"{settings.data_dir}/state").collect()}
    assert state["a"] == ("processed", None) and state["b"][0] == "failed" and "refused" in state["b"][1] and "not found" in state["d"][1]
    # the next run tries what failed again, and nothing else
    result = pipeline.process(spark, settings, provider, corpus=corpus(spark, {"a": "one", "b": "two", "c": "three", "d": None}))
    assert (result.processed, result.failed) == (1, 1) and calls() == store.count() == 9


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    settings = Settings(data_dir=str(tmp_path / "d"), storage="store", force=True)
    given = corpus(spark, {"a": "one", "b": "two"})
    pipeline.process(spark, settings, flaky(str(tmp_path / "calls")), corpus=given)
    store = ChunkStore(spark, f"{settings.data_dir}/store")
    had, state = sorted(store.read().collect()), sorted(pipeline.read_state(spark, f"{settings.data_dir}/state").collect())
    monkeypatch.setattr(ChunkStore, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        pipeline.process(spark, settings, flaky(str(tmp_path / "calls")), corpus=given)
    assert sorted(store.read().collect()) == had and sorted(pipeline.read_state(spark, f"{settings.data_dir}/state").collect()) == state


def test_vocabulary(spark, tmp_path):
    import public_tokenizers
    import tiktoken  # noqa: F401

    words = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", "The law applies to all.", "Å være § 3-1", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", words(F.col("t")).alias("n"), words.encode(F.col("t")).alias("ids"), words.split(F.col("t"), 3).alias("parts"))
    for r in rows.select("*", words.decode(F.col("ids")).alias("back")).collect():
        if r["t"] is None:
            assert r["n"] is None and r["parts"] is None and r["back"] is None
        else:
            assert r["n"] == len(r["ids"]) and r["back"] == r["t"] and len(r["parts"]) == -(-r["n"] // 3) and ("§" in r["t"] or "".join(r["parts"]) == r["t"])
    # as the counter of a run: tokens that words aren't, in whole units, windows of sentences and list items
    sentence = "Unquestionably antidisestablishmentarianism. " * 30
    for unit in (sentence, "<ol>" + f"<li>{sentence[:90]}</li>" * 20 + "</ol>"):
        content = law(UNIT.format("u1", 1, unit))
        units = parse_documents(spark.createDataFrame([("d", content)], "document_id string, content string"))
        chunks = chunk_units(units, Limits(60, 100, 50), words).select("text", "token_count").collect()
        assert chunks and sum(r["token_count"] for r in chunks) > 2 * sum(len(r["text"].split()) for r in chunks)


def test_refused_documents_keep_what_they_had(spark, tmp_path):
    settings, provider = Settings(data_dir=str(tmp_path / "d"), chunk_min_tokens=60), flaky(str(tmp_path / "calls"))
    stored = lambda: sorted({r["document_id"] for r in pipeline.open_store(spark, settings.data_dir, settings.storage).document_ids().collect()})
    pipeline.process(spark, settings, provider, corpus=corpus(spark, {"a": "one", "b": "two"}))
    result = pipeline.process(spark, settings, provider, corpus=corpus(spark, {"a": "other", "b": "poison"}))
    assert (result.processed, result.failed) == (1, 1) and stored() == ["a", "b"]
    pipeline.process(spark, settings, provider, compat=True, corpus=corpus(spark, {"a": "other", "b": "poison again"}))
    assert stored() == ["a"]


def test_stream_outcomes(spark, tmp_path):
    """A document that becomes empty or doesn't parse loses its chunks, one that is refused keeps them; each has its outcome."""
    store, provider = ChunkStore(spark, str(tmp_path / "s")), flaky(str(tmp_path / "calls"))
    text = lambda word: law(UNIT.format("u", 1, " ".join([word] * 80)))
    for k, given in enumerate(({"a": text("x"), "b": text("x"), "c": text("x")}, {"a": text("poison"), "b": "no markup <", "c": "<html><body/></html>"})):
        (tmp_path / f"in{k}").mkdir()
        for name, content in given.items():
            (tmp_path / f"in{k}" / f"{name}.xml").write_text(content)
        ingest_stream(spark, str(tmp_path / f"in{k}"), store, str(tmp_path / f"check{k}"), provider, Limits(100, 500, 50), outcomes=str(tmp_path / f"out{k}")).awaitTermination(120)
        seen = {r["doc_id"]: r["error"] is None for r in spark.read.parquet(f"{tmp_path}/out{k}/batch=*").collect()}
        assert seen == ({"a": True, "b": True, "c": True} if k == 0 else {"a": False, "b": False, "c": True})
    assert [r["document_id"] for r in store.document_ids().collect()] == ["a"]
