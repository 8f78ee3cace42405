import time

import pytest
from pyspark.sql import functions as F

from chunkmill.config import Settings
from chunkmill.operators.embed import HashEmbedding
from chunkmill.plans import pipeline
from chunkmill.plans.metrics import Metrics, watched

UNIT = '<article class="legalP">{}</article>'


def page(*units: str, article: bool = True) -> str:
    inner = "".join(UNIT.format(u) for u in units)
    inner = f'<article class="legalArticle"><span class="legalArticleValue">1</span>{inner}</article>' if article else inner
    return f'<html><body><main class="documentBody"><h1>T</h1>{inner}</main></body></html>'


class Heard(pipeline.Silent):
    documents = 20

    def __init__(self):
        self.calls, self.values = [], {}

    def __getattribute__(self, name):
        if name in ("start", "end", "files", "file", "files_done", "embedding", "embedded", "embedding_done", "succeeded", "failed", "warning", "summary"):
            return lambda *args: self.calls.append((name, *args))
        return super().__getattribute__(name)

    def counts(self, **values):
        self.values |= values


@pytest.mark.parametrize("cached", [False, True])
def test_a_run_reports_what_it_made_and_dropped(spark, tmp_path, cached):
    words = lambda n: " ".join(["word"] * n)
    pages = {
        "small": page(words(60), words(70)),
        "listed": page(f"<ol><li>{words(60)}</li></ol><ul><li>{words(300)}</li></ul>"),  # one part of two is over the maximum
        "windowed": page(f"{words(60)}. {words(150)}. {words(70)}."),  # a sentence is over the target
        "simple": page(f"{words(50)}. {words(250)}. {words(40)}.", article=False),  # a sentence is over the maximum
        "empty": page(),
        "bad": "no markup",
    }
    manifest = spark.createDataFrame([(i, n, "s", f"{n}.xml", f"{n}.xml", "added", n) for i, n in enumerate(pages)], "position long, doc_id string, dataset string, relative_path string, path string, status string, hash string")
    files = spark.createDataFrame([(f"{n}.xml", c) for n, c in pages.items()], "path string, content string")
    settings = Settings(data_dir=str(tmp_path), embedding_dimensions=256, chunk_max_tokens=200, chunk_target_tokens=100, chunk_min_tokens=50, embedding_cache=str(tmp_path / "cache") if cached else "")
    heard = Heard()
    result = pipeline.process(spark, settings, HashEmbedding(256), heard, corpus=(manifest, files))
    stored = pipeline.open_store(spark, str(tmp_path), "store").read()
    sums = stored.agg(F.count("*").alias("n"), F.sum("token_count").alias("t")).first()
    assert (result.processed, result.failed, result.units, result.dropped_parts) == (5, 1, 5, 3)
    assert (result.chunks, result.tokens, result.refused) == (sums["n"], sums["t"], 0)
    assert {k: heard.values[k] for k in ("units", "dropped_parts", "chunks")} == {"units": 5, "dropped_parts": 3, "chunks": sums["n"]}
    names = [c[0] for c in heard.calls]
    assert {"start", "end", "files", "file", "files_done", "embedding", "embedded", "embedding_done", "succeeded", "failed", "warning", "summary"} == set(names)
    assert ("files", 6) in heard.calls and ("embedding_done", sums["n"]) in heard.calls
    assert [c[2:] for c in heard.calls if c[0] == "file"] == [(i, 6) for i in range(1, 7)]
    assert ("warning", "empty has no chunks") in heard.calls and names.index("embedding") < names.index("embedded") < names.index("embedding_done")
    assert all(done <= total for _, done, total in (c for c in heard.calls if c[0] == "embedded"))


def test_a_run_that_keeps_nothing_still_says_what_was_dropped(spark, tmp_path):
    manifest = spark.createDataFrame([(0, "d", "s", "d.xml", "d.xml", "added", "h")], "position long, doc_id string, dataset string, relative_path string, path string, status string, hash string")
    files = spark.createDataFrame([("d.xml", page("word " * 300, article=False))], "path string, content string")
    settings = Settings(data_dir=str(tmp_path), embedding_dimensions=256, chunk_max_tokens=200, chunk_target_tokens=100, chunk_min_tokens=50)
    result = pipeline.process(spark, settings, HashEmbedding(256), corpus=(manifest, files))
    assert (result.processed, result.units, result.chunks, result.dropped_parts) == (1, 1, 0, 1)


def test_figures_of_empty_parts_are_zero(spark):
    metrics = Metrics()
    rows = metrics.of(spark.range(10), n=F.count("*"))
    none = metrics.of(spark.range(10).where("id < 0").repartition(2), m=F.count("*"), t=F.sum("id"))
    rows.union(none).groupBy("id").count().collect()
    assert metrics.read() == {"n": 10, "m": 0, "t": 0}


def test_progress_is_reported_while_a_job_runs(spark):
    def slow(batches):
        for b in batches:
            time.sleep(1.5)
            yield b

    seen = []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "outer")
    try:
        with watched(spark, lambda *x: seen.append(x), every=0.2):
            spark.range(0, 16, 1, 16).mapInArrow(slow, "id long").collect()
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "outer"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen[-1][0] == seen[-1][1] >= 16 and any(0 < done < total for done, total in seen)
