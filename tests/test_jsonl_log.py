"""Transactions of the JSONL layout: nothing of a write that breaks off, all of one that commits."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chunkmill.sources import jsonl_log
from chunkmill.sources.store import JsonlStore, complete, raw_line_count, write_jsonl


def chunks(spark, ids, content="text", hashes=5):
    rows = spark.createDataFrame([(i,) for i in ids], "id int").select(
        F.concat(F.lit("c"), "id").alias("chunk_id"), F.concat(F.lit("d"), F.floor(F.col("id") / 2)).alias("document_id"), F.lit(content).alias("content"), F.lit(3).alias("token_count"),
        F.concat(F.lit("h"), F.col("id") % hashes).alias("source_hash"), F.array(F.lit(0.5).cast("float")).alias("embedding"), F.lit("m").alias("embedding_model"), F.lit("t").alias("embedded_at"),
    )
    return complete(rows)


def seen(store):
    return sorted((r["chunk_id"], r["content"]) for r in store.read().collect())


def test_rewrites_and_deletions_are_one_commit(spark, tmp_path):
    store = JsonlStore(spark, str(tmp_path / "j"))
    store.upsert(chunks(spark, range(20)))
    assert len(seen(store)) == 20 == store.raw_count()
    # documents 0 and 1 hold c0..c3; one commit rewrites d5's chunks and drops these
    old = store.read()
    store.replace(chunks(spark, [10], "new"), spark.createDataFrame([("d0",), ("d1",)], "document_id string"))
    assert len(list((tmp_path / "j" / "_log").glob("*.done"))) == 2
    assert seen(store) == sorted([("c10", "new")] + [(f"c{i}", "text") for i in range(4, 20) if i not in (10, 11)])
    assert store.raw_count() == 15 and old.count() == 20  # who reads an older commit still has its files
    assert old.unionByName(store.read()).count() == 35  # also in one query
    assert {r["chunk_id"] for r in store.by_hash("h0").collect()} == {"c5", "c10", "c15"}


def test_emptied_folders_and_vacuum(spark, tmp_path):
    store = JsonlStore(spark, str(tmp_path / "j"))
    store.upsert(chunks(spark, range(10)))
    store.upsert(chunks(spark, range(10), "again"))
    assert store.delete_documents(spark.createDataFrame([("d0",), ("d2",), ("",)], "document_id string")) == 4
    assert store.delete_documents(spark.createDataFrame([("none",)], "document_id string")) == 0
    left = seen(store)
    assert len(left) == 6 and store.by_hash("h0").isEmpty()  # c0 and c5 were all of it
    assert store.vacuum() == 0 and seen(store) == left
    assert store.vacuum(-60) > 0 and seen(store) == left and store.raw_count() == 6
    assert not list((tmp_path / "j").glob("hash=h0/*.jsonl")) and len(list((tmp_path / "j" / "_log").glob("*.all"))) == 1
    store.upsert(chunks(spark, [0], "later"))
    assert seen(store) == sorted([*left, ("c0", "later")])


def test_a_task_that_dies_leaves_all_as_it_was(spark, tmp_path):
    path = str(tmp_path / "j")
    store = JsonlStore(spark, path)
    store.upsert(chunks(spark, range(20)))
    before = seen(store)

    @F.udf("string")
    def dies(of, line):
        if of == "h3":
            raise ValueError("killed")
        return line

    lines = spark.range(4000).select(F.concat(F.lit("h"), F.col("id") % 5).alias("hash"), F.lit("{}").alias("line"))
    with pytest.raises(Exception, match="killed"):
        spark.dataSource.register(jsonl_log.JsonlFolders)
        rows = lines.repartition(3, "hash").sortWithinPartitions("hash").select("hash", dies("hash", "line").alias("line"))
        rows.write.format("jsonl_folders").mode("append").option("token", jsonl_log.next_token(path)).save(path)
    assert seen(store) == before and store.raw_count() == 20
    # files that an attempt left behind count nowhere, even beside those of a commit
    done = next(Path(path, "_log").glob("*.done")).stem
    stray = Path(path, "hash=h1", f"{done}.0-{'0' * 32}.jsonl")
    stray.write_text(next(Path(path, "hash=h1").glob("*.jsonl")).read_text())
    assert seen(store) == before and store.raw_count() == 20
    assert store.vacuum(-60) >= 1 and not stray.exists() and seen(store) == before


def test_of_two_writes_at_a_time_the_second_fails(spark, tmp_path):
    path = str(tmp_path / "j")
    store = JsonlStore(spark, path)
    store.upsert(chunks(spark, range(4)))
    token = jsonl_log.next_token(path)
    store.upsert(chunks(spark, [0], "first"))
    late = spark.createDataFrame([("h0", "{}")], "hash string, line string")
    with pytest.raises(Exception, match="committed meanwhile"):
        late.write.format("jsonl_folders").mode("append").option("token", token).save(path)
    assert dict(seen(store))["c0"] == "first"


def test_files_from_elsewhere_and_names_with_signs(spark, tmp_path):
    path = str(tmp_path / "j")
    odd = "a b+c%d/e=é"
    rows = chunks(spark, range(6)).withColumn("source_hash", F.when(F.col("chunk_id") == "c0", odd).when(F.col("chunk_id") == "c1", "").otherwise("h"))
    write_jsonl(rows, path)  # plain folders, no commits
    store = JsonlStore(spark, path)
    assert len(seen(store)) == 6 and store.by_hash(odd).count() == 1 and store.by_hash("").count() == 1
    store.upsert(rows.where("chunk_id in ('c0', 'c2')").withColumn("content", F.lit("new")))
    assert dict(seen(store)) == {"c0": "new", "c1": "text", "c2": "new", "c3": "text", "c4": "text", "c5": "text"}
    assert store.by_hash(odd).first()["content"] == "new" and raw_line_count(spark, path) == 6
    assert {p.name for p in Path(path).glob("hash=*")} == {"hash=a b+c%25d%2Fe%3Dé", "hash=unknown", "hash=h"}
    assert store.vacuum(-60) == 2 and raw_line_count(spark, path) == 6 and len(seen(store)) == 6
