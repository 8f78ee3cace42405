"""The approximate index against exact search: recall, the exact way, and odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkmill.operators import vector_index
from chunkmill.operators.embed import nearest
from chunkmill.operators.vector_index import VectorIndex

SF = "/root/testdata/sf0.01"


def top(df) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("blocks", [(1024, 256), (16, 5)])
def test_recall_and_the_exact_way(spark, tmp_path, monkeypatch, blocks):
    monkeypatch.setattr(vector_index, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", blocks[1])
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    queries = vectors.where("vec_id % 5 = 0")
    exact = top(nearest(vectors, queries, 10))
    index = VectorIndex.build(vectors, str(tmp_path / "index"), 64)
    assert spark.read.parquet(f"{index.path}/lists").select(F.explode("ids")).count() == vectors.count()
    whole = top(index.search(queries, 10, len(index.centres())))
    assert whole == exact
    # these vectors have no structure, so that nine in ten of the nearest lie in half of the cells
    probes = index.probes_for(queries, 10, 0.9)
    assert probes < 40
    some = top(index.search(queries, 10, probes))
    recall = np.mean([len(set(some[q]) & set(ids)) / 10 for q, ids in exact.items()])
    assert recall >= 0.9


def test_groups_of_vectors(spark, tmp_path):
    """A hot cell, copies, rows without a vector and an empty table."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(8, 12))
    rows = [(i, (base[0 if i < 400 else i % 8] + rng.normal(size=12) * 0.05).tolist()) for i in range(1000)] + [(2000 + i, [1.0] * 12) for i in range(30)] + [(3000, None), (3001, [0.0] * 12)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    index = VectorIndex.build(vectors, str(tmp_path / "index"), 8, sample=300)
    queries = vectors.where("vec_id % 20 = 3 or vec_id = 2007")
    exact, some = top(nearest(vectors, queries, 5)), top(index.search(queries, 5, 2))
    assert some.keys() == exact.keys() and np.mean([len(set(some[q]) & set(ids)) / 5 for q, ids in exact.items()]) >= 0.9
    assert index.probes_for(queries, 5, 0.9) <= 2
    assert some[2007] == [2000, 2001, 2002, 2003, 2004]
    none = VectorIndex.build(vectors.limit(0), str(tmp_path / "none"), 4)
    assert none.search(queries, 3, 2).count() == 0
