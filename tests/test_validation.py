import pytest
from pyspark.sql import functions as F

from chunkmill.operators import state as states


def sides(spark, left: list[str | None], right: list[str | None], status: str = "processed"):
    state = spark.createDataFrame([(d, status, "h", None, "t") for d in left], "doc_id string, status string, hash string, error string, at string")
    return state, spark.createDataFrame([(d,) for d in right], "document_id string")


@pytest.mark.parametrize("buckets", [1, 7, states.BUCKETS])
@pytest.mark.parametrize(("left", "right"), [([], []), (["a"], []), ([], ["a", "a"]), (["a", "b", "b", None, ""], ["b", "c", "c", None]), (["x", "y"], ["y", "x", "x"])])
def test_same_as_sets(spark, left, right, buckets):
    state, documents = sides(spark, left, right)
    a, b = set(left) - {None}, set(right) - {None}
    got = {(r["doc_id"], r["side"]) for r in states.differences(state, documents, buckets).collect()}
    assert got == {(d, "missing") for d in a - b} | {(d, "orphan") for d in b - a}
    (row,) = states.validation_report(state, documents, buckets).collect()
    assert row.asDict() == {"state_documents": len(a), "store_documents": len(b), "missing": len(a - b), "orphans": len(b - a), "is_consistent": a == b}


def test_failed_documents_are_not_expected_in_the_store(spark):
    state, documents = sides(spark, ["a"], [], status="failed")
    assert states.differences(state, documents).isEmpty() and states.validation_report(state, documents).first()["is_consistent"]


def test_rows_joined_fall_with_agreement(spark):
    name = F.concat(F.lit("d"), F.col("id").cast("string"))
    state = spark.range(20_000).select(name.alias("doc_id"), F.lit("processed").alias("status"))
    stored = lambda n: spark.range(20_000).where(F.col("id") >= n).select(name.alias("document_id"))
    met = [states.suspects(state, stored(n), 1024).count() for n in (0, 1, 20, 20_000)]
    assert met[0] == 0 and met[1] < 60 and met[2] < 20 * 60 and met[3] == 20_000
    assert states.differences(state, stored(20), 1024).count() == 20


def test_digests_of_disjoint_sets_add_up(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("i"), (F.col("id") % 3).alias("k"))
    parts = states.digests(ids.where("k = 0"), "i", 64).union(states.digests(ids.where("k > 0"), "i", 64))
    merged = parts.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.pmod(F.sum(c), F.lit(states.MODULUS)).cast("decimal(20,0)").alias(c) for c in ("low", "high")])
    assert states.unequal_buckets(merged, states.digests(ids, "i", 64)).isEmpty()
