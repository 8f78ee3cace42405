"""Processing state: which version of which document was processed, and what failed. Keyed rows, merged per batch."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import STATE
from ..sources.manifest import all_files, changed_files


def identify(manifest: DataFrame, state: DataFrame, force: bool = False, limit: int | None = None, compat: bool = False) -> DataFrame:
    """Files to process, in manifest order: those whose (doc_id, hash) wasn't processed; all if forced.

    Candidates are all files that aren't removed; ``compat`` takes only those that the manifest calls
    changed. A positive limit takes the first so many.
    """
    if force:
        todo = all_files(manifest)
    else:
        done = state.where("status = 'processed'").select("doc_id", "hash")
        todo = (changed_files(manifest) if compat else all_files(manifest)).join(done, ["doc_id", "hash"], "left_anti")
    return todo.orderBy("position").limit(limit) if limit is not None and limit > 0 else todo


def merge_outcomes(state: DataFrame, outcomes: DataFrame, compat: bool = False) -> DataFrame:
    """State after outcomes (doc_id, hash, error, at): success replaces all of a document's rows.

    A failure replaces the failed row, and clears the processed one unless ``compat`` keeps it.
    """
    new = outcomes.select("doc_id", F.when(F.col("error").isNull(), "processed").otherwise("failed").alias("status"), "hash", "error", "at")
    gone = new.select("doc_id", F.col("status").alias("new_status"))
    if compat:
        keep = (F.col("new_status") == "failed") & (F.col("status") == "processed")
        kept = state.join(gone, "doc_id", "left").where(F.col("new_status").isNull() | keep).drop("new_status")
    else:
        kept = state.join(gone, "doc_id", "left_anti")
    return kept.select(*STATE.names).unionByName(new.select(*STATE.names))


def remove_documents(state: DataFrame, removed: DataFrame) -> DataFrame:
    return state.join(removed.select("doc_id").distinct(), "doc_id", "left_anti")


def statistics(state: DataFrame) -> DataFrame:
    return state.agg(F.count_if(F.col("status") == "processed").alias("processed"), F.count_if(F.col("status") == "failed").alias("failed"))


#: Digest tables of ids have so many rows at most, whatever the ids; each row stands for the ids of one bucket.
BUCKETS, MODULUS = 1 << 16, Decimal(1 << 64)


def digests(ids: DataFrame, column: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, low, high): the set of distinct ids of each hash bucket as a count and two 64-bit sums of hashes.

    Sums of one bucket add up, so tasks fold theirs before the shuffle, and digests of disjoint sets merge by
    adding. Ids that are repeated must be distinct first. Sums are those of two seeds, modulo 2^64.
    """
    c = F.col(column)
    parts = ids.select(F.pmod(F.xxhash64(c), F.lit(buckets)).alias("bucket"), F.xxhash64(F.lit(1), c).alias("x"), F.xxhash64(F.lit(2), c).alias("y"))
    # sums are decimals of 30 digits until they are reduced: no overflow below 10^11 ids a bucket
    total = lambda x: F.pmod(F.sum(F.col(x).cast("decimal(20,0)")), F.lit(MODULUS)).cast("decimal(20,0)")
    return parts.groupBy("bucket").agg(F.count("*").alias("n"), total("x").alias("low"), total("y").alias("high"))


def unequal_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(bucket) where two digest tables differ: at most ``BUCKETS`` rows, however many ids there are."""
    a, b = (d.select("bucket", F.struct("n", "low", "high").alias(name)) for d, name in ((left, "a"), (right, "b")))
    return a.join(b, "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def _sides(state: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The processed ids of the state and the stored ids, each once; rows without id are on neither side."""
    a = state.where("status = 'processed' and doc_id is not null").select("doc_id").distinct()
    return a, documents.where("document_id is not null").select(F.col("document_id").alias("doc_id")).distinct()


def suspects(state: DataFrame, documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, in_state, in_store) of the ids of buckets whose digests differ; the rest of both sides is equal.

    Each side is reduced to digests, a row a bucket, and only ids of unequal buckets meet in a join: with
    both sides equal none do, and with d differing ids at most the ids of d buckets. The bucket table is
    broadcast, as it has ``buckets`` rows at most.
    """
    a, b = _sides(state, documents)
    unequal = F.broadcast(unequal_buckets(digests(a, "doc_id", buckets), digests(b, "doc_id", buckets)))
    among = lambda side: side.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))).join(unequal, "bucket", "left_semi").select("doc_id")
    both = among(a).withColumn("in_state", F.lit(True)).join(among(b).withColumn("in_store", F.lit(True)), "doc_id", "full")
    return both.select("doc_id", F.coalesce("in_state", F.lit(False)).alias("in_state"), F.coalesce("in_store", F.lit(False)).alias("in_store"))


def differences(state: DataFrame, documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, side): documents that only the state ("missing") or only the store ("orphan") has. Ids of equal buckets aren't joined."""
    both = suspects(state, documents, buckets)
    return both.where("in_state <> in_store").select("doc_id", F.when(F.col("in_store"), "orphan").otherwise("missing").alias("side"))


def validation_report(state: DataFrame, documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: counts on both sides (sums of the digests' counts), counts of differences, is_consistent."""
    a, b = _sides(state, documents)
    count = lambda side, name: digests(side, "doc_id", buckets).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(name))
    found = suspects(state, documents, buckets).agg(F.count_if(~F.col("in_store")).alias("missing"), F.count_if(~F.col("in_state")).alias("orphans"))
    sums = count(a, "state_documents").crossJoin(count(b, "store_documents")).crossJoin(found)  # one row each
    return sums.withColumn("is_consistent", (F.col("missing") == 0) & (F.col("orphans") == 0))
