"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix, and write tokens."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkmill.llm import common, decontaminate, mixing, near_dedup, quality_rules
from chunkmill.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_path, written_tokens

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, id, body): rows as structs, so that no column of theirs meets a name used here."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body"))


def _matching(docs: DataFrame, verdicts: DataFrame, *more: str) -> DataFrame:
    """(row, id, body, ``more``) of the rows whose doc_id and text are among ``verdicts`` (doc_id, body, distinct)."""
    v = verdicts.select(F.col("doc_id").alias("v_id"), F.col("body").alias("v_body"), *more)
    return _keyed(docs).join(v, F.col("id").eqNullSafe(F.col("v_id")) & (F.col("body") == F.col("v_body")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules. Texts that are null, empty or under 50 words go; repeated rows and ids are judged each by its own text."""
    kept = quality_rules.quality_verdicts(docs).where("kept").select("doc_id", "body").distinct()
    return _matching(docs, kept).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each group of near duplicates, each text of it once.

    Texts without words are in no group and stay. Rows without doc_id are in none either; of those that
    have one text, one stays.
    """
    groups = near_dedup.near_duplicates(docs)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "body").distinct()
    return _matching(docs, kept).dropDuplicates(["id", "body"]).select("row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated. Texts that are null or without words aren't; an empty benchmark leaves all."""
    hits = decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))
    kept = hits.where(~decontaminate.contaminated()).select("doc_id", "body").distinct()
    return _matching(docs, kept).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as they are in the mix: rows of a second epoch repeat those of the first.

    A text without words is drawn as its leaf's order has it, at no cost. Rows that repeat doc_id and text
    are each drawn as often as the one of them that is drawn most.
    """
    mixed = mixing.mix_sources(docs, path=mix_path(), weights=MIX_WEIGHTS, budget_share=(3, 4), max_epochs=3, seed=MIX_SEED)
    times = mixed.where("copies > 0").groupBy("doc_id", "body").agg(F.max("copies").alias("copies"))
    drawn = _matching(docs, times, "copies").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return drawn.select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token file that is written of all rows, ordered by doc_id; a null or empty text is its end id alone."""
    return written_tokens(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("source mixing", mixture),
    ("binary tokens", tokens),
]

#: Near duplicates and estimates have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables of earlier stages, and what they staged, are removed once the next one has been written."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        with common.scratch(spark):
            path = f"{common.shared_dir(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
            out = step(spark, docs, sf_dir)
            out.write.parquet(path)
        if before is not None:
            common.remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
