"""The catalogue of this subpackage: one query per operator, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_tokens, chat, decontaminate, line_dedup, mixing, near_dedup, periodic_runs, pii, quality_model, quality_rules, spelling, substring_dedup, toxicity
from .common import WORD, shared_dir, table

TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 1

def mix_path() -> dict[str, Column]:
    """The tree of the catalogue and of the pipeline: domains by source number, languages, sources."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "^src([0-9]{1,6})$", 1).try_cast("int") % 3
    domain = F.when(number == 0, "web").when(number == 1, "books").when(number == 2, "forum").otherwise("other")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = ({("web",): 5, ("books",): 3, ("forum",): 2}, {("en",): 5, ("de",): 2, ("fr",): 2}, {("src0",): 2, ("src9",): 3})
MIX_SEED = 17


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", sha256(F.col("text")).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha256(F.array_join("items", ",")).alias("items_sha256"), decontaminate.contaminated().alias("contaminated")
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), path=mix_path(), weights=MIX_WEIGHTS, budget_share=(3, 4), max_epochs=3, seed=MIX_SEED)
    return out.drop("body")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii.spans_by_document(docs, pii.find_personal_data(docs))
    return out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], sha256(F.col("base_spans")).alias("base_sha256"), "spans", "n_secret", "secret_spans", "n_found")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality_model.fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality_model.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def written_tokens(docs: DataFrame) -> DataFrame:
    """Writes the blocks of ``docs`` to a new table in the shared folder and reads its digests."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    binary_tokens.write_token_blocks(docs, path, tokenizer=tokenizer_path(), vocabulary=VOCABULARY, end_id=END_ID)
    return binary_tokens.read_token_digests(spark, path)


def op8_binary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_tokens(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def id_crc(suffix: Column | None = None) -> Column:
    text = F.col("doc_id").cast("string")
    return F.crc32((text if suffix is None else F.concat(text, suffix)).cast("binary"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs``, where a tenth of the texts repeats a part of its words from some word on, as the contract states."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = docs.select("doc_id", "text", id_crc().alias("h"), F.when(id_crc() % 10 == 0, words).alias("w"))
    some = some.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("w"))
    some = some.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    some = some.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    planted = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p])), ' ')")
    return some.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.collapse_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"), sha256(listed).alias("runs_sha256"), sha256(F.col("text")).alias("collapsed_sha256"))
    return out.select(
        "doc_id", "n_runs", (-F.col("m.start")).alias("start"), F.col("m.length").alias("length"), (-F.col("m.period")).alias("period"),
        F.floor(1000 * F.col("m.length") / -F.col("m.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_crc() % 5 == 0
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def with_planted_misspellings(words: DataFrame) -> DataFrame:
    """``words`` (doc_id, word), where one of 199 by the crc32 of both lacks a code point, as the contract states."""
    h = F.coalesce(id_crc(F.concat(F.lit(":"), F.col("word"))), F.lit(1))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return words.withColumn("h", h).select(F.when(F.col("h") % 199 == 0, cut).otherwise(F.col("word")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.words_of_texts(table(spark, sf_dir, "documents"))
    return spelling.spelling_variants(with_planted_misspellings(words.where(F.char_length("word") >= 6)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_line_dedup, op2_substring_dedup, op3_decontamination, op4_source_mixing, op5_pii, op6_minhash_near_dedup, op7_quality_classifier, op8_binary_tokens, op9_chat_formatting, op10_quality_rules, op11_periodic_runs, op12_toxicity, op13_spelling_variants)
}
