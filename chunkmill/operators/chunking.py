"""Units of parsed documents to chunks: splits of large units, the folds, and the choice of tier."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TokenCounter, count_each, first_truthy, let, sentences, token_count
from .folds import joined, merge_groups, sentence_windows, target_groups

_PLACE = ("paragraph_ref", "paragraph_title", "section_heading", "document_title", "chapter_path", "address", "url", "cross_refs", "ledd_number")


#: Takes rows and named aggregates of them, and gives the rows back; the aggregates are taken as they pass.
Observe = Callable[..., DataFrame]


@dataclass(frozen=True)
class Limits:
    target: int = 768
    maximum: int = 8191
    minimum: int = 300
    overlap_ratio: float = 0.15


def _windows(limits: Limits) -> Column:
    """A large unit without lists as overlapping sentence windows: array<struct<text, tokens, n>>."""

    def cut(x: Column) -> Column:
        total = lambda g: F.aggregate(F.slice(x["tokens"], g["start"] + 1, g["end"] - g["start"]), F.lit(0).cast("long"), lambda a, t: a + t)
        return F.transform(x["bounds"], lambda g, i: F.struct(joined(x["parts"], g, " ").alias("text"), total(g).alias("tokens"), (i + 1).alias("n")))

    # sentences, their counts and the windows' bounds are computed once each: the struct is bound before it is cut
    counted = F.col("_counted")
    bounds = sentence_windows(counted["tokens"], limits.target, limits.overlap_ratio)
    return let(F.struct(counted["parts"].alias("parts"), counted["tokens"].alias("tokens"), bounds.alias("bounds")), cut)


def _sentence_counts(parts: Column, count: TokenCounter) -> Column:
    return F.struct(parts.alias("parts"), count_each(parts, count, "long").alias("tokens"))


def _numbered(limits: Limits, renumber: Column) -> Column:
    """Parts within the maximum, larger ones dropped; numbered before or after the drop."""
    x = F.col("_counted")
    all_ = F.transform(x["parts"], lambda p, i: F.struct(p.alias("text"), F.get(x["tokens"], i).alias("tokens"), (i + 1).alias("n")))
    kept = F.filter(all_, lambda p: p["tokens"] <= limits.maximum)
    return F.transform(kept, lambda p, i: F.struct(p["text"].alias("text"), p["tokens"].alias("tokens"), F.when(renumber, i + 1).otherwise(p["n"]).alias("n")))


def _pieces(units: DataFrame, limits: Limits, count: TokenCounter, observe: Observe | None) -> DataFrame:
    """One row per piece of every tier, in one pass over the units: those of tiers 1 and 3 cut where they are over the maximum, those of tier 2 whole."""
    seen = observe or (lambda rows, **_: rows)
    rows = units.where("error is null").withColumn("_tokens", count(F.col("text")).cast("long"))
    listed, windowed, large = F.expr("tier = 1 and parts is not null"), F.expr("tier = 1 and parts is null"), (F.col("tier") != 2) & (F.col("_tokens") > limits.maximum)
    # null where nothing is cut, so that counters don't count what fits again
    rows = rows.withColumn("_all", F.when(large & listed, F.col("parts")).when(large, sentences(F.col("text"))))
    rows = rows.withColumn("_counted", F.when(F.col("_all").isNotNull(), _sentence_counts(F.col("_all"), count)))
    over = lambda most: F.size(F.filter("_counted.tokens", lambda t: t > most))
    rows = seen(rows, dropped_parts=F.sum(F.when(F.col("_counted").isNotNull(), F.when(windowed, over(limits.target)).otherwise(over(limits.maximum)))))
    whole = F.array(F.struct(F.col("text"), F.col("_tokens").alias("tokens"), F.lit(None).cast("int").alias("n")))
    none = F.array().cast("array<struct<text: string, tokens: bigint, n: int>>")
    cut = F.when(windowed, _windows(limits)).otherwise(_numbered(limits, renumber=F.col("tier") == 3))
    found = F.when(F.col("_counted").isNotNull(), cut).when((F.col("tier") != 2) & F.col("_tokens").isNull(), none).otherwise(whole)
    own = F.coalesce("unit_id", F.concat("paragraph_ref", F.lit("-ledd"), "ledd_number"))
    base = F.concat("paragraph_ref", F.lit("-ledd"), F.col("ledd_number").cast("string"))
    ledd = F.concat(F.lit("ledd-"), F.col("ledd_number").cast("string"))
    whole_id = F.when(F.col("tier") == 3, ledd).when(F.col("tier") == 2, F.col("unit_id")).otherwise(own)
    part_id = F.when(F.col("tier") == 3, F.concat(ledd, F.lit("-"))).when(F.col("parts").isNull(), F.concat(base, F.lit("-"))).otherwise(F.concat(base, F.lit("-part")))
    rows = rows.select("document_id", "tier", F.when(F.col("tier") == 2, F.col("section")).alias("section"), "seq", whole_id.alias("_whole"), part_id.alias("_part"), *_PLACE, F.explode(found).alias("piece"))
    return rows.select(
        "document_id", "tier", "section", "seq", F.coalesce("piece.n", F.lit(0)).alias("sub"), F.when(F.col("piece.n").isNull(), F.col("_whole")).otherwise(F.concat("_part", F.col("piece.n").cast("string"))).alias("chunk_id"),
        F.col("piece.text").alias("text"), F.col("piece.tokens").alias("tokens"), *_PLACE,
    )


def unit_pieces(units: DataFrame, limits: Limits, count: TokenCounter = token_count, observe: Observe | None = None) -> DataFrame:
    """Rows of tiers 1 and 3, cut where a unit is over the maximum: one row per piece, before merging.

    ``observe`` is given the units with the sum ``dropped_parts``: list parts and sentences of tier 3 over
    the maximum, and sentences of windows over the target, none of which is in any piece.
    """
    return _pieces(units.where("tier in (1, 3)"), limits, count, observe).drop("section")


def _no_refs() -> Column:
    return F.array().cast("array<string>")


def _all_refs(members: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(members, lambda m: F.coalesce(m["cross_refs"], _no_refs()))))


def _section_groups(u: Column, limits: Limits, compat: bool) -> Column:
    """Tier 2: a document's units, in order, grouped to the target size within each section; as pieces. ``compat`` takes the heading of the section around, and a group's first unit's references alone."""

    def chunk(g: Column) -> Column:
        members, first = F.slice(u, g["start"] + 1, g["end"] - g["start"]), F.get(u, g["start"])
        heading = F.coalesce(F.try_element_at(first["chapter_path"], F.lit(-1)), F.lit("")) if compat else first["section_heading"]
        own = {"section_heading": heading} | ({} if compat else {"cross_refs": _all_refs(members)})
        return F.struct(
            first["tier"].alias("tier"), first["section"].alias("section"), first["seq"].alias("seq"), F.lit(0).alias("sub"),
            F.concat(F.lit("section-"), F.coalesce(first["chunk_id"], F.lit("unknown"))).alias("chunk_id"), F.array_join(F.transform(members, lambda m: m["text"]), "\n\n").alias("text"), g["tokens"].alias("tokens"),
            *[own.get(c, first[c]).alias(c) for c in _PLACE],
        )

    starts = lambda x, i: (i > 0) & ~x["section"].eqNullSafe(F.get(u, i - 1)["section"])
    return F.transform(target_groups(F.transform(u, lambda x: x["tokens"]), limits.target, F.transform(u, starts)), chunk)


def _merge_pieces(pieces: DataFrame, limits: Limits, compat: bool) -> DataFrame:
    """F1 over each document's pieces, of its lowest tier that has any. One shuffle, by document, which tiers and sections share."""
    fields = ["tier", "section", "seq", "sub", "chunk_id", "text", "tokens", *_PLACE]
    lists = pieces.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("p"))
    lists = lists.withColumn("tier", F.get("p", F.lit(0))["tier"])
    lists = lists.withColumn("p", F.filter("p", lambda x: x["tier"] == F.col("tier")))
    lists = lists.withColumn("p", F.when(F.col("tier") == 2, _section_groups(F.col("p"), limits, compat)).otherwise(F.col("p")))
    groups = lists.withColumn("g", merge_groups(F.transform("p", lambda p: p["tokens"]), limits.minimum, limits.maximum))

    def chunk(g: Column) -> Column:
        members, first = F.slice("p", g["start"] + 1, g["end"] - g["start"]), F.get("p", g["start"])
        return F.struct(
            first["chunk_id"].alias("chunk_id"), F.array_join(F.transform(members, lambda m: m["text"]), "\n\n").alias("text"), g["tokens"].cast("int").alias("token_count"),
            F.when(g["end"] - g["start"] > 1, F.transform(F.slice("p", g["start"] + 2, g["end"] - g["start"] - 1), lambda m: m["chunk_id"])).alias("merged_with"), g["merged_count"].alias("merged_count"),
            *[first[c].alias(c) for c in _PLACE], _all_refs(members).alias("all_cross_refs"),
        )

    # chunks are made inside the row: exploding groups beside the pieces would copy all pieces for each group
    return groups.select("document_id", "tier", F.posexplode(F.transform("g", chunk)).alias("position", "c")).select("document_id", "tier", "position", "c.*")


def chunk_units(units: DataFrame, limits: Limits, count: TokenCounter = token_count, compat: bool = False, observe: Observe | None = None) -> DataFrame:
    """Chunks of parsed documents, with what was dropped of the place kept as extra columns. The units are read once and shuffled once."""
    return _merge_pieces(_pieces(units.where("tier in (1, 2, 3)"), limits, count, observe), limits, compat)


def chunk_rows(chunks: DataFrame, files: DataFrame, compat: bool = False) -> DataFrame:
    """Chunk rows as they are stored: ids by position, heading and address by first non-empty source."""
    heading = first_truthy(F.col("section_heading"), F.col("paragraph_title"), F.coalesce("document_title", F.lit("")))
    address = first_truthy(F.col("url"), F.coalesce("address", F.lit("")))
    refs = F.col("cross_refs") if compat else F.col("all_cross_refs")
    joined_files = chunks.join(files.select(F.col("doc_id").alias("document_id"), "dataset", "hash"), "document_id")
    return joined_files.select(
        F.concat_ws("_chunk_", "document_id", F.col("position").cast("string")).alias("chunk_id"), "document_id", F.coalesce("dataset", F.lit("")).alias("dataset_name"),
        F.col("text").alias("content"), "token_count", heading.alias("section_heading"), address.alias("absolute_address"), F.lit("none").alias("split_reason"),
        F.lit(None).cast("string").alias("parent_chunk_id"), F.coalesce("hash", F.lit("")).alias("source_hash"), F.coalesce(refs, F.array().cast("array<string>")).alias("cross_refs"),
    )
