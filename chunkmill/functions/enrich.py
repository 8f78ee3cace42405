"""Metadata enrichment: an ordered registry of transforms over chunk rows, and the built-in ones.

An enricher takes a DataFrame and returns it with columns added; it reads optional inputs only if the
columns are there. Later enrichers override earlier ones.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
Enricher = Callable[[DataFrame], DataFrame]

#: Fixed form of a reference to a law.
REFERENCE = r'lov/[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]+(?:/[^"\s]+)?'


def _has(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def _text_of(pattern: str) -> Column:
    """Stripped leading text of the first header element that matches, null if there is none."""
    return F.nullif(F.trim(F.regexp_extract("header", pattern, 1)), F.lit(""))


def document_info(df: DataFrame) -> DataFrame:
    """title, title_short, document_date and ministries from the ``header`` markup (a dl of dd elements)."""
    if not _has(df, "header"):
        return df
    dd = r'<dd[^>]*class="{}"[^>]*>([^<]*)'
    ministries = F.regexp_extract("header", r'(?s)<dd[^>]*class="ministry"[^>]*>(.*?)</dd>', 1)
    names = F.filter(F.transform(F.regexp_extract_all(ministries, F.lit("<li[^>]*>([^<]*)"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumns(
        {
            "title": _text_of(dd.format("title")),
            "title_short": _text_of(dd.format("titleShort")),
            "document_date": F.nullif(F.regexp_extract(F.regexp_extract("header", dd.format("dokid"), 1), "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")),
            "ministries": F.when(F.size(names) > 0, names),
        }
    )


def location_info(df: DataFrame) -> DataFrame:
    """absolute_address (the url where there is none), source_url and paragraph from the chunk id."""
    number = F.regexp_extract("chunk_id", r"(?:paragraf-|§\s*)([0-9]+[a-z]?)", 1)
    out = df.withColumn("paragraph", F.when(number != "", F.concat(F.lit("§ "), number)))
    if _has(df, "address", "url"):
        out = out.withColumns({"source_url": F.nullif("url", F.lit("")), "absolute_address": F.coalesce(F.nullif("address", F.lit("")), F.nullif("url", F.lit("")))})
    return out


def hierarchy_info(df: DataFrame) -> DataFrame:
    """depth_level: how many dashes the chunk id has, if any. Given paths and parents stay as they are."""
    return df.withColumn("depth_level", F.nullif(F.length("chunk_id") - F.length(F.replace("chunk_id", F.lit("-"), F.lit(""))), F.lit(0)))


def references(df: DataFrame) -> DataFrame:
    """outgoing_refs and reference_count: links to laws if ``hrefs`` is there and not null, else references in the text."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(f"({REFERENCE})"), F.lit(1)))
    if _has(df, "hrefs"):
        found = F.when(F.col("hrefs").isNotNull(), F.filter("hrefs", lambda h: h.startswith("lov/"))).otherwise(found)
    return df.withColumn("outgoing_refs", F.when(F.size(found) > 0, found)).withColumn("reference_count", F.when(F.col("outgoing_refs").isNotNull(), F.size("outgoing_refs")))


def section_context(df: DataFrame) -> DataFrame:
    """section_heading, else the outermost of chapter_path; is_amendment if ``markup`` changes its parent."""
    out = df
    if _has(df, "chapter_path"):
        outermost = F.get("chapter_path", F.lit(0))
        out = out.withColumn("section_heading", F.coalesce("section_heading", outermost) if _has(df, "section_heading") else outermost)
    if _has(df, "markup"):
        out = out.withColumn("is_amendment", F.when(F.col("markup").rlike("<article[^>]*class=['\"]changesToParent['\"]"), True))
    return out


BUILT_IN: tuple[tuple[str, Enricher], ...] = (("document_info", document_info), ("location_info", location_info), ("hierarchy_info", hierarchy_info), ("references", references), ("section_context", section_context))


@dataclass
class Registry:
    """Enrichers by name, applied in the order in which they were added."""

    enrichers: list[tuple[str, Enricher]] = field(default_factory=lambda: list(BUILT_IN))

    def add(self, name: str, enricher: Enricher) -> None:
        self.enrichers.append((name, enricher))

    def remove(self, name: str) -> bool:
        """Removes all of that name; whether there was one."""
        before = len(self.enrichers)
        self.enrichers = [x for x in self.enrichers if x[0] != name]
        return len(self.enrichers) < before

    def names(self) -> list[str]:
        return [n for n, _ in self.enrichers]

    def enrich(self, chunks: DataFrame) -> DataFrame:
        """One that can't be planned over these columns is skipped with a warning; the rest still apply."""
        for name, enricher in self.enrichers:
            try:
                added = enricher(chunks)
                _ = added.schema
                chunks = added
            except (PySparkException, KeyError, TypeError, ValueError) as error:
                log.warning("enricher %s failed: %s", name, error)
        return chunks
