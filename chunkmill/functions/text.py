"""Text functions as Column expressions, with Unicode white space as Python's ``strip`` and ``\\s`` have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Counts tokens of a text column. The default needs no vocabulary: words, and single other characters.
TokenCounter = Callable[[Column], Column]
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once, where naming it twice or inside a lambda would compute it each time."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def count_each(texts: Column, count: TokenCounter, kind: str) -> Column:
    """The counts of an array's texts. A counter that is no expression (a UDF can't stand in a lambda) has a method ``each`` for them."""
    each = getattr(count, "each", None)
    return (each(texts) if each else F.transform(texts, count)).cast(f"array<{kind}>")


def hard_split(text: Column, size: int) -> Column:
    """The tokens in groups of ``size``, each joined by blanks: a split that heeds nothing but length."""

    def groups(tokens: Column) -> Column:
        starts = F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens), F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(size)), " "))

    return let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), groups)


def strip(text: Column) -> Column:
    # white space at the end is looked for from the end, so that long runs within cost no more than others
    return F.reverse(F.regexp_replace(F.reverse(F.regexp_replace(text, r"(?U)^\s+", "")), r"(?U)^\s+", ""))


def sentences(text: Column) -> Column:
    """Sentences end at . ! or ? before white space; blank ones are dropped."""
    return F.filter(F.transform(F.split(text, r"(?U)(?<=[.!?])\s+"), strip), lambda s: s != "")


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty; the last as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def plain_dataset(archive: Column) -> Column:
    return F.replace(archive, F.lit(".tar.bz2"), F.lit(""))
