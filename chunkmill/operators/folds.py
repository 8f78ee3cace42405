"""The ordered folds of chunking, over arrays of a document's units.

They are ``aggregate`` expressions, so a row is folded in place without Python. The state of F1 and F2 is
a running sum and the list of group ends; that of F3, whose stride depends on the data, a window that moves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let


def _ends_to_groups(ends: Column) -> Column:
    """[end, ...] (exclusive, ascending) -> [(start, end), ...]"""
    return F.transform(ends, lambda e, i: F.struct(F.when(i == 0, 0).otherwise(F.get(ends, i - 1)).alias("start"), e.alias("end")))


def merge_groups(tokens: Column, minimum: int, maximum: int) -> Column:
    """groups of small neighbours, as array<struct<start, end, tokens, merged_count>>.

    A group ends as soon as it has ``minimum`` tokens, or would pass ``maximum`` with one more unit of its
    mean size. One small unit left over joins the group before it, if both fit into ``maximum``; then
    merged_count stays what it was. merged_count is null for a unit that was never merged.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("len"), F.lit(0).cast("long").alias("last"), F.array().cast("array<int>").alias("ends"))

    def step(s: Column, t: Column) -> Column:
        total, length, at = s["sum"] + t, s["len"] + 1, s["at"] + 1
        flush = (total >= minimum) | (total + F.floor(total / length) > maximum)
        return F.struct(
            at.alias("at"),
            F.when(flush, F.lit(0).cast("long")).otherwise(total).alias("sum"),
            F.when(flush, 0).otherwise(length).alias("len"),
            F.when(flush, total).otherwise(s["last"]).alias("last"),
            F.when(flush, F.concat(s["ends"], F.array(at))).otherwise(s["ends"]).alias("ends"),
        )

    def finish(s: Column) -> Column:
        groups = _ends_to_groups(s["ends"])
        count = lambda g: F.when(g["end"] - g["start"] > 1, g["end"] - g["start"])
        groups = F.transform(groups, lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), count(g).alias("merged_count")))
        n, begin = s["at"], s["at"] - s["len"]
        tail = F.array(F.struct(begin.alias("start"), n.alias("end"), F.when(s["len"] > 1, s["len"]).alias("merged_count")))
        joins = (s["len"] == 1) & (s["sum"] < minimum) & (F.size(s["ends"]) > 0) & (s["last"] + s["sum"] <= maximum)
        joined = F.transform(groups, lambda g, i: F.when(i == F.size(s["ends"]) - 1, F.struct(g["start"].alias("start"), n.alias("end"), g["merged_count"].alias("merged_count"))).otherwise(g))
        return F.when(s["len"] == 0, groups).when(joins, joined).otherwise(F.concat(groups, tail))

    return let(tokens, lambda ts: _with_sums(F.aggregate(ts, start, step, finish), ts))


def target_groups(tokens: Column, target: int, breaks: Column | None = None) -> Column:
    """a group is closed before a unit that would take it past ``target``; a larger unit stands alone. ``breaks`` (array<boolean>) says before which units one is closed in any case."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("sum"), F.array().cast("array<int>").alias("ends"))

    def step(s: Column, x: Column) -> Column:
        t = x if breaks is None else x["t"]
        full = (s["sum"] + t > target) & (s["at"] > F.coalesce(F.try_element_at(s["ends"], F.lit(-1)), F.lit(0)))
        full = full if breaks is None else x["b"] | F.coalesce(full, F.lit(False))
        return F.struct((s["at"] + 1).alias("at"), F.when(full, t.cast("long")).otherwise(s["sum"] + t).alias("sum"), F.when(full, F.concat(s["ends"], F.array(s["at"]))).otherwise(s["ends"]).alias("ends"))

    def finish(s: Column) -> Column:
        ends = F.when(s["at"] > 0, F.concat(s["ends"], F.array(s["at"]))).otherwise(s["ends"])
        return F.transform(_ends_to_groups(ends), lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), (g["end"] - g["start"]).alias("merged_count")))

    steps = lambda ts: ts if breaks is None else F.zip_with(ts, breaks, lambda t, b: F.struct(t.alias("t"), b.alias("b")))
    return let(tokens, lambda ts: _with_sums(F.aggregate(steps(ts), start, step, finish), ts))


def _with_sums(groups: Column, tokens: Column) -> Column:
    total = lambda g: F.aggregate(F.slice(tokens, g["start"] + 1, g["end"] - g["start"]), F.lit(0).cast("long"), lambda a, t: a + t)
    return F.transform(groups, lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), total(g).alias("tokens"), g["merged_count"].alias("merged_count")))


def joined(texts: Column, group: Column, between: str) -> Column:
    """The group's texts in order."""
    return F.array_join(F.slice(texts, group["start"] + 1, group["end"] - group["start"]), between)


def sentence_windows(tokens: Column, target: int, overlap_ratio: float) -> Column:
    """F3 as array<struct<start, end>> over a document's sentence token counts.

    A window takes sentences while they fit into ``target``. The next starts k before its end, but one
    further on at least; k grows with the number of all sentences. A sentence over the target makes no
    window.

    A step of the fold either takes the next sentence or closes the window, so 2n steps are enough for n
    sentences. Found windows are appended to blocks of about sqrt(n): an append copies a block, not all.
    """
    n = F.size(tokens)
    back = F.greatest(F.lit(1), F.floor(n.cast("long") * int(target * overlap_ratio) / target).cast("int"))
    block = F.ceil(F.sqrt(n)).cast("int")
    bounds = "array<struct<start: int, end: int>>"
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).cast("long").alias("sum"),
        F.array().cast(bounds).alias("block"), F.array().cast(f"array<{bounds}>").alias("blocks"),
    )

    def state(s: Column, **changed: Column) -> Column:
        return F.struct(*[changed.get(name, s[name]).alias(name) for name in ("i", "j", "sum", "block", "blocks")])

    def close(s: Column) -> Column:
        to = F.greatest(s["i"] + 1, s["j"] - back)
        left = F.aggregate(F.slice(tokens, s["i"] + 1, to - s["i"]), s["sum"], lambda a, t: a - t)
        found = F.array(F.struct(s["i"].alias("start"), s["j"].alias("end")))
        makes, full = s["j"] > s["i"], F.size(s["block"]) >= block
        return state(
            s,
            i=to,
            j=F.greatest(s["j"], to),
            sum=F.when(to > s["j"], F.lit(0).cast("long")).otherwise(left),
            block=F.when(~makes, s["block"]).when(full, found).otherwise(F.concat(s["block"], found)),
            blocks=F.when(makes & full, F.concat(s["blocks"], F.array(s["block"]))).otherwise(s["blocks"]),
        )

    def step(s: Column, _: Column) -> Column:
        fits = F.coalesce(s["sum"] + F.get(tokens, s["j"]) <= target, F.lit(False))
        return F.when(s["i"] >= n, s).when(fits, state(s, j=s["j"] + 1, sum=s["sum"] + F.get(tokens, s["j"]))).otherwise(close(s))

    windows = F.aggregate(F.sequence(F.lit(1), 2 * n), start, step, lambda s: F.concat(F.flatten(s["blocks"]), s["block"]))
    return F.when(n > 0, windows).when(n == 0, F.array().cast(bounds))
