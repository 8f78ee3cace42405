"""Mixing sources to target weights: hierarchical token budgets and seeded token prefixes.

Native. Weights are propagated down a tree of path columns (domain, language, source). A node gets its
share of its parent's budget, but no more than its subtree can supply; what it can't take goes to its
siblings by weight, and past the parent only if the whole subtree is used up, which capping every level
by subtree capacity brings about. A leaf runs whole epochs over its documents and then a token prefix of
one more epoch, in an order drawn from the seed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, per_salt, salted, stage

#: Parts of an epoch whose token sums are added up before the one part at the cut is sorted.
TICKET_DIGITS = 3


def _weight(weights: Mapping[tuple[str, ...], int], path: Sequence[str]) -> Column:
    """The weight of the node at ``path``: given for the path or for its last name alone, else 1."""
    known = {k: v for k, v in weights.items() if len(k) == len(path) or len(k) == 1}
    if any(v < 0 for v in known.values()):
        raise ValueError("weights are whole numbers from 0 on")
    out = F.lit(1)
    for k, v in sorted(known.items(), key=lambda x: len(x[0])):
        names = path if len(k) == len(path) else path[-1:]
        same = F.lit(True)
        for name, value in zip(names, k, strict=True):
            same = same & (F.col(name) == value)
        out = F.when(same, F.lit(v)).otherwise(out)
    return out.cast("long")


def share_budgets(leaves: DataFrame, path: Sequence[str], weights: Sequence[Mapping[tuple[str, ...], int]], budget: Column) -> DataFrame:
    """``leaves`` (path columns, tokens, capacity) with ``leaf_budget``.

    Sums are whole numbers throughout, products of tokens and weights decimals of 38 digits. Windows run over
    siblings, of which there are as many as a node has children.
    """
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  of which a product has 38 digits
    above = leaves.agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")).select(F.least("capacity", budget.cast("long")).alias("parent_budget"))
    for depth in range(1, len(path) + 1):
        here, up = list(path[:depth]), list(path[: depth - 1])
        nodes = leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(weights[depth - 1], here))
        nodes = nodes.join(above, up) if up else nodes.crossJoin(F.broadcast(above))  # one row
        siblings = Window.partitionBy(*up, "parent_budget")
        # from the node that is short first to the one that has most for its weight
        ordered = siblings.orderBy(F.col("weight") == 0, F.col("capacity") / F.nullif("weight", F.lit(0)), here[-1])
        nodes = nodes.withColumns(
            {
                "used": F.col("parent_budget") - F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                "open": F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing)),
            }
        ).withColumn("short", (F.col("weight") > 0) & (wide("capacity") * wide("open") <= wide("used") * wide("weight")))
        nodes = nodes.withColumns({"rest": F.max(F.when(~F.col("short"), F.col("used"))).over(siblings), "shares": F.max(F.when(~F.col("short"), F.col("open"))).over(siblings)})
        given = F.when(F.col("short"), F.col("capacity")).when(F.col("shares") > 0, F.expr("(cast(rest as decimal(19,0)) * cast(weight as decimal(19,0))) div shares")).otherwise(F.lit(0))
        above = nodes.select(*here, given.cast("long").alias("parent_budget"))
    return leaves.join(above.withColumnRenamed("parent_budget", "leaf_budget"), list(path))


def mix_sources(
    docs: DataFrame,
    *,
    path: Mapping[str, Column],
    weights: Sequence[Mapping[tuple[str, ...], int]],
    budget_share: tuple[int, int] = (3, 4),
    max_epochs: int = 3,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, body, the path columns, n_tokens, leaf_tokens, leaf_budget, copies.

    ``path`` names the tree's levels from the top with an expression each, ``weights`` has a mapping for
    each level. The whole budget is ``budget_share`` of all tokens; a leaf supplies its tokens at most
    ``max_epochs`` times. ``copies`` is how often the document is in the mix: once for each whole epoch,
    and once more if it lies in the token prefix of the last one, the longest that doesn't go over.

    Tokens are words between ASCII white space. Epoch e of a leaf is ordered by md5("seed:e:doc_id").

    Scale: texts are read once; sizes go to a staged table. An epoch is cut without sorting it: token
    sums over 4,096 ranges of the md5 give the range at the cut, and only its rows are sorted. Rows
    meet their leaf's budget on the leaf and a salt. So a leaf with a third of all rows is no single task.

    Edge cases: null path values count as "". A weight of 0 gives a node nothing, and leaves without
    tokens get nothing. Rows that repeat a doc_id are rows of their own; ties in md5 are taken by doc_id
    and text hash. Null texts have no tokens; of a very long text, words are counted in place. Other
    columns are ignored; an empty table gives an empty result.
    """
    levels = list(path)
    names = [F.coalesce(e.cast("string"), F.lit("")).alias(n) for n, e in path.items()]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sizes = stage(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), *names, F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens")), "sizes")

    leaves = sizes.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")).withColumn("capacity", F.col("tokens") * max_epochs)
    part, whole = budget_share
    budgets = share_budgets(leaves, levels, weights, F.expr(f"(tokens * {int(part)}) div {int(whole)}"))
    budgets = budgets.select(*levels, F.col("tokens").alias("leaf_tokens"), "leaf_budget", F.coalesce(F.expr("leaf_budget div nullif(tokens, 0)"), F.lit(0)).alias("epochs")).withColumn("rest", F.col("leaf_budget") - F.col("epochs") * F.col("leaf_tokens"))
    budgets = stage(budgets, "budgets")  # a row for each leaf

    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    drawn = salted(sizes, "doc_id", "body").join(per_salt(budgets), [*levels, "_salt"]).drop("_salt").withColumn("ticket", ticket).withColumn("range", F.substring("ticket", 1, TICKET_DIGITS))
    ranges = drawn.groupBy(*levels, "range", "rest").agg(F.sum("n_tokens").alias("range_tokens"))
    # sums ahead of a range: of the ranges that share all but its last two digits, and of those before these
    ranges = ranges.withColumn("block", F.substring("range", 1, TICKET_DIGITS - 2))
    ahead = lambda order, *by: F.coalesce(F.sum("range_tokens").over(Window.partitionBy(*levels, *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = ranges.groupBy(*levels, "block").agg(F.sum("range_tokens").alias("range_tokens")).select(*levels, "block", ahead("block").alias("earlier"))
    ranges = ranges.select(*levels, "range", "block", "range_tokens", ahead("range", "block").alias("within")).join(blocks, [*levels, "block"])
    ranges = ranges.select(*levels, "range", "range_tokens", (F.col("earlier") + F.col("within")).alias("before"))
    placed = drawn.join(ranges, [*levels, "range"]).withColumn("place", F.when(F.col("before") + F.col("range_tokens") <= F.col("rest"), 1).when(F.col("before") <= F.col("rest"), 0).otherwise(-1))
    columns = ["doc_id", "body", *levels, "n_tokens", "leaf_tokens", "leaf_budget", "epochs", "rest"]
    clear = placed.where("place <> 0").select(*columns, (F.col("place") > 0).alias("drawn"))
    within = Window.partitionBy(*levels, "range").orderBy("ticket", "doc_id", "body").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.where("place = 0").withColumn("sum", F.col("before") + F.sum("n_tokens").over(within)).select(*columns, (F.col("sum") <= F.col("rest")).alias("drawn"))
    copies = F.col("epochs") + (F.col("drawn") & (F.col("rest") > 0)).cast("long")
    return clear.unionByName(cut).select("doc_id", "body", *levels, "n_tokens", "leaf_tokens", "leaf_budget", copies.cast("long").alias("copies"))
