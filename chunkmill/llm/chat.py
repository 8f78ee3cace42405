"""Chat formatting: every dialogue is rendered once from the perspective of each participant.

Native. In a perspective that speaker is the assistant, whose words alone carry the training mask; the
others are users with their names. System turns are context for everyone and nobody's perspective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Turn numbers of one row. A longer dialogue is several rows, so one that holds a third of all turns is dealt to many tasks.
WINDOW_TURNS = 64
#: Parts whose offsets are summed in one group, before the sums of these groups are.
BLOCK_PARTS = 64
ASSISTANT, SYSTEM, USER, END = "<|assistant|>\n", "<|system|>\n", ("<|user:", "|>\n"), "<|end|>"


def _offsets(plain: DataFrame, system: str) -> DataFrame:
    """(conv, part, perspective, begin): of dialogues of several parts, where each part starts in the rendering of each speaker."""
    long = plain.groupBy("conv").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("conv")
    # exact repeats count once; the same turn of the same role is known by its text's length and hash
    turns = plain.select("conv", "part", "turn", "role", F.char_length("text").alias("chars"), F.xxhash64("text").alias("hash")).distinct()
    sums = turns.groupBy("conv", "part", "role").agg(F.count("*").alias("n"), F.sum(F.col("chars") + len(END) + 1).alias("chars"))
    sums = stage(sums.join(long, "conv", "left_semi"), "dialogues")
    # lengths for others, with what a speaker's own turns are longer by
    as_user = F.char_length("role") + sum(map(len, USER))
    other = F.when(F.col("role") == system, F.lit(len(SYSTEM))).otherwise(as_user)
    sums = sums.withColumn("block", F.floor(F.col("part") / BLOCK_PARTS)).withColumns({"length": F.col("chars") + F.col("n") * other, "more": F.col("n") * (len(ASSISTANT) - as_user)})
    length = sums.groupBy("conv", "block", "part").agg(F.sum("length").alias("length"))
    views = sums.where(F.col("role") != system).select("conv", F.col("role").alias("perspective")).distinct().join(length.select("conv", "block").distinct(), "conv")
    own = sums.select("conv", "part", F.col("role").alias("perspective"), "more")
    grid = length.join(views, ["conv", "block"]).join(own, ["conv", "part", "perspective"], "left").withColumn("length", F.col("length") + F.coalesce("more", F.lit(0)))
    ahead = lambda w: F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = grid.select("conv", "block", "perspective", "part", ahead(Window.partitionBy("conv", "perspective", "block").orderBy("part")).alias("within"))
    blocks = grid.groupBy("conv", "perspective", "block").agg(F.sum("length").alias("length"))
    blocks = blocks.select("conv", "perspective", "block", ahead(Window.partitionBy("conv", "perspective").orderBy("block")).alias("before"))
    return within.join(blocks, ["conv", "perspective", "block"]).select("conv", "part", "perspective", (F.col("before") + F.col("within")).alias("begin"))


def rotate_perspectives(turns: DataFrame, *, window_turns: int = WINDOW_TURNS, system: str = "system", id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, perspective, n_turns, n_masked, rendered, mask): rows that make up each rendering.

    A dialogue is rendered from the view of each speaker that it has anywhere. A turn is rendered as
    ``<|assistant|>``, ``<|system|>`` or ``<|user:NAME|>``, a newline, the text, ``<|end|>`` and a newline.
    A row is a piece of that, the turns of part ``turn div window_turns``: the pieces of a perspective put
    together by part are the rendering of the whole dialogue. Every speaker has every part, if it is
    silent there, too. ``mask`` lists start:end of what is trained on, in code points of the whole
    rendering, end exclusive: the text and end mark of each assistant turn. Offsets run on from part to part.

    Scale: the turns of a part are one group, the parts of a dialogue are not. Each part is gathered
    once; perspectives are made from the gathered array without another shuffle of text. Lengths of
    turns are summed by part and speaker; where a dialogue has several parts, these sums are staged and
    offsets are summed by ``BLOCK_PARTS`` parts, then over those.

    Edge cases: exact repeats of a turn count once; turns with equal numbers are ordered by role, then
    text. A null role is a speaker named "", a null text is empty, a null turn counts as 0, a null
    conv_id is a dialogue of its own. A dialogue with system turns only has no rendering. A very long text
    is one turn of one piece. Other columns are ignored; an empty table gives an empty result.
    """
    plain = turns.select(
        F.struct(F.col(id_col).alias("id")).alias("conv"),  # never null, so that a null id joins like others
        F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", F.floor(F.col("turn") / window_turns).cast("long"))
    parts = plain.groupBy("conv", "part").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("said"))
    # a dialogue of one part has the speakers of that part, from 0 on
    speakers = F.array_distinct(F.filter(F.transform("said", lambda t: t["role"]), lambda r: r != system))
    alone = F.transform(speakers, lambda r: F.struct(r.alias("perspective"), F.lit(0).cast("long").alias("begin")))
    placed = F.array(F.struct(F.col("perspective"), F.col("begin")))
    views = parts.join(_offsets(plain, system), ["conv", "part"], "left").select("conv", "part", "said", F.explode(F.when(F.col("begin").isNull(), alone).otherwise(placed)).alias("view"))
    views = views.select(F.col("conv.id").alias("conv_id"), "part", "said", "view.perspective", "view.begin")

    def head(turn):
        return F.when(turn["role"] == F.col("perspective"), F.lit(ASSISTANT)).when(turn["role"] == system, F.lit(SYSTEM)).otherwise(F.concat(F.lit(USER[0]), turn["role"], F.lit(USER[1])))

    end, close = END, END + "\n"
    turned = F.transform("said", lambda t: F.struct(head(t).alias("head"), t["text"].alias("text"), (t["role"] == F.col("perspective")).alias("own")))
    rendered = F.array_join(F.transform("turned", lambda t: F.concat(t["head"], t["text"], F.lit(close))), "")
    # a running position over the turns; each step adds its span, if it is the assistant's
    start = F.struct(F.col("begin").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state, turn):
        begin = state["at"] + F.char_length(turn["head"])
        stop = begin + F.char_length(turn["text"]) + len(end)
        spans = F.when(turn["own"], F.concat(state["spans"], F.array(F.concat_ws(":", begin.cast("string"), stop.cast("string"))))).otherwise(state["spans"])
        return F.struct((stop + 1).cast("long").alias("at"), spans.alias("spans"))

    return (
        views.withColumn("turned", turned)
        .select(
            "conv_id",
            "part",
            "perspective",
            F.size("turned").cast("long").alias("n_turns"),
            F.size(F.filter("turned", lambda t: t["own"])).cast("long").alias("n_masked"),
            rendered.alias("rendered"),
            F.array_join(F.aggregate("turned", start, step)["spans"], ",").alias("mask"),
        )
    )
