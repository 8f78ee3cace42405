"""Line dedup: lines that recur over documents are dropped everywhere but in one document.

Native: explode, hash, count, join and reassemble, all with DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, keyed, lower_ascii, stage


def _long_lines(base: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, body, pos, k1, k2): position and 96-bit hash of every line with a long enough key."""
    lines = base.select("doc_id", "body", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = lower_ascii(F.btrim("line", F.lit(ASCII_SPACE)))
    return (
        lines.select("doc_id", "body", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "body", "pos", F.xxhash64("key").alias("k1"), F.hash("key").alias("k2"))
    )


def drop_repeated_lines(docs: DataFrame, *, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text (what is left), n_lines (before), n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of ``min_chars`` code
    points or more in ``min_docs`` documents or more lose all their lines except those of the largest
    doc_id that holds them.

    Scale: the text moves once, to meet its dropped positions; what is counted and joined is hashes.
    Counting is partial before its shuffle, so a line that a third of all documents hold is one row
    per map task. The repeated keys are staged, so that both sides of the join back onto lines are
    plain shuffles and Spark splits the partition of a hot line.

    Edge cases: a null or empty text is one empty line. Repeated rows of a doc_id count as one
    document; each loses the lines of its own text. A row without doc_id isn't counted as a document
    and never keeps a repeated line. A very long text is one row of lines, as large as itself; only the
    hashes of its lines leave it. Other columns are ignored, whatever their names; an empty table gives
    an empty result.
    """
    base = keyed(docs, id_col, text_col)
    lines = _long_lines(base, min_chars)
    repeated = (
        lines.groupBy("k1", "k2")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("k1", "k2", "keeper")
    )
    repeated = stage(repeated, "repeated")
    dropped = (
        lines.join(repeated, ["k1", "k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("d_id"), F.col("body").alias("d_body"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    split = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return (
        base.join(dropped, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("body") == F.col("d_body")), "left")
        .select("doc_id", "text", "gone", split.alias("lines"))
        .select(
            "doc_id",
            F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
