"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only characters that separate words or are stripped from lines.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: One word, as a regular expression that Java, Python and DuckDB read alike.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session has none (tests on one machine) is a local temporary folder set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chunkmill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCOPES: list[list[str]] = []


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are removed at the end, when what was made of them has been written."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def stage(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet to a new table in the shared folder and read again (columns prune, unlike ``cut``).

    The table stays until the ``scratch`` around it ends; without one, until the folder is cleaned.
    """
    path = f"{shared_dir(df.sparkSession)}/{kind}-{uuid.uuid4().hex}"
    for scope in _SCOPES[-1:]:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


#: Parts that the rows of a group are dealt to when they are joined with the group's one row, from a staged table:
#: both sides of the join are plain shuffles, so Spark splits parts that are still too large.
SPREAD = 32


def salted(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with a column ``_salt`` from the hash of ``by``, so that a hot group is ``SPREAD`` join keys."""
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int"))


def per_salt(groups: DataFrame) -> DataFrame:
    """A table of one row per group, repeated for every ``_salt``."""
    return groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, text): only what the operators need, null texts empty.

    ``body`` is a hash of the text. Results are joined back on (doc_id, body), so rows that repeat a
    doc_id with another text keep their own result, and exact repeats share one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))
