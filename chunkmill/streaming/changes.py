"""The manifest as a stream of changes: which documents to process, which to remove, with the last event of each as state.

Events may come twice, in any order and late. What came twice within the watermark is dropped before the
state; the state itself takes an event only if it is later than the last, so that replays change nothing
and the order of arrival plays no part. The same events as a batch give the same state (``current``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..sources.manifest import exists

#: What an event says: a document, its status (``removed``, or anything else for there), hash and time.
EVENT = "doc_id string, status string, hash string, at timestamp"
#: What to do about a document, as of when.
CHANGE = "doc_id string, action string, hash string, at timestamp"
PROCESS, REMOVE = "process", "remove"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _later(status: str) -> int:
    """Among events of one time, a removal is last."""
    return int(status == "removed")


class LastEvent(StatefulProcessor):
    """State of a document: the time, rank, hash of its last event; a change is what a later one alters."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, removed int, hash string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        have = self.last.get() if self.last.exists() else None
        given = [(r["micros"], _later(r["status"]), r["hash"]) for r in rows]
        if not given:
            return
        now = max(given)
        before = None if have is None else tuple(have)
        if before is not None and now <= before:
            return
        self.last.update(now)
        there = before is not None and not before[1]
        if now[1]:
            if there:
                yield Row(doc_id=key[0], action=REMOVE, hash=now[2], micros=now[0])
        elif not there or before[2] != now[2]:
            yield Row(doc_id=key[0], action=PROCESS, hash=now[2], micros=now[0])

    def close(self) -> None:
        pass


def changes(events: DataFrame, late: str | None = "7 days") -> DataFrame:
    """A stream (doc_id, action, hash, at) of what a stream of events alters, to be appended.

    Within a micro-batch only the last event of a document counts. State is one small row per document, in
    RocksDB on the executors, dealt by document. ``late`` bounds what is kept to drop repeated events; an event
    that is later than that is dropped, too. With None nothing is dropped for its age, and repeats reach the state,
    which ignores them. Events without document or time are ignored; a missing hash is empty.
    """
    spark = events.sparkSession
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    given = _cleaned(events)
    if late is not None:
        given = given.withWatermark("at", late).dropDuplicatesWithinWatermark(["doc_id", "status", "hash", "at"])
    # times travel as microseconds: state and rows give them to Python with different zones
    given = given.withColumn("micros", F.unix_micros("at"))
    found = given.groupBy("doc_id").transformWithState(LastEvent(), "doc_id string, action string, hash string, micros long", "Append", "None")
    return found.select("doc_id", "action", "hash", F.timestamp_micros("micros").alias("at"))


def _cleaned(events: DataFrame) -> DataFrame:
    return events.select("doc_id", F.coalesce("status", F.lit("")).alias("status"), F.coalesce("hash", F.lit("")).alias("hash"), "at").where("doc_id is not null and at is not null")


def write_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the changes to a table in ``path``, all that is there, and stops. A batch that is replayed replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes that were written; no rows if none were."""
    return spark.read.schema(CHANGE).parquet(f"{path}/batch=*") if exists(spark, path) else spark.createDataFrame([], CHANGE)


def after_changes(found: DataFrame) -> DataFrame:
    """(doc_id, hash): the documents that are there after all changes, with what to process."""
    last = found.groupBy("doc_id").agg(F.max(F.struct("at", (F.col("action") == REMOVE).alias("removed"), "hash")).alias("last"))
    return last.where("not last.removed").select("doc_id", "last.hash")


def current(events: DataFrame) -> DataFrame:
    """(doc_id, hash): the same from the events as a batch: the last event of each document, if it is no removal."""
    last = _cleaned(events).groupBy("doc_id").agg(F.max(F.struct("at", (F.col("status") == "removed").cast("int").alias("removed"), "hash")).alias("last"))
    return last.where("last.removed = 0").select("doc_id", "last.hash")
