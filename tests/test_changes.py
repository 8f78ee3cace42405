"""The stream of changes against the same events as a batch: replays, late events, restarts, odd rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from chunkmill.streaming import changes as stream

BEGIN = datetime(2024, 1, 1)


def events(n: int) -> list[tuple]:
    own = random.Random(3)
    rows = [(f"d{own.randrange(n // 4)}", own.choice(("added", "modified", "unchanged", "removed")), f"h{own.randrange(3)}", BEGIN + timedelta(minutes=own.randrange(600))) for _ in range(n)]
    return rows + [("d0", None, None, BEGIN), (None, "added", "h", BEGIN), ("d1", "added", "h", None)]


@pytest.mark.parametrize("late", ["7 days", None])
def test_stream_equals_batch(spark, tmp_path, late):
    rows = events(240)
    own = random.Random(4)
    own.shuffle(rows)
    parts = [rows[k::4] for k in range(4)]
    parts[2] += own.sample(rows, 40)  # replays of events that came, and of such that come later
    files = str(tmp_path / "events")
    run = lambda: stream.write_changes(stream.changes(spark.readStream.schema(stream.EVENT).parquet(files), late), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = lambda: sorted(map(tuple, stream.after_changes(stream.read_changes(spark, str(tmp_path / "out"))).collect()))
    given = []
    for k, part in enumerate(parts):  # every part is a restart from the checkpoint
        spark.createDataFrame(part, stream.EVENT).coalesce(1).write.mode("append").parquet(files)
        given += part
        run()
        want = sorted(map(tuple, stream.current(spark.createDataFrame(given, stream.EVENT)).collect()))
        assert got() == want and (k or want)
    found = stream.read_changes(spark, str(tmp_path / "out"))
    count = found.count()
    spark.createDataFrame(own.sample(rows, 100), stream.EVENT).coalesce(1).write.mode("append").parquet(files)
    run()
    assert stream.read_changes(spark, str(tmp_path / "out")).count() == count  # replays change nothing
    actions = {(r["doc_id"], r["action"]) for r in found.collect()}
    assert {a for _, a in actions} == {stream.PROCESS, stream.REMOVE} and all((d, stream.PROCESS) in actions for d, _ in actions)


def test_very_late_events(spark, tmp_path):
    """Beyond the watermark an event is dropped, unless nothing is to be dropped."""
    for late, last in (("1 hour", "new"), (None, "new")):
        files, out = str(tmp_path / f"e{late}"), str(tmp_path / f"o{late}")
        for batch in ([("a", "added", "new", BEGIN + timedelta(days=9))], [("b", "added", "x", BEGIN), ("a", "added", "old", BEGIN)], [("c", "added", "y", BEGIN + timedelta(days=9))]):
            spark.createDataFrame(batch, stream.EVENT).coalesce(1).write.mode("append").parquet(files)
            stream.write_changes(stream.changes(spark.readStream.schema(stream.EVENT).parquet(files), late), out, str(tmp_path / f"c{late}")).awaitTermination()
        got = dict(map(tuple, stream.after_changes(stream.read_changes(spark, out)).collect()))
        assert got == ({"a": last, "c": "y"} if late else {"a": last, "b": "x", "c": "y"})
