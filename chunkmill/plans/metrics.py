"""What a run reports of itself in passing: figures of rows that a job makes anyway, and its progress while it runs."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


class Metrics:
    """Named sums over DataFrames, taken by the first job that computes them whole; no job of their own.

    Figures are folded in the tasks, so the driver gets one row for each observed table. They are for
    reports: rows of a task whose output was lost and made again may count twice. Where a job finds that
    nothing is left, adaptive execution drops what was before, figures included; ``counted`` is for that case.
    """

    def __init__(self) -> None:
        self._observed: list[tuple[Observation, list[str]]] = []

    def of(self, rows: DataFrame, **figures: Column) -> DataFrame:
        """``rows``, with the aggregates ``figures`` taken of them as they pass."""
        seen = Observation()
        self._observed.append((seen, list(figures)))
        return rows.observe(seen, *[c.alias(name) for name, c in figures.items()])

    def read(self) -> dict[str, int]:
        """To be called after the job. Figures of one name add up; of a part that the planner left out as empty they are 0."""
        found: dict[str, int] = {}
        for seen, names in self._observed:
            try:
                values = seen.get
            except (AssertionError, Py4JJavaError):  # the plan that ran has no such part
                values = {}
            for name in names:
                found[name] = found.get(name, 0) + int(values.get(name) or 0)
        return found


def counted(make: Callable[[Callable[..., DataFrame]], object]) -> dict[str, int]:
    """The figures that ``make(observe)`` has taken of rows, by a job for each table that it observes."""
    found: dict[str, int] = {}

    def observe(rows: DataFrame, **figures: Column) -> DataFrame:
        row = rows.agg(*[c.alias(name) for name, c in figures.items()]).first()
        for name in figures:
            found[name] = found.get(name, 0) + int(row[name] or 0)
        return rows

    make(observe)
    return found


@contextmanager
def watched(spark: SparkSession, report: Callable[[int, int], None], every: float = 1.0) -> Iterator[None]:
    """Calls ``report`` (tasks done, tasks known so far) of the jobs that this thread starts inside, while they run and at the end."""
    context, group, over = spark.sparkContext, f"chunkmill-{uuid.uuid4().hex}", threading.Event()
    names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {name: context.getLocalProperty(name) for name in names}
    context.setJobGroup(group, before[names[1]] or "chunkmill run")
    last = (0, 0)

    def look() -> None:
        nonlocal last
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(s) for s in sorted({s for job in jobs if job for s in job.stageIds})]
        now = (sum(s.numCompletedTasks for s in stages if s), sum(s.numTasks for s in stages if s))
        if now != last:
            last = now
            report(*now)

    def poll() -> None:
        while not over.wait(every):
            look()

    thread = threading.Thread(target=poll, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        look()
        for name, value in before.items():
            context.setLocalProperty(name, value)
