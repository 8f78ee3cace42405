"""The runs of the engine: process, migrate, validate, status."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import TokenCounter, token_count
from ..operators import state as states
from ..operators.chunking import Limits, chunk_rows, chunk_units
from ..operators.embed import EmbeddingProvider, embed_chunks, provider_for
from ..operators.embed_cache import EmbeddingCache, embed_by_content
from ..schema import STATE
from ..sources import manifest as manifests
from ..sources.files import read_wanted
from ..sources.pull_xml import parse_needed
from ..sources.store import LAYOUTS, open_store, remove
from .metrics import Metrics, counted, watched


class Progress(Protocol):
    """What a run reports, on the driver. ``embedded`` is called from a thread of its own while the job runs."""

    def start(self, stage: str) -> None: ...

    def end(self, stage: str) -> None: ...

    def counts(self, **values: int) -> None: ...

    def files(self, total: int) -> None: ...

    def file(self, doc_id: str, current: int, total: int) -> None: ...

    def files_done(self) -> None: ...

    def embedding(self) -> None: ...

    def embedded(self, done: int, total: int) -> None:
        """Tasks, of those known so far: how many chunks there are is known when they have been made."""

    def embedding_done(self, chunks: int) -> None: ...

    def succeeded(self, doc_id: str, chunks: int) -> None: ...

    def failed(self, doc_id: str, error: str) -> None: ...

    def warning(self, message: str) -> None: ...

    def summary(self, result: Result) -> None: ...

    #: Documents that are reported one by one, in each direction; counts hold for all.
    documents: int


class Silent:
    documents = 0

    def start(self, stage: str) -> None:
        pass

    def end(self, stage: str) -> None:
        pass

    def counts(self, **values: int) -> None:
        pass

    def files(self, total: int) -> None:
        pass

    def file(self, doc_id: str, current: int, total: int) -> None:
        pass

    def files_done(self) -> None:
        pass

    def embedding(self) -> None:
        pass

    def embedded(self, done: int, total: int) -> None:
        pass

    def embedding_done(self, chunks: int) -> None:
        pass

    def succeeded(self, doc_id: str, chunks: int) -> None:
        pass

    def failed(self, doc_id: str, error: str) -> None:
        pass

    def warning(self, message: str) -> None:
        pass

    def summary(self, result: Result) -> None:
        pass


class Printed(Silent):
    documents = 20

    def start(self, stage: str) -> None:
        print(f"== {stage}")

    def counts(self, **values: int) -> None:
        print("   " + ", ".join(f"{k}: {v}" for k, v in values.items()))

    def files(self, total: int) -> None:
        print(f"   {total} files to process")

    def embedded(self, done: int, total: int) -> None:
        print(f"   {done} of {total} tasks")

    def embedding_done(self, chunks: int) -> None:
        print(f"   {chunks} chunks embedded")

    def succeeded(self, doc_id: str, chunks: int) -> None:
        print(f"   {doc_id}: {chunks} chunks")

    def failed(self, doc_id: str, error: str) -> None:
        print(f"   {doc_id} failed: {error}")

    def warning(self, message: str) -> None:
        print(f"   {message}")

    def summary(self, result: Result) -> None:
        print(f"== processed {result.processed}, failed {result.failed}, removed {result.removed}")


@dataclass(frozen=True)
class Result:
    processed: int = 0
    failed: int = 0
    removed: int = 0
    #: Figures taken in passing: units parsed, chunks, their tokens, chunks refused by the provider, and parts dropped as too large.
    units: int = 0
    chunks: int = 0
    tokens: int = 0
    refused: int = 0
    dropped_parts: int = 0


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The last complete snapshot of the state; none, or none that reads: no rows."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted((s.getPath().getName() for s in fs.listStatus(root)), reverse=True) if fs.exists(root) else []
    for name in names:
        if manifests.exists(spark, f"{path}/{name}/_SUCCESS"):
            return spark.read.schema(STATE).parquet(f"{path}/{name}")
    return spark.createDataFrame([], STATE)


def write_state(state: DataFrame, path: str) -> None:
    """A new snapshot; its name sorts after all before it."""
    state.write.parquet(f"{path}/s{datetime.now(UTC):%Y%m%dT%H%M%S%f}")


def _contents(spark: SparkSession, todo: DataFrame, staged: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, content) of the files of ``todo`` that are there, and (doc_id, error) of those that aren't. No other file is opened or listed."""
    wanted = todo.select("doc_id", "path")
    files, missing = read_wanted(spark, wanted, staged)
    gone = wanted.join(missing, "path").select("doc_id", F.concat(F.lit("File not found: "), "path").alias("error"))
    return wanted.join(files, "path").select("doc_id", "content"), gone


def _packed(files: DataFrame, todo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``_contents``, from a table (path, content). Rows that repeat a path are one file."""
    wanted, files = todo.select("doc_id", "path"), files.select("path", F.col("content").cast("binary").alias("content"))
    missing = wanted.join(files, "path", "left_anti").select("doc_id", F.concat(F.lit("File not found: "), "path").alias("error"))
    return wanted.join(files.dropDuplicates(["path"]), "path").select("doc_id", "content"), missing


def process(
    spark: SparkSession,
    settings: Settings,
    provider: EmbeddingProvider | None = None,
    progress: Progress | None = None,
    compat: bool = False,
    sync: Callable[[str, bool], None] | None = None,
    count_tokens: TokenCounter = token_count,
    corpus: tuple[DataFrame, DataFrame] | None = None,
) -> Result:
    """Brings the store up to date with the manifest, in one batch and one commit to the store.

    ``sync`` is called first with the dataset filter and whether the run is forced, to bring files and
    manifest up to date. Every chunk is embedded once, and with ``embedding_cache`` among the settings, a folder,
    every text once over all runs. A document that is missing, fails to parse or to
    embed is an outcome of its own, others aren't touched. What was stored of a document that doesn't parse
    goes; what fails to embed or isn't there keeps it (with ``compat``, what fails to embed loses it, too). New rows and deletions are one version of the store, and the state is written
    after it, so a run that breaks off leaves what was there, and the next one does its work again.

    ``corpus`` is (manifest, files as (path, content)): large collections are better kept as a few tables
    than as many small files. Without it both are read below ``settings.data_dir``.
    """
    progress, provider = progress or Silent(), provider or provider_for(settings.embedding_model, settings.embedding_dimensions, settings.api_key)
    root = settings.data_dir.rstrip("/")
    progress.start("sync")
    if sync is not None:
        sync(settings.dataset_filter, settings.force)
    if corpus is None and not manifests.exists(spark, f"{root}/state.json"):
        raise RuntimeError(f"no manifest: {root}/state.json")
    store, state_path = open_store(spark, root, settings.storage), f"{root}/state"
    store.read().limit(1).count()  # a store that can't be read fails the run before anything is done
    manifest = manifests.read_manifest(spark, root) if corpus is None else corpus[0]
    state = read_state(spark, state_path)
    progress.counts(**manifests.sync_statistics(manifest).first().asDict())
    progress.end("sync")

    progress.start("identify")
    todo = states.identify(manifest, state, settings.force, settings.limit, compat).cache()
    kept = [todo]
    staged = f"{root}/staging/{uuid.uuid4().hex}"
    try:
        count = todo.count()
        progress.counts(changed=count)
        progress.end("identify")
        removed = manifests.removed_files(manifest)
        gone = removed.select(F.col("doc_id").alias("document_id"))
        had = store.read().join(gone, "document_id", "left_semi").select("document_id").distinct().count()
        processed = failed = 0
        taken: dict[str, int] = {}
        if count:
            progress.start("parse, chunk, embed")
            progress.files(count)
            metrics, parsed = Metrics(), F.count_if(F.col("error").isNull())
            contents, missing = _contents(spark, todo, f"{staged}-wanted") if corpus is None else _packed(corpus[1], todo)
            limits = Limits(settings.chunk_target_tokens, settings.chunk_max_tokens, settings.chunk_min_tokens, settings.chunk_overlap_ratio)
            units = metrics.of(parse_needed(contents.withColumnRenamed("doc_id", "document_id"), limits.maximum), units=parsed).cache()
            kept.append(units)
            chunks = chunk_rows(chunk_units(units, limits, count_tokens, compat, metrics.of), todo, compat)
            progress.embedding()
            with watched(spark, progress.embedded):
                if settings.embedding_cache:
                    made = embed_by_content(chunks, provider, EmbeddingCache(spark, settings.embedding_cache), f"{staged}-vectors", settings.batch_size, keep_refs=not compat)
                else:
                    made = embed_chunks(chunks, provider, settings.batch_size, keep_refs=not compat, errors=True)
                metrics.of(made, chunks=F.count("*"), tokens=F.sum("token_count"), refused=F.count("error")).write.parquet(staged)
            taken = metrics.read()
            if not taken["chunks"]:
                taken |= counted(lambda observe: chunk_units(observe(units, units=parsed), limits, count_tokens, compat, observe))
            progress.embedding_done(taken["chunks"] - taken["refused"])
            embedded = spark.read.parquet(staged)
            errors = units.where("error is not null").select(F.col("document_id").alias("doc_id"), "error").unionByName(missing)
            errors = errors.unionByName(embedded.where("error is not null").groupBy(F.col("document_id").alias("doc_id")).agg(F.min("error").alias("error")))
            now = datetime.now(UTC).isoformat()
            outcomes = todo.join(errors, "doc_id", "left").select("doc_id", "hash", "error", F.lit(now).alias("at")).cache()
            kept.append(outcomes)
            # as a rule no chunk is of a document that failed: names alone tell, so that whole rows aren't shuffled for it
            bad = outcomes.where("error is not null").select(F.col("doc_id").alias("document_id"))
            left_out = not bad.isEmpty() and not embedded.select("document_id").join(bad, "document_id", "left_semi").isEmpty()
            rows = (embedded.join(bad, "document_id", "left_anti") if left_out else embedded).drop("error")
            # what is replaced goes with the commit, documents that became empty or failed included
            replaced = outcomes.where("error is not null") if compat else outcomes
            if not compat:
                replaced = replaced.join(embedded.where("error is not null").select(F.col("document_id").alias("doc_id")).distinct(), "doc_id", "left_anti")
            replaced = replaced.join(missing.select("doc_id"), "doc_id", "left_anti").select(F.col("doc_id").alias("document_id"))
            # chunks are made where a document's units met, and were staged as they were made; vectors by content are joined to them
            store.replace(rows, replaced.union(gone), "chunk_id" if compat else "document_id", together=not settings.embedding_cache)
            state = states.merge_outcomes(state, outcomes, compat)
            sums = outcomes.agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("bad")).first()
            processed, failed = sums["ok"], sums["bad"]
            _report(progress, outcomes, rows, processed + failed)
            progress.files_done()
            progress.counts(processed=processed, failed=failed, **taken)
            progress.end("parse, chunk, embed")
        elif had:
            store.replace(None, gone)

        progress.start("clean up")
        state = states.remove_documents(state, removed)
        write_state(state, state_path)
        progress.counts(removed=had)
        progress.end("clean up")
    finally:
        for df in kept:
            df.unpersist()
        remove(spark, staged)
        remove(spark, f"{staged}-wanted")
        remove(spark, f"{staged}-vectors")
    result = Result(processed, failed, had, **taken)
    progress.summary(result)
    return result


def _report(progress: Progress, outcomes: DataFrame, rows: DataFrame, total: int) -> None:
    """The first documents of either outcome, as many as ``progress`` takes."""
    if not progress.documents:
        return
    numbers = iter(range(1, total + 1))
    for r in outcomes.where("error is not null").orderBy("doc_id").limit(progress.documents).collect():
        progress.file(r["doc_id"], next(numbers), total)
        progress.failed(r["doc_id"], r["error"])
    counts = rows.groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n"))
    for r in outcomes.where("error is null").join(counts, "doc_id", "left").orderBy("doc_id").limit(progress.documents).collect():
        progress.file(r["doc_id"], next(numbers), total)
        if r["n"]:
            progress.succeeded(r["doc_id"], r["n"])
        else:
            progress.warning(f"{r['doc_id']} has no chunks")


def migrate(
    spark: SparkSession, source: str, target: str, data_dir: str, source_path: str | None = None, target_path: str | None = None, batch_size: int | None = None, progress: Progress | None = None
) -> int:
    """Copies all chunks between layouts, ``jsonl`` (by hash), ``flat`` (a Parquet table) and ``store``; how many.

    Rows of the target with other ids stay, rows with equal ids are replaced. Without ``batch_size`` all is one
    commit; with it each commit has about so many rows, and a migration that breaks off keeps its commits. A
    batch reads the source again, so it is for targets that can't take all at once. Rows that aren't valid are
    warnings.
    """
    if source == target or {source, target} - set(LAYOUTS):
        raise ValueError(f"source and target are two of {', '.join(LAYOUTS)}")
    if batch_size is not None and batch_size < 1:
        raise ValueError(f"batch_size is 1 or more, not {batch_size}")
    progress, have, into = progress or Silent(), open_store(spark, data_dir, source, source_path), open_store(spark, data_dir, target, target_path)
    rows = have.read()
    count = rows.count()
    lost = have.raw_count() - count
    if lost > 0:
        progress.warning(f"{lost} rows of the source aren't valid and are left out")
    batches = 1 if batch_size is None else max(1, -(-count // batch_size))
    progress.start("migrate")
    for k in range(batches):
        into.upsert(rows if batches == 1 else rows.where(F.pmod(F.xxhash64("chunk_id"), F.lit(batches)) == k), "chunk_id")
        progress.counts(batch=k + 1, batches=batches)
    progress.end("migrate")
    return count


def validate(spark: SparkSession, data_dir: str, layout: str = "store", store_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(report of one row, differences) between state and store, which is below ``data_dir`` if no path of its own is given."""
    root = data_dir.rstrip("/")
    state, ids = read_state(spark, f"{root}/state"), open_store(spark, root, layout, store_path).document_ids()
    return states.validation_report(state, ids), states.differences(state, ids)


def status(spark: SparkSession, data_dir: str) -> DataFrame:
    return states.statistics(read_state(spark, f"{data_dir.rstrip('/')}/state"))
