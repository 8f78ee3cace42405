"""Substring dedup: passages of 50 words or more that an earlier document also holds are removed.

Rabin-Karp hashes of every window are counted in Spark. So that the shuffle isn't a row per word, each
window first names an anchor, the least hash of the 12-word sequences in it. The anchor depends on the
window's words alone, so equal windows have equal anchors, and a window whose anchor occurs in one
document only has a count of one without being counted. Consecutive windows of one anchor travel as
one row. Where all rows of an anchor are equal, as in exact copies, they are counted as wholes; where
they differ, equal ones are collapsed before their windows are told apart. What is found repeated
merges into maximal intervals of words, which are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, stage
from .textkernels import RAW_WORDS, Words, mix, ngram_hashes, signed, slices, sliding_min, tidy, window_starts, words_of

#: Words of the sequences among which a window takes its anchor.
ANCHOR_WORDS = 12
#: Windows in one row at most; only periodic texts reach it.
RUN_WINDOWS = 64


def _anchored(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, their anchors, and the indices (into both) at which a run begins."""
    starts = window_starts(words, window)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), starts
    k = min(ANCHOR_WORDS, window)
    anchors = sliding_min(ngram_hashes(words.hash, k), window - k + 1)[starts]
    begins = np.ones(len(starts), dtype=bool)
    begins[1:] = (anchors[1:] != anchors[:-1]) | (words.doc[starts[1:]] != words.doc[starts[:-1]])
    runs = np.flatnonzero(begins)
    lengths = np.diff(np.append(runs, len(starts)))
    if len(lengths) and lengths.max() > RUN_WINDOWS:
        offset = np.arange(len(starts)) - np.repeat(runs, lengths)
        runs = np.flatnonzero(offset % RUN_WINDOWS == 0)
    return starts, anchors, runs


def _window_hashes(words: Words, starts: np.ndarray, window: int) -> np.ndarray:
    return ngram_hashes(words.hash, window)[starts] if len(starts) else np.zeros(0, np.uint64)


def _contents(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """One number for each run's windows in order; ``runs`` are the indices at which runs begin."""
    if not len(runs):
        return np.zeros(0, np.int64)
    lengths = np.diff(np.append(runs, len(hashes)))
    offset = np.arange(len(hashes)) - np.repeat(runs, lengths)
    return signed(np.add.reduceat(mix(hashes + offset.astype(np.uint64)), runs))


def _anchor_rows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, body, anchor, content): the distinct kinds of runs that each document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), RAW_WORDS)
                starts, anchors, runs = _anchored(words, window)
                doc, anchor, content = words.doc[starts[runs]], signed(anchors[runs]), _contents(_window_hashes(words, starts, window), runs)
                order = np.lexsort((content, anchor, doc))
                doc, anchor, content = doc[order], anchor[order], content[order]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
                rows = pa.array(doc[new])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("body").take(rows), pa.array(anchor[new]), pa.array(content[new])], ["doc_id", "body", "anchor", "content"])

    return run


def _run_rows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the runs whose anchors the row's ``anchors`` lists; those that ``several`` lists with the hashes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), RAW_WORDS)
                starts, anchors, runs = _anchored(words, window)
                doc, anchor = words.doc[starts[runs]], signed(anchors[runs])
                # a pair (document, anchor) as one number: two different pairs of one slice would have to collide
                pair = lambda d, a: mix(a.astype(np.int64).view(np.uint64) + mix(d.astype(np.uint64) + np.uint64(1)))
                pairs = pair(doc, anchor)

                def listed(name: str, part: pa.RecordBatch = part, pairs: np.ndarray = pairs, pair: Callable = pair) -> np.ndarray:
                    lists = part.column(name)
                    return np.isin(pairs, pair(np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()))

                hashes = _window_hashes(words, starts, window)
                content, lengths = _contents(hashes, runs), np.diff(np.append(runs, len(starts)))
                take, told = np.flatnonzero(listed("anchors")), listed("several")
                each = np.where(told, lengths, 0)[take]
                bounds = np.concatenate([[0], np.cumsum(each)])
                flat = signed(hashes[np.arange(bounds[-1]) - np.repeat(bounds[:-1], each) + np.repeat(runs[take], each)])
                rows = pa.array(doc[take])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(rows),
                        part.column("body").take(rows),
                        pa.array(anchor[take]),
                        pa.array(content[take]),
                        pa.array((starts[runs[take]] - words.first[doc[take]]).astype(np.int32)),
                        pa.array(lengths[take].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                    ],
                    ["doc_id", "body", "anchor", "content", "at", "n", "windows"],
                )

    return run


def _covered(hits: pa.StructArray, length: int, window: int) -> np.ndarray:
    """Mask of the words of one text under its hits."""
    at, n, offsets = (hits.field(f) for f in ("at", "n", "offsets"))
    at, n, whole = at.to_numpy(), n.to_numpy(), offsets.is_null().to_numpy(zero_copy_only=False)
    each = offsets.value_lengths().fill_null(0).to_numpy()
    starts = np.concatenate([at[whole], np.repeat(at, each) + offsets.flatten().to_numpy()])
    ends = np.concatenate([at[whole] + n[whole] + window - 1, np.repeat(at, each) + offsets.flatten().to_numpy() + window])
    depth = np.zeros(length + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def _cut_rows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Removes the words under the windows that ``hits`` lists, (at, n windows, offsets or null for all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), RAW_WORDS)
                lengths = words.count
                removed = np.zeros(len(part), dtype=np.int64)
                out = []
                hits = part.column("hits")
                for i in range(len(part)):
                    first, last = words.first[i], words.first[i + 1]
                    gone = np.zeros(lengths[i], dtype=bool)
                    if hits[i].is_valid:
                        gone = _covered(hits[i].values, int(lengths[i]), window)
                        removed[i] = gone.sum()
                    # runs of kept words, each a range of the text's bytes
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    ranges = zip(words.start[first + edges[::2]].tolist(), words.end[first + edges[1::2] - 1].tolist(), strict=True)
                    out.append(b" ".join(word for a, b in ranges for word in words.data[a:b].tobytes().split()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string()), pa.array(lengths.astype(np.int64)), pa.array(removed)],
                    ["doc_id", "text", "n_words", "n_removed"],
                )

    return run


def remove_repeated_passages(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text (kept words, one space between), n_words (before), n_removed.

    A word goes if it lies in a window of ``window`` words of its text that also starts in a document
    with a smaller doc_id. Windows are judged on the input, not on what is left.

    Scale: shuffled are one (anchor, doc_id) row per about 20 words, the window hashes of shared anchors
    whose runs differ, and the text twice by doc_id (for its runs, and for what is cut of it). Counts are partial before
    their shuffles; equal runs of copies collapse to one before they are exploded. Shared anchors,
    what documents have of them and what was judged of runs are staged, so that none is computed twice and
    their joins back are of plain shuffles, whose hot keys Spark splits. Windows are equal if their 64-bit hashes and the 64-bit hashes of their anchors are.

    Edge cases: null, empty and short texts lose nothing. A row without doc_id is neither smaller nor
    larger than others and loses nothing. Rows of one doc_id don't repeat each other. A very long text is
    hashed block by block; what is held of it is some 50 bytes a word. Other columns are ignored; an empty
    table gives an empty result.
    """
    base = keyed(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    key = f"doc_id {id_type} not null, body long not null"  # not null: no filter is inferred that would tell equal exchanges apart
    anchors = base.where(F.col("doc_id").isNotNull()).mapInArrow(tidy(_anchor_rows(window)), f"{key}, anchor long not null, content long not null")
    ends = [f(c).alias(f"{n}_{c}") for c in ("doc_id", "content") for f, n in ((F.min, "low"), (F.max, "high"))]
    shared = anchors.groupBy("anchor").agg(*ends).where("low_doc_id < high_doc_id").select("anchor", F.expr("low_content < high_content").alias("differ"))
    shared = stage(shared, "shared")
    wanted = anchors.join(shared, "anchor").groupBy("doc_id", "body").agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("differ"), F.col("anchor"))).alias("several"))
    wanted = stage(wanted, "wanted")  # read twice

    def with_texts(rows: DataFrame, how: str) -> DataFrame:
        rows = rows.withColumnsRenamed({"doc_id": "r_id", "body": "r_body"})
        return base.join(rows, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("body") == F.col("r_body")), how).drop("r_id", "r_body")

    fields = "anchor long not null, content long not null, at int not null, n int not null, windows array<long> not null"
    runs = with_texts(wanted, "inner").mapInArrow(tidy(_run_rows(window)), f"{key}, {fields}")
    kinds = runs.groupBy("anchor", "content").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("windows").alias("windows"))
    single = kinds.select("anchor", "content", "low", F.posexplode("windows").alias("offset", "hash"))
    least = single.groupBy("anchor", "hash").agg(F.min("low").alias("least"), F.max("low").alias("most")).where("least < most").select("anchor", "hash", "least")
    earlier = single.join(least, ["anchor", "hash"]).where("least < low").groupBy("anchor", "content").agg(F.collect_set("offset").alias("offsets"))
    judged = kinds.select("anchor", "content", "low", "n").join(earlier, ["anchor", "content"], "left")
    judged = stage(judged, "judged")
    hits = (
        runs.select("doc_id", "body", "anchor", "content", "at")
        .join(judged, ["anchor", "content"])
        .where("doc_id > low or offsets is not null")
        .groupBy("doc_id", "body")
        .agg(F.collect_list(F.struct("at", "n", F.expr("if(doc_id > low, null, offsets)").alias("offsets"))).alias("hits"))
    )
    return with_texts(hits, "left").mapInArrow(tidy(_cut_rows(window)), f"doc_id {id_type}, text string, n_words long, n_removed long")
