"""Benchmark decontamination: a prefix-filtered set join of item windows against documents.

An item window (13 consecutive words) is the set of its 3-word shingles with their offsets. Containment
is exact, so every shingle of a window must occur and the necessary prefix is one shingle: the rarest,
by a count over all documents. Documents meet windows on that shingle alone; a length bound (the window
must fit into the text) and a positional bound (the shingle must stand at its offset) leave candidates,
which are verified by the hashes of the whole window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed
from .textkernels import ALNUM_WORDS, Words, sequence_hashes, signed, slices, tidy, words_of

SHINGLE = 3
#: Rows (a window's shingle each) up to which the benchmark side is sent to every executor: 40 MB at 40 bytes each.
MAX_BROADCAST_ROWS = 1_000_000


def _windows_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, word after the last) of every window; a shorter text is one window."""
    count = words.count
    number = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(count)), number)
    first = words.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    return doc, first, np.minimum(first + size, words.first[1:][doc])


def _item_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each window of an item and shingle in it: (item_id, window, words, shingle, offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALNUM_WORDS)
                doc, first, last = _windows_of(words, size)
                whole = signed(sequence_hashes(words.hash, first, last))
                shingles = np.maximum(last - first - SHINGLE + 1, 1)
                row = np.repeat(np.arange(len(doc)), shingles)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
                at = first[row] + offset
                shingle = signed(sequence_hashes(words.hash, at, np.minimum(at + SHINGLE, last[row])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id").take(pa.array(doc[row])), pa.array(whole[row]), pa.array((last - first)[row].astype(np.int32)), pa.array(shingle), pa.array(offset.astype(np.int32))],
                    ["item_id", "window", "words", "shingle", "offset"],
                )

    return run


def _shingles(words: Words, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: (first words, hashes) of all shingles of one text; below ``SHINGLE`` words only short items have them."""
    room = words.first[1:][words.doc] - np.arange(len(words.doc))
    for size in sizes:
        first = np.flatnonzero(room >= size)
        yield first, signed(sequence_hashes(words.hash, first, first + size))


def _count_rows(listed: np.ndarray | None, sizes: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shingle, n): occurrences in each slice of documents, of the ``listed`` (sorted) ones if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALNUM_WORDS)
                found = np.concatenate([np.zeros(0, np.int64)] + [h if listed is None else h[_among(h, listed)] for _, h in _shingles(words, sizes)])
                shingle, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(n.astype(np.int64))], ["shingle", "n"])

    return run


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Mask of the values in a sorted array. One bit per hash prefix rules out nearly all before the search."""
    if not len(listed):
        return np.zeros(len(values), dtype=bool)
    bits = np.zeros(1 << 20, dtype=bool)
    bits[listed.view(np.uint64) >> np.uint64(44)] = True
    mask = bits[values.view(np.uint64) >> np.uint64(44)]
    maybe = np.flatnonzero(mask)
    at = np.minimum(np.searchsorted(listed, values[maybe]), len(listed) - 1)
    mask[maybe] = listed[at] == values[maybe]
    return mask


class _Probe:
    """Prefix shingle -> windows, as sorted arrays: what one task needs of the benchmark."""

    def __init__(self, prefix: np.ndarray, offset: np.ndarray, size: np.ndarray, window: np.ndarray) -> None:
        order = np.argsort(prefix, kind="stable")
        self.prefix, self.offset, self.size, self.window = prefix[order], offset[order], size[order], window[order]

    def hits(self, words: Words, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, word after the last, window hash) of every verified occurrence."""
        firsts, lasts, windows = [], [], []
        for at, hashed in _shingles(words, sizes):
            near = _among(hashed, self.prefix)
            at, hashed = at[near], hashed[near]
            low, high = np.searchsorted(self.prefix, hashed, "left"), np.searchsorted(self.prefix, hashed, "right")
            each = high - low
            row = np.repeat(low, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.repeat(at, each)
            text = words.doc[at]
            first = at - self.offset[row]
            last = first + self.size[row]
            fits = (first >= words.first[:-1][text]) & (last <= words.first[1:][text])
            first, last, row = first[fits], last[fits], row[fits]
            same = signed(sequence_hashes(words.hash, first, last)) == self.window[row]
            firsts.append(first[same])
            lasts.append(last[same])
            windows.append(self.window[row][same])
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (firsts, lasts, windows))


def _hit_columns(part: pa.RecordBatch, words: Words, first: np.ndarray, last: np.ndarray, window: np.ndarray, items: dict[int, list[str]] | None) -> pa.RecordBatch:
    depth = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(depth[:-1]) > 0)])
    n_hit = covered[words.first[1:]] - covered[words.first[:-1]]
    of = [[] for _ in range(len(part))]
    for text, w in zip(words.doc[first].tolist(), window.tolist(), strict=True):
        of[text].append(w)
    lists = [sorted({i for w in set(x) for i in items[w]}) if items is not None else sorted(set(x)) for x in of]
    kind = pa.list_(pa.string() if items is not None else pa.int64())
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("body"), pa.array(words.count.astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array(lists, kind)],
        ["doc_id", "body", "n_words", "n_hit", "found"],
    )


def _probe_rows(probe: _Probe, sizes: tuple[int, ...], items: dict[int, list[str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALNUM_WORDS)
                yield _hit_columns(part, words, *probe.hits(words, sizes), items)

    return run


def _position_rows(sizes: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, body, shingle): the distinct shingles of each document, for the join on prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"), ALNUM_WORDS)
                for first, hashed in _shingles(words, sizes):
                    doc = words.doc[first]
                    order = np.lexsort((hashed, doc))
                    doc, hashed = doc[order], hashed[order]
                    new = np.ones(len(doc), dtype=bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
                    rows = pa.array(doc[new])
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("body").take(rows), pa.array(hashed[new])], ["doc_id", "body", "shingle"])

    return run


def _verify_rows(sizes: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Verifies the candidate windows listed with each document. Texts are taken one by one: lists differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                part = batch.slice(i, 1)
                words = words_of(part.column("text"), ALNUM_WORDS)
                listed = part.column("candidates")[0].values
                none = np.zeros(0, np.int64)
                first, last, window = none, none, none
                if listed is not None and len(listed):
                    fields = dict(zip((f.name for f in listed.type), listed.flatten(), strict=True))
                    column = lambda name, fields=fields: fields[name].to_numpy()
                    first, last, window = _Probe(column("shingle"), column("offset").astype(np.int64), column("words").astype(np.int64), column("window")).hits(words, sizes)
                yield _hit_columns(part, words, first, last, window, None)

    return run


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = 13, max_broadcast_rows: int = MAX_BROADCAST_ROWS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, body, n_words, n_hit, items (sorted item_ids, as strings).

    Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased. A document word
    within an occurrence of an item's window of ``window`` words is a hit; an item of fewer words, but
    not none, is one window.

    Scale: while the benchmark has at most ``max_broadcast_rows`` rows of a window and shingle (counted
    first) its prefixes go to the executors with the tasks and documents are neither shuffled nor joined:
    one scan counts shingles, one probes. Beyond that, shingles are counted and joined by shuffles, and
    documents meet their candidate windows in a join by doc_id; ``found`` items are then joined too. Both
    ways give the same rows.

    Edge cases: null and empty texts have no words; an item without words has no windows; repeated items
    and rows each count for themselves, null and repeated doc_ids too; a null item_id names no item but its
    windows still hit. A very long text is hashed block by block; what is held of it is some 50 bytes a
    word. Other columns are ignored; an empty benchmark hits nothing.
    """
    base = keyed(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    texts = items.select(F.col(item_id_col).cast("string").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    rows = texts.mapInArrow(tidy(_item_rows(window)), "item_id string, window long, words int, shingle long, offset int")
    result = f"doc_id {id_type}, body long, n_words long, n_hit long, found array<%s>"
    size = rows.agg(F.count("*").alias("n"), F.collect_set(F.least("words", F.lit(SHINGLE))).alias("sizes")).first()
    sizes = tuple(sorted(size["sizes"])) or (SHINGLE,)  # at most SHINGLE values
    small = size["n"] <= max_broadcast_rows

    if small:
        vocabulary = np.sort(rows.select("shingle").distinct().toArrow().column("shingle").to_numpy())  # bounded by the count above
        counts = base.select("text").mapInArrow(tidy(_count_rows(vocabulary, sizes)), "shingle long, n long")
    else:
        counts = base.select("text").mapInArrow(tidy(_count_rows(None, sizes)), "shingle long, n long")
    rarity = counts.groupBy("shingle").agg(F.sum("n").alias("n")).join(rows.select("shingle").distinct(), "shingle", "right").select("shingle", F.coalesce("n", F.lit(0)).alias("n"))
    prefixes = (
        rows.dropDuplicates(["window", "words", "offset"])
        .join(rarity, "shingle")
        .groupBy("window", "words")
        .agg(F.min(F.struct("n", "shingle", "offset")).alias("rarest"))
        .select("window", "words", "rarest.shingle", "rarest.offset")
    )
    if small:
        known = prefixes.toArrow()
        column = lambda name: known.column(name).to_numpy().astype(np.int64)
        of: dict[int, list[str]] = {w: [] for w in column("window").tolist()}
        named = rows.select("window", "item_id").where("item_id is not null").distinct().toArrow()
        for w, item in zip(named.column("window").to_pylist(), named.column("item_id").to_pylist(), strict=True):
            of[w].append(item)
        probe = _Probe(column("shingle"), column("offset"), column("words"), column("window"))
        return base.mapInArrow(tidy(_probe_rows(probe, sizes, of)), result % "string").withColumnRenamed("found", "items")

    candidates = (
        base.mapInArrow(tidy(_position_rows(sizes)), f"doc_id {id_type}, body long, shingle long")
        .join(prefixes, "shingle")
        .groupBy(F.col("doc_id").alias("c_id"), F.col("body").alias("c_body"))
        .agg(F.collect_set(F.struct("shingle", "offset", "words", "window")).alias("candidates"))
    )
    same = lambda a, b, c, d: F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))
    checked = base.join(candidates, same("doc_id", "c_id", "body", "c_body"), "left").select("doc_id", "body", "text", "candidates").mapInArrow(tidy(_verify_rows(sizes)), result % "long")
    names = (
        checked.select(F.col("doc_id").alias("c_id"), F.col("body").alias("c_body"), F.explode("found").alias("window"))
        .distinct()
        .join(rows.select("window", "item_id").where("item_id is not null").distinct(), "window")
        .groupBy("c_id", "c_body")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return checked.join(names, same("doc_id", "c_id", "body", "c_body"), "left").select("doc_id", "body", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """The contract's rule: hit at all, and at least one word in twenty."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
