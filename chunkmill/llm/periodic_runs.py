"""Periodic runs: stretches of words that repeat with a period, four times or more.

Words of a text are named by numbers, then blocks of 2, 4, 8, ... words by the pairs of their halves'
names (Karp-Miller-Rosenberg), as long as any block occurs twice. Two positions are compared by
descending name levels, so neither hashes nor a suffix array are needed. Every run holds a point of a
grid that is spaced by its period: these points are tried for each period, and extended both ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernels import RAW_WORDS, inside, joined_words, slices, tidy, words_of

#: A run is as long as so many of its periods at least, and of so many words.
TIMES, LEAST = 4, 6
#: Grid points that are tried at a time.
_TRIED = 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def name_levels(word: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 2**k words from each position on, for k = 0, 1, ... while any block recurs.

    Equal blocks have equal names. A block that occurs once, or that the end cuts, has a negative name
    of its own; one more entry at the end is different from all.
    """
    n = len(word)
    own = -np.arange(1, n + 2)
    levels: list[np.ndarray] = []
    key, at, width = word.astype(np.int64), np.arange(n), 1
    while len(at):
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[name] > 1
        at, name = at[again], name[again]
        if not len(at):
            break
        level = own.copy()
        level[at] = name
        levels.append(level)
        at = at[at + width < n]
        at = at[level[at + width] >= 0]
        key = level[at] * (int(name.max()) + 1) + level[at + width]
        width *= 2
    return levels


def extend(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from ``i`` and ``j`` (> ``i``) on are equal, and how many before them."""
    ahead, behind = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, width = levels[k], 1 << k
        ahead += np.where(level[i + ahead] == level[j + ahead], width, 0)
        low = i - behind - width
        behind += np.where((low >= 0) & (level[np.maximum(low, 0)] == level[j - behind - width]), width, 0)
    return ahead, behind


def runs_of(word: np.ndarray, first: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start, then period. ``word`` numbers equal words of one text alike and
    words of different texts differently; text t is ``first[t]`` to ``first[t + 1]``."""
    none = np.zeros(0, np.int64)
    levels = name_levels(word)
    if not levels:
        return none, none, none
    size = np.diff(first)
    periods = size // times * (size >= least)
    text, period = np.repeat(np.arange(len(size)), periods), inside(np.ones(len(size), np.int64), periods)
    step = np.maximum(least, times * period) - period
    points = (size[text] - period + step - 1) // step
    ends = np.cumsum(points)
    found = np.zeros((0, 3), np.int64)
    low = 0
    while low < len(period):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _TRIED, side="right")))
        some = slice(low, high)
        n = points[some]
        q = np.repeat(period[some], n)
        i = np.repeat(first[text[some]], n) + inside(np.zeros(len(n), np.int64), n) * np.repeat(step[some], n)
        low = high
        same = levels[0][i] == levels[0][i + q]
        i, q = i[same], q[same]
        ahead, behind = extend(levels, i, i + q)
        start, end = i - behind, i + q + ahead
        long = end - start >= np.maximum(least, times * q)
        found = np.concatenate([found, np.column_stack([start, end, q])[long]])
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        # several periods of one stretch are multiples of the smallest
        new = np.ones(len(found), bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words = words_of(part.column("text"), RAW_WORDS)
            joined, offsets = joined_words(words, RAW_WORDS[1])
            n = len(words.start)
            spelled = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)])
            coded = spelled.dictionary_encode()
            number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            start, end, period = runs_of(words.doc * max(len(coded.dictionary), 1) + number, words.first)
            gone = np.zeros(n + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, end, -1)
            kept = np.cumsum(gone[:n]) == 0
            size = np.diff(offsets)
            text = joined[np.repeat(kept, size)]
            length = np.bincount(words.doc[kept], size[kept], len(part)).astype(np.int64)
            ends = np.cumsum(length)
            # the space after a text's last word is no part of it
            text = np.delete(text, ends[length > 0] - 1)
            bounds = np.concatenate([[0], np.cumsum(np.maximum(length - 1, 0))])
            of = np.searchsorted(words.first, start, side="right") - 1
            run = pa.StructArray.from_arrays([pa.array(start - words.first[of]), pa.array(end - start), pa.array(period)], fields=list(_RUN))
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(part) + 1)), pa.int32()), run)
            texts = pa.Array.from_buffers(pa.large_string(), len(part), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.count), runs, texts], names=["doc_id", "n_words", "runs", "text"])


def collapse_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length, period in words, by start, then period), text.

    A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``TIMES`` periods long, that
    cannot be extended. ``text`` has the words left, joined by one space, when each run is cut to its first period.

    One pass over the texts: no shuffle, nothing gathered. A text of n words has some n / 3 * ln(n / 4) grid points,
    tried a block at a time; names take 8 bytes a word and level, and there are as many levels as the longest stretch
    that recurs in a text has doublings (few in prose, log2(n) where a text is one run). Null and blank texts
    have no words, no runs and an empty text. Null and repeated doc_ids are rows like others; other columns
    are ignored; an empty table gives an empty result.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(tidy(_rows), f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, text string")
