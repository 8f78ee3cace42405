"""Vectorised text kernels shared by the Arrow-backed operators of this subpackage.

Every kernel works on the UTF-8 buffer of a whole Arrow string column at once: words are found with
a byte table, word hashes are differences of one prefix sum, and n-gram hashes are Rabin-Karp
differences of a second prefix sum.  Nothing loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes handled at a time: bounds the memory of a worker whatever the Arrow batch size is.
SLICE_BYTES = 1 << 20
#: Bytes of a slice, or of one long text, whose words are found at a time. What a word needs, some 50 bytes, is held for
#: all words of a slice; what a byte needs, as many, is held for a block.
BLOCK_BYTES = 1 << 18

_BYTE_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_WORD_BASE = U64(0xD6E8FEB86659FD93)
_MASK64 = (1 << 64) - 1


def byte_table(words_exclude: str, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is_word, mapped byte) by byte value; ``words_exclude`` lists the ASCII separators."""
    is_word = np.ones(256, dtype=bool)
    is_word[[ord(c) for c in words_exclude]] = False
    mapped = np.arange(256, dtype=np.uint8)
    if lower:
        mapped[ord("A") : ord("Z") + 1] += 32
        is_word[ord("A") : ord("Z") + 1] = is_word[ord("a") : ord("z") + 1]
    return is_word, mapped


SPACES = " \t\n\x0b\x0c\r"
#: Words between ASCII white space, unchanged.
RAW_WORDS = byte_table(SPACES, lower=False)
#: Words between ASCII white space, A-Z lower-cased.
LOWER_WORDS = byte_table(SPACES, lower=True)
#: Runs of digits, a-z (after lower-casing) and everything beyond ASCII.
ALNUM_WORDS = byte_table(
    "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)), lower=True
)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, extended on demand."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, U64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=U64)

    def shrink(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            steps = np.full(n, self.base, dtype=U64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = self.inverse
            self.down = np.cumprod(steps)
        return self.up, self.down


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)

#: What an operator without these kernels keeps in a worker process between its tasks. Workers serve one
#: stage after another, so the first text of another operator frees it.
KEPT: dict = {}


@dataclass
class Words:
    """The words of a slice of texts. Positions are bytes in ``data``; ``first`` has one entry more than texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # text of each word
    first: np.ndarray  # index of the first word of each text
    hash: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array, offsets starting at 0; nulls count as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _blocks(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bytes that cut no word: a block ends at the start of a text or behind a separator."""
    low, size = 0, len(data)
    while low < size:
        high = min(low + BLOCK_BYTES, size)
        if high < size:
            text = int(offsets[np.searchsorted(offsets, high, side="right") - 1])
            gaps = np.flatnonzero(~is_word[data[low:high]])
            ends = [x for x in (text, low + int(gaps[-1]) + 1 if len(gaps) else low) if x > low]
            while not ends:  # a word longer than a block: on to where it or its text ends
                further = min(high + BLOCK_BYTES, size)
                gaps = np.flatnonzero(~is_word[data[high:further]])
                text = int(offsets[np.searchsorted(offsets, high, side="right")])
                ends = [min([x for x in (text, high + int(gaps[0]) + 1 if len(gaps) else size) if x <= further], default=0)]
                ends, high = [x for x in ends if x > low], further
            high = max(ends)
        yield low, high
        low = high


def words_of(texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> Words:
    """Words of every text, with a 64-bit hash of each word's bytes."""
    KEPT.clear()
    data, offsets = _bytes_of(texts)
    is_word, mapped = table
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64))]
    for low, high in _blocks(data, offsets, is_word):
        block = data[low:high]
        inside = is_word[block]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[np.searchsorted(offsets, low, side="right") : np.searchsorted(offsets, high, side="left")] - low  # texts that begin within
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = _BYTES.upto(len(block) + 1)
        total = np.zeros(len(block) + 1, dtype=U64)
        np.cumsum((mapped[block].astype(U64) + U64(1)) * up[: len(block)], out=total[1:])
        hashed = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))
        found.append((start + low, end + low, hashed))
    start, end, hashed = (np.concatenate(x) for x in zip(*found, strict=True))
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, doc, first, hashed)


def ngram_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of the ``n`` words from each word on; the last n - 1 entries don't exist.

    Windows that cross from one text to the next are in the result; see ``window_starts``.
    """
    if len(word_hash) < n:
        return np.zeros(0, dtype=U64)
    up, down = _WORDS.upto(len(word_hash) + 1)
    total = np.zeros(len(word_hash) + 1, dtype=U64)
    np.cumsum(word_hash * up[: len(word_hash)], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(word_hash) - n + 1])


def sequence_hashes(word_hash: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The same hash for word ranges [first, last) of any length."""
    up, down = _WORDS.upto(len(word_hash) + 1)
    total = np.zeros(len(word_hash) + 1, dtype=U64)
    np.cumsum(word_hash * up[: len(word_hash)], out=total[1:])
    return mix((total[last] - total[first]) * down[first])


def window_starts(words: Words, n: int) -> np.ndarray:
    """Indices of the words that start a window of ``n`` words of one text."""
    room = words.first[1:][words.doc] - np.arange(len(words.doc))
    return np.flatnonzero(room >= n)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    have, m = 1, values
    while have * 2 <= width:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``limit`` text bytes, or of one row where that alone is longer."""
    lengths = batch.column(text).fill_null("")
    _, offsets = _bytes_of(lengths)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


Kernel = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(kernel: Kernel) -> Kernel:
    """``kernel``, which at the end of a task gives back what it grew: worker processes stay, and wait beside later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from kernel(batches)
        finally:
            _BYTES.shrink()
            _WORDS.shrink()
            pa.default_memory_pool().release_unused()

    return run


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return h.view(np.int64)


def joined_words(words: Words, mapped: np.ndarray, gap: int = 1, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): every word followed by ``gap`` spaces; word ``i`` is ``bytes[offsets[i] : offsets[i + 1] - gap]``."""
    offsets = np.concatenate([[0], np.cumsum(words.end - words.start + gap)])
    out = np.full(offsets[-1], 32, dtype=np.uint8)
    for low in range(0, len(words.start), block):  # what a byte needs is held for a block of words
        start, size = words.start[low : low + block], words.end[low : low + block] - words.start[low : low + block]
        out[inside(offsets[low : low + len(size)], size)] = mapped[words.data[inside(start, size)]]
    return out, offsets


def inside(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges that begin at ``start`` and hold ``size``, one range after another."""
    ahead = np.cumsum(size) - size
    return np.repeat(start - ahead, size) + np.arange(int(size.sum()))
