"""Toxicity by compression distance: windows are compressed with an ordinary and with a toxic zstandard dictionary.

The ordinary dictionary is trained on windows of texts labelled 0. The toxic one has, before the same
content, what toxic texts hold beyond it: the parts of words that occur in far more contexts there. A
window's gain is the bytes that the toxic dictionary saves. A fixed prefix that both dictionaries hold
makes zstandard write compressed blocks even of few words, so that lengths compare to the byte.
A text's score comes from its windows' gains, by a calibration on labelled texts that the dictionaries
were not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed
from .textkernels import ALNUM_WORDS, Words, inside, joined_words, slices, tidy, words_of

#: Labelled texts of each kind that a model is fitted on at most, the first by md5 of their doc_id, and their longest length.
MAX_TRAIN, MAX_CHARS = 3_000, 20_000
#: Words of a window, and words from one window to the next: single words tell, so that few need be seen twice.
WINDOW, STEP = 8, 6
#: Bytes of the dictionaries' shared and toxic content, and of the prefix.
ORDINARY_BYTES, TOXIC_BYTES, PREFIX_BYTES = 8192, 4096, 32
#: Spaces between words, and bytes of the parts of words that are counted, with these. What begins or ends with a word matches at more bytes.
GAP = 2
PART = 7
#: A part is toxic if it has so many times the share of contexts, at such a log-likelihood ratio.
RATIO, EVIDENCE = 6.0, 40.0
#: Bytes gained from which a window counts as flagged.
FLAGGED = 3
#: Windows that are compressed at a time.
_AT_ONCE = 1 << 14


@dataclass(frozen=True)
class CompressionModel:
    """Contents of the two dictionaries, and the calibration: bias and weights of a text's statistics."""

    ordinary: bytes
    toxic: bytes
    bias: float
    weights: tuple[float, ...]

    def gains(self, compressors: tuple, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(gain, text) of every window."""
        joined, offsets = joined_words(words, ALNUM_WORDS[1], GAP)
        joined = np.concatenate([np.full(GAP, 32, np.uint8), joined])  # spaces before each word, and after it
        n = words.count
        windows = np.where(n > WINDOW, (n - WINDOW + STEP - 1) // STEP + 1, n > 0).astype(np.int64)
        text = np.repeat(np.arange(len(n)), windows)
        begin = words.first[text] + inside(np.zeros(len(n), np.int64), windows) * STEP
        end = np.minimum(begin + WINDOW, words.first[text + 1])
        start, size = offsets[begin], offsets[end] - offsets[begin] + GAP
        prefix = np.frombuffer(self.ordinary[-PREFIX_BYTES:], np.uint8)
        gain = np.zeros(len(text), np.int64)
        low = 0
        total = np.cumsum(size)
        while low < len(text):
            high = min(low + _AT_ONCE, max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + (1 << 21), side="right"))), len(text))
            sizes = size[low:high] + len(prefix)
            at = np.cumsum(sizes) - sizes
            buffer = np.empty(int(sizes.sum()), np.uint8)
            buffer[inside(at, np.full(high - low, len(prefix)))] = np.tile(prefix, high - low)
            buffer[inside(at + len(prefix), size[low:high])] = joined[inside(start[low:high], size[low:high])]
            given = zstandard.BufferWithSegments(buffer.tobytes(), np.column_stack([at, sizes]).astype(np.uint64).tobytes())
            ordinary, toxic = (c.multi_compress_to_buffer(given) for c in compressors)
            gain[low:high] = [len(a) - len(b) for a, b in zip(ordinary, toxic, strict=True)]
            low = high
        return gain, text

    def compressors(self) -> tuple:
        return _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    given = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_LAZY2, window_log=17, chain_log=15, hash_log=15, search_log=5, min_match=6, target_length=64, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    return zstandard.ZstdCompressor(dict_data=_dictionary(content, given), compression_params=given)


def _dictionary(content: bytes, given: zstandard.ZstdCompressionParameters) -> zstandard.ZstdCompressionDict:
    out = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    out.precompute_compress(compression_params=given)
    return out


def statistics(gain: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """A row for each of ``n`` texts: greatest gain, logarithm of flagged windows, share of flagged windows."""
    most, flagged = np.zeros(n), np.bincount(text[gain >= FLAGGED], minlength=n)
    np.maximum.at(most, text, gain)
    return np.column_stack([most, np.log1p(flagged), np.sqrt(flagged / np.maximum(np.bincount(text, minlength=n), 1))])


def _contexts(ids: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Distinct neighbours (the word before and the word after) of every word, so that copied passages count once."""
    before, after = np.full(len(ids), size), np.full(len(ids), size)
    before[1:], after[:-1] = ids[:-1], ids[1:]
    inner = first[(first > 0) & (first < len(ids))]
    before[inner], after[inner - 1] = size, size
    pairs, word = np.unique(before * (size + 1) + after, return_inverse=True)
    return np.bincount(np.unique(ids * len(pairs) + word) // max(len(pairs), 1), minlength=size)


def toxic_parts(ordinary: Words, toxic: Words, limit: int = TOXIC_BYTES) -> bytes:
    """The dictionary content that toxic words add: their significant parts, the most frequent last, where offsets are least."""
    spelled = []
    for words in (ordinary, toxic):
        joined, offsets = joined_words(words, ALNUM_WORDS[1], GAP)
        spelled.append(pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]))
    coded = pa.concat_arrays(spelled).dictionary_encode()
    ids, size = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    plain, hot = _contexts(ids[: len(ordinary.start)], ordinary.first, size), _contexts(ids[len(ordinary.start) :], toxic.first, size)
    if not plain.sum() or not hot.sum():
        return b""
    vocabulary = [b" " * GAP + w.as_py() for w in coded.dictionary]
    data = np.frombuffer(b"".join(vocabulary), np.uint8).astype(np.uint64)
    lengths = np.array([len(w) for w in vocabulary])
    ends, owner = np.cumsum(lengths), np.repeat(np.arange(size), lengths)
    if len(data) < PART:
        return b""
    part = np.zeros(len(data) - PART + 1, np.uint64)
    for k in range(PART):
        part = (part << np.uint64(8)) | data[k : k + len(part)]
    at = np.flatnonzero(owner[: len(part)] == owner[PART - 1 :])
    _, kind = np.unique(part[at], return_inverse=True)
    a, b = np.bincount(kind, hot[owner[at]]), np.bincount(kind, plain[owner[at]])
    share_a, share_b = hot.sum() / (hot.sum() + plain.sum()), plain.sum() / (hot.sum() + plain.sum())
    part_of = lambda x, share: x * np.log(np.maximum(x, 1e-9) / np.maximum((a + b) * share, 1e-9))
    evidence = 2 * (part_of(a, share_a) + part_of(b, share_b))
    chosen = (a / hot.sum() >= RATIO * (b + 0.5) / plain.sum()) & (evidence >= EVIDENCE)
    at = at[chosen[kind]]
    covered = np.zeros(len(data) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + PART, -1)
    covered = np.cumsum(covered)[:-1] > 0
    counts: dict[bytes, int] = {}
    for w in np.unique(owner[at]):
        if hot[w]:
            word, mask = vocabulary[w], covered[ends[w] - lengths[w] : ends[w]].astype(np.int8)
            edge = np.diff(np.concatenate([[0], mask, [0]]))
            for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                counts[word[x:y]] = counts.get(word[x:y], 0) + int(hot[w])
    return b"".join(sorted(counts, key=lambda s: (counts[s], s)))[-limit:]


def _trained(words: Words, size: int = ORDINARY_BYTES) -> bytes:
    """A dictionary of windows of ordinary text; where there are too few to train on, the windows themselves."""
    joined, offsets = joined_words(words, ALNUM_WORDS[1], GAP)
    some = range(0, len(words.start), WINDOW * max(1, len(words.start) // (WINDOW * 100_000)))
    windows = [joined[offsets[i] : offsets[min(i + WINDOW, len(words.start))]].tobytes() for i in some]
    try:
        return zstandard.train_dictionary(size, windows, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return (b"the prefix of every window is this" + b"".join(windows))[-size:].rjust(PREFIX_BYTES)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Newton steps for a lightly penalised logistic regression; weights are kept from being negative."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        penalty = np.diag([1e-6, *[1e-2] * x.shape[1]])
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(move, -2, 2)
    return float(w[0]), tuple(float(v) for v in np.maximum(w[1:], 0))


def fit_compression(ordinary: list[str], toxic: list[str]) -> CompressionModel:
    """Dictionaries from two thirds of the texts of each kind, the calibration from the rest (from all, if a kind has fewer than 30).

    With texts of one kind or none, the score is a smoothed constant.
    """
    if not ordinary or not toxic:
        return CompressionModel(_trained(words_of(pa.array(ordinary + toxic, pa.string()), ALNUM_WORDS)), b"", float(np.log((len(toxic) + 1) / (len(ordinary) + 1))), (0.0,) * 3)
    few = min(len(ordinary), len(toxic)) < 30
    learn = [texts if few else [t for i, t in enumerate(texts) if i % 3] for texts in (ordinary, toxic)]
    rest = [texts if few else texts[::3] for texts in (ordinary, toxic)]
    words = [words_of(pa.array(t, pa.string()), ALNUM_WORDS) for t in learn]
    model = CompressionModel(_trained(words[0]), toxic_parts(*words), 0.0, (0.0,) * 3)
    x = [statistics(*model.gains(model.compressors(), words_of(pa.array(t, pa.string()), ALNUM_WORDS)), len(t)) for t in rest]
    bias, weights = _logistic(np.concatenate(x), np.repeat([0.0, 1.0], [len(t) for t in rest]))
    return CompressionModel(model.ordinary, model.toxic, bias, weights)


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> CompressionModel:
    """Fits on at most ``max_train`` labelled texts of each kind, of ``MAX_CHARS`` at most: that many come to the driver.

    ``labels`` holds only rows that may be learnt from. Null labels and labels other than 0 and 1 are left out;
    a label without a document is ignored; of a doc_id that repeats with other texts one text counts.
    """
    some = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    kinds = [some.where(F.col("y") == y).orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(max_train) for y in (0, 1)]
    ids = kinds[0].union(kinds[1]).select(F.col(id_col).alias("doc_id"), "y")
    texts = keyed(docs, id_col, text_col).where(F.char_length("text") <= MAX_CHARS)
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # max_train ids of each kind
    rows = found.orderBy("doc_id").collect()
    return fit_compression([r["text"] for r in rows if r["y"] == 0], [r["text"] for r in rows if r["y"] == 1])


def score_toxicity(docs: DataFrame, model: CompressionModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: label 1 likelier), most_gained, n_flagged, n_windows.

    Whole texts, in one pass without a shuffle; the model is two dictionaries of some 12 KB. Long texts are
    compressed some thousand windows at a time. Null and blank texts have no windows and get the score of no
    gain. Null and repeated doc_ids are rows like others; other columns are ignored; an empty table gives an
    empty result.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            for part in slices(batch):
                gain, text = model.gains(compressors, words_of(part.column("text"), ALNUM_WORDS))
                x = statistics(gain, text, len(part))
                flagged, windows = np.bincount(text[gain >= FLAGGED], minlength=len(part)), np.bincount(text, minlength=len(part))
                columns = [part.column("doc_id"), pa.array(model.score(x)), pa.array(x[:, 0].astype(np.int64)), pa.array(flagged.astype(np.int64)), pa.array(windows.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "most_gained", "n_flagged", "n_windows"])

    return given.mapInArrow(tidy(rows), f"doc_id {kind}, score double, most_gained long, n_flagged long, n_windows long")
