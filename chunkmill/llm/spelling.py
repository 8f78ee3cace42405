"""Spelling variants: words that one inserted, deleted or replaced code point tells apart, and the form of each.

One edit leaves one half of a word as it is. Aho-Corasick automata hold both halves of every word, in shards
of bounded size; all words of a fitting length run through every shard. A half found at the offset it has in
its word (from the start, or up to the end) gives candidates: the words that also share a half of the
other half there. Candidates are verified on their code points. Words and shards meet in blocks of
bounded size, so no group holds a whole vocabulary, and what a block returns is one row a word.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stage

#: One run of letters, as a regular expression.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words that a shard's automaton holds, and words that run through it in one task, on average at most.
SHARD_WORDS, SCAN_WORDS = 50_000, 100_000
#: Code points of candidate pairs that are verified at a time.
_VERIFIED = 1 << 23
#: Rounds in which forms are followed at most; each doubles the steps taken.
MAX_ROUNDS = 64


def words_of_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word): every run of letters of every text, A-Z lower-cased."""
    text = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("word"))


def _codes(words: list[str], width: int) -> np.ndarray:
    """A row of ``width`` code points for each word, 0 behind its end."""
    raw = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le")
    return np.frombuffer(raw, np.uint32).reshape(len(words), width)


def one_edit(left: np.ndarray, right: np.ndarray, shorter: int, longer: int) -> np.ndarray:
    """Which rows differ by one edit: what they share at the start and at the end leaves one code point."""
    same = left[:, :shorter] == right[:, :shorter]
    from_start = np.where(same.all(axis=1), shorter, same.argmin(axis=1))
    same = (left[:, left.shape[1] - shorter :] == right[:, right.shape[1] - shorter :])[:, ::-1]
    from_end = np.where(same.all(axis=1), shorter, same.argmin(axis=1))
    if shorter == longer:
        return (from_start < shorter) & (from_start + from_end == longer - 1)
    return from_start + from_end >= shorter


def near_pairs(held: list[str], scanned: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``scanned``, index in ``held``) of all near words. Held words have one length, scanned words one that is at most 1 off."""
    size, length = len(held[0]), len(scanned[0])
    half = size // 2
    quarter, rest = half // 2, half + (size - half) // 2
    # by half: (both parts from the start on), (start and end), ...: an edit in one half leaves a half of it, too
    lists: tuple[dict, dict, dict, dict] = ({}, {}, {}, {})
    automaton = ahocorasick.Automaton()
    for k, w in enumerate(held):
        head, tail = w[:half], w[half:]
        automaton.add_word(head, head)
        automaton.add_word(tail, tail)
        for of, key in zip(lists, (w[:rest], (head, w[rest:]), (w[:quarter], tail), w[quarter:]), strict=True):
            of.setdefault(key, []).append(k)
    automaton.make_automaton()
    by_start, by_ends, by_start_tail, by_end = lists
    end_size, tail_size, cut = size - rest, size - half, length - (size - quarter)
    left: list[int] = []
    right: list[int] = []
    found: list[np.ndarray] = [np.zeros(0, np.int64)]
    width = max(size, length)
    codes, other = _codes(held, size), _codes(scanned, length)

    def verify() -> None:
        a, b = np.array(left, np.int64), np.array(right, np.int64)
        pairs = np.unique(a * len(held) + b)
        a, b = pairs // len(held), pairs % len(held)
        found.append(pairs[one_edit(other[a], codes[b], min(size, length), width)])
        left.clear()
        right.clear()

    for i, word in enumerate(scanned):
        for end, segment in automaton.iter(word):
            begin = end + 1 - len(segment)
            matches = []
            if begin == 0 and len(segment) == half:
                matches += [by_start.get(word[:rest]), by_ends.get((segment, word[length - end_size :]))]
            if end + 1 == length and len(segment) == tail_size:
                matches += [by_start_tail.get((word[:quarter], segment)), by_end.get(word[cut:]) if cut >= 0 else None]
            for some in matches:
                if some:
                    left += [i] * len(some)
                    right += some
        if len(left) * width > _VERIFIED:
            verify()
    verify()
    pairs = np.unique(np.concatenate(found))
    return pairs // len(held), pairs % len(held)


def _block(held: pa.Table, scanned: pa.Table) -> pa.Table:
    """Of every scanned word that has near words among the held: their number, and the one of largest n, the smallest of these."""
    none = pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "form_n": pa.array([], pa.int64()), "form": pa.array([], pa.string())})
    if not held.num_rows or not scanned.num_rows:
        return none
    words, others = held.column("held").to_pylist(), scanned.column("scanned").to_pylist()
    i, k = near_pairs(words, others)
    if not len(i):
        return none
    n = held.column("n").to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[k], -n[k], i))
    i, k = i[order], k[order]
    first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
    near = np.diff(np.concatenate([first, [len(i)]]))
    return pa.table({"word": pa.array([others[x] for x in i[first]]), "n_near": pa.array(near), "form_n": pa.array(n[k[first]]), "form": pa.array([words[x] for x in k[first]])})


def near_words(counts: DataFrame, *, shard_words: int = SHARD_WORDS, scan_words: int = SCAN_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) for every word of ``counts`` (distinct words, n) that has near words."""
    sized = counts.withColumn("size", F.char_length("word"))
    sizes = sized.groupBy("size").agg(F.count("*").alias("c"))
    shards = sizes.select(F.col("size").alias("held_size"), F.ceil(F.col("c") / shard_words).alias("shards"))
    parts = sizes.select(F.col("size").alias("scan_size"), F.ceil(F.col("c") / scan_words).alias("parts"))
    around = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1))
    held = sized.withColumn("scan_size", around).join(parts, "scan_size").join(shards.withColumnRenamed("held_size", "size"), "size")
    held = held.select(F.col("word").alias("held"), "n", F.col("size").alias("held_size"), F.col("scan_size").alias("scan_size"), F.pmod(F.xxhash64("word"), "shards").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"))
    scanned = sized.withColumn("held_size", around).join(shards, "held_size").join(parts.withColumnRenamed("scan_size", "size"), "size")
    scanned = scanned.select(F.col("word").alias("scanned"), F.col("size").alias("scan_size"), F.col("held_size").alias("held_size"), F.pmod(F.xxhash64("word", F.lit(1)), "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1)).alias("shard"))
    key = ["held_size", "scan_size", "shard", "part"]
    met = held.groupBy(*key).cogroup(scanned.groupBy(*key)).applyInArrow(_block, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def follow(links: DataFrame) -> DataFrame:
    """(word, root): the last form that each word's forms lead to. ``links`` is (word, form), one form a word, without circles.

    Every round doubles the steps taken, so a chain of k forms takes log2(k) rounds of one join. A form's n is a
    fixed multiple of the word's, so chains are short whatever the size of the vocabulary.
    """
    at = stage(links.select("word", F.col("form").alias("root"), F.lit(False).alias("last")), "forms")
    for _ in range(MAX_ROUNDS):
        if at.where(~F.col("last")).isEmpty():
            return at.select("word", "root")
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stage(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNull().alias("last")), "forms")
    raise RuntimeError(f"forms were not at their end after {MAX_ROUNDS} rounds: do they form a circle?")


def spelling_variants(words: DataFrame, *, min_length: int = 6, min_count: int = 5, ratio: int = 5, shard_words: int = SHARD_WORDS, scan_words: int = SCAN_WORDS) -> DataFrame:
    """One row per distinct word of ``words`` (column ``word``, a row an occurrence) that is long and frequent enough:
    word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest n (the smallest of these in code-point order) if its n is at least
    ``ratio`` times the word's, else null; ``root`` is the last form that forms lead to, or the word itself.

    Occurrences are counted with partial aggregation, so a frequent word is one row a task. The vocabulary is
    staged and meets itself in blocks of ``shard_words`` held by ``scan_words`` scanned words of a length: their
    number grows with the square of a length's words, at some microseconds a word and block. Null words are ignored;
    an empty table gives an empty result; other columns play no part. Words shorter than 4 code points cannot
    be halved twice: ``min_length`` is at least 4.
    """
    if min_length < 4 or ratio < 2:
        raise ValueError("min_length is at least 4, and ratio at least 2")
    counts = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    counts = stage(counts, "vocabulary")
    near = near_words(counts, shard_words=shard_words, scan_words=scan_words)
    formed = stage(counts.join(near, "word", "left").withColumn("is_form", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))), "variants")
    roots = follow(formed.where("is_form").select("word", "form"))
    kept = lambda name: F.when(F.col("is_form"), F.col(name)).alias(name)
    return formed.join(roots, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), kept("form"), kept("form_n"), F.coalesce("root", "word").alias("root"))
