"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star edges.

1. A document's set is its distinct 5-word shingles. One hash of each shingle gives both its bin and its
   value; a bin's least value is its minimum. Empty bins borrow from a full bin that a fixed hash of
   (bin, attempt) names, so two documents with the same full bins borrow alike.
2. Documents with equal sets collapse to one representative before any pair is made.
3. Bands of bins are buckets. Each member is paired with the bucket's least document only, a star, so a
   bucket of n makes n - 1 pairs. Pairs are confirmed on full sets, and components grow.
4. What a star can miss is a link between two members of one bucket in different components. Those
   cross-component pairs, and no others, are made next and confirmed as well; where a bucket would make
   too many, its members meet through an exact prefix filter on their rarest shingles instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed, stage
from .textkernels import LOWER_WORDS, U64, Words, mix, ngram_hashes, sequence_hashes, signed, slices, tidy, window_starts, words_of

BINS, BAND = 128, 4
BANDS = BINS // BAND
#: Cross-component pairs of one bucket beyond which its members go through the prefix filter, which costs a row per shingle.
BUCKET_PAIRS = 200
#: Rows that a component has of one shingle beyond which they aren't joined on the shingle alone. Neither number changes results.
CROWD = 16


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles, sorted by text, then hash. A shorter text is one shingle."""
    at = window_starts(words, size)
    hashed = ngram_hashes(words.hash, size)[at] if len(at) else np.zeros(0, U64)
    count = words.count
    short = np.flatnonzero((count > 0) & (count < size))
    doc = np.concatenate([words.doc[at], short])
    hashed = np.concatenate([hashed, sequence_hashes(words.hash, words.first[short], words.first[short + 1])])
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    return doc[new], hashed[new]


def _attempts(attempt: int, bins: int) -> np.ndarray:
    """The bin that each bin borrows from at its n-th attempt."""
    return (mix(np.arange(bins, dtype=U64) * U64(0x100000001) + mix(np.array([attempt + 1], dtype=U64))) % U64(bins)).astype(np.int64)


def signatures(doc: np.ndarray, hashed: np.ndarray, documents: int, bins: int = BINS) -> np.ndarray:
    """(documents, bins) minima after densification; rows of documents without shingles are 0."""
    shift = U64(64 - (bins - 1).bit_length())
    of = (hashed >> shift).astype(np.int64)
    lead = np.ones(len(doc), dtype=bool)  # sorted by hash: the first of a bin is its minimum
    lead[1:] = (doc[1:] != doc[:-1]) | (of[1:] != of[:-1])
    out, full = np.zeros((documents, bins), dtype=U64), np.zeros((documents, bins), dtype=bool)
    out[doc[lead], of[lead]] = hashed[lead]
    full[doc[lead], of[lead]] = True
    row, col = np.nonzero(~full & full.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        source = _attempts(attempt, bins)[col]
        found = full[row, source]
        out[row[found], col[found]] = out[row[found], source[found]]
        row, col, attempt = row[~found], col[~found], attempt + 1
    return out


def _fingerprint_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    positions = mix(np.arange(BINS, dtype=U64) + U64(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashed = shingle_sets(words_of(part.column("text"), LOWER_WORDS), size)
                n = np.bincount(doc, minlength=len(part)).astype(np.int64)
                sums = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashed + U64(salt)))])
                    sums.append(signed(total[np.cumsum(n)] - total[np.cumsum(n) - n]))
                bands = mix(signatures(doc, hashed, len(part)) ^ positions).reshape(len(part), BANDS, BAND).sum(axis=2, dtype=U64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(part) + 1, BANDS, dtype=np.int32)), pa.array(signed(mix(bands).ravel())))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), lists], ["doc_id", "body", "n_shingles", "set1", "set2", "bands"])

    return run


def _confirm_rows(size: int, numerator: int, denominator: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the pairs whose full sets are similar enough. A left text in a row of pairs is hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            left, right = batch.column("text_a"), batch.column("text_b")
            texts, known, have = list(zip(batch.column("a").to_pylist(), batch.column("a_body").to_pylist(), strict=True)), None, None
            for i in range(len(batch)):
                if have is None or texts[i] != known:
                    known, have = texts[i], shingle_sets(words_of(left.slice(i, 1), LOWER_WORDS), size)[1]
                other = shingle_sets(words_of(right.slice(i, 1), LOWER_WORDS), size)[1]
                both = len(have) + len(other) - len(np.unique(np.concatenate([have, other])))
                keep[i] = denominator * both >= numerator * (len(have) + len(other) - both) and both > 0
            rows = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], ["a", "b"])

    return run


def _prefix_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashed = shingle_sets(words_of(part.column("text"), LOWER_WORDS), size)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column("rep").take(rows), part.column("rep_body").take(rows), pa.array(signed(hashed))], ["rep", "rep_body", "shingle"])

    return run


def components(edges: DataFrame, limit: int = 200) -> DataFrame:
    """(id, component): the least id that each end of an edge (a, b) reaches.

    Contraction by random priorities: every label hangs on the neighbour of least priority, if that is less
    than its own, then on that one's; an edge joins the two ends' labels, and edges within one label are
    gone. A fixed share of the labels goes in a round whatever the graph's shape, as priorities are drawn
    anew every second round (a star is done in two of one draw), so rounds grow with the logarithm of the
    labels, chains included. Every round is cut.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    labels = cut(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("component", F.col("id")))
    for number in range(limit):
        if edges.isEmpty():
            break
        place = lambda c, seed=number // 2: F.xxhash64(F.lit(seed), c)
        ends = edges.select("a", F.col("b").alias("to")).union(edges.select(F.col("b").alias("a"), F.col("a").alias("to")))
        ends = ends.where(place(F.col("to")) < place(F.col("a")))
        hook = cut(ends.groupBy("a").agg(F.min(F.struct(place(F.col("to")).alias("place"), F.col("to"))).alias("least")).select("a", F.col("least.to").alias("to")))
        jumped = hook.join(hook.select(F.col("a").alias("to"), F.col("to").alias("next")), "to", "left").select("a", F.coalesce("next", "to").alias("to"))
        jumped = cut(jumped)
        labels = cut(labels.join(jumped.withColumnRenamed("a", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component")))
        moved = edges.join(jumped, "a", "left").select("b", F.coalesce("to", "a").alias("x"))
        moved = moved.join(jumped.select(F.col("a").alias("b"), F.col("to").alias("y")), "b", "left").select("x", F.coalesce("y", "b").alias("y"))
        edges = cut(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).where("a <> b").distinct())
    else:
        raise RuntimeError(f"no fixed point in {limit} rounds")
    least = cut(labels.groupBy("component").agg(F.min("id").alias("least")))
    return cut(labels.join(least, "component").select("id", F.col("least").alias("component")))


def near_duplicates(docs: DataFrame, *, size: int = 5, similarity: tuple[int, int] = (75, 100), bucket_pairs: int = BUCKET_PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, body, n_shingles, component_id (least doc_id reachable over links).

    Two documents are linked if their sets of distinct ``size``-word shingles (words between ASCII white
    space, A-Z lower-cased; fewer words are one shingle) have a Jaccard similarity of at least
    ``similarity``. A pair shares a band by chance alone: README.md has the recall by set size, measured.
    What shares one is decided on the full sets.

    Scale: texts are read once for fingerprints, which are staged, and shuffled once more, of which those
    whose set shares a bucket with another are staged. Shuffled besides are 32 band rows per distinct set.
    Buckets give one pair per member, and pairs across components only. Each join on a bucket, a set or a
    centre has staged tables or rows not yet aggregated on both sides, so Spark splits the partitions of
    hot ones. Components take rounds in the logarithm of the linked documents.

    Edge cases: documents without words or with a null text have no shingles and are linked with
    nothing. Rows that repeat a doc_id are one document if their texts agree, else the doc_id's rows are
    linked through it. Rows without doc_id take no part and are their own component (null). A very long text
    is hashed block by block; what is held of it is some 50 bytes a word. Other columns are ignored; an
    empty table gives an empty result.
    """
    base = keyed(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    prints = stage(base.mapInArrow(tidy(_fingerprint_rows(size)), f"doc_id {id_type}, body long, n_shingles long, set1 long, set2 long, bands array<long>"), "prints")
    real = prints.where("n_shingles > 0 and doc_id is not null")
    whole = ["n_shingles", "set1", "set2"]
    # a set's least document stands for it; its text is known by (rep, rep_body)
    sets = real.groupBy(*whole).agg(F.min(F.struct("doc_id", "body")).alias("least"))
    sets = stage(sets.select(*whole, F.col("least.doc_id").alias("rep"), F.col("least.body").alias("rep_body")), "sets")
    own = (F.col("doc_id") == F.col("rep")) & (F.col("body") == F.col("rep_body"))
    banded = stage(real.select("doc_id", "body", "bands").join(sets.select("rep", "rep_body", "n_shingles"), own).dropDuplicates(["rep", "rep_body"]).select("rep", "rep_body", "n_shingles", "bands"), "bands")
    member = banded.select("rep", "rep_body", "n_shingles", F.explode("bands").alias("bucket"))  # a bucket's hash holds its band
    stars = stage(member.groupBy("bucket").agg(F.min("rep").alias("center"), F.max("rep").alias("most")).where("center < most").select("bucket", "center"), "stars")
    crowded = stage(member.join(stars, "bucket"), "members")  # members of buckets with two or more

    numerator, denominator = similarity
    fits = F.least("n_a", "n_b") * denominator >= F.greatest("n_a", "n_b") * numerator
    met = crowded.select(F.col("rep").alias("doc_id"), F.col("rep_body").alias("body")).distinct()
    texts = stage(base.join(met, ["doc_id", "body"]).dropDuplicates(["doc_id", "body"]), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, a_body, b, b_body), the links (a, b)."""
        a = texts.select(F.col("doc_id").alias("a"), F.col("body").alias("a_body"), F.col("text").alias("text_a"))
        b = texts.select(F.col("doc_id").alias("b"), F.col("body").alias("b_body"), F.col("text").alias("text_b"))
        both = pairs.join(b, ["b", "b_body"]).join(a, ["a", "a_body"]).select("a", "a_body", "text_a", "b", "text_b")
        return cut(both.mapInArrow(tidy(_confirm_rows(size, numerator, denominator)), f"a {id_type}, b {id_type}"))

    center = crowded.where("rep = center").select("bucket", F.col("rep").alias("a"), F.col("rep_body").alias("a_body"), F.col("n_shingles").alias("n_a"))
    star = crowded.select("bucket", F.col("rep").alias("b"), F.col("rep_body").alias("b_body"), F.col("n_shingles").alias("n_b"))
    star = star.join(center, "bucket").where("a <> b or a_body <> b_body").where(fits).select("a", "a_body", "b", "b_body")
    star = stage(star.distinct(), "pairs")
    links = confirmed(star)
    # rows of one doc_id with different sets are one document, as links go: it meets the documents that stand for them
    repeated = cut(real.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if not repeated.isEmpty():
        named = real.select("doc_id", *whole).join(repeated, "doc_id", "left_semi").distinct().join(sets.select(*whole, "rep"), whole)
        links = cut(links.union(named.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()))
    labels = components(links)

    where_now = crowded.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", "rep", "rep_body", "n_shingles", F.coalesce("component", "rep").alias("component"))
    kinds = where_now.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = kinds.groupBy("bucket").agg(F.count("*").alias("kinds"), F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares")).where("kinds > 1")
    mixed = stage(mixed.select("bucket", ((F.col("all") * F.col("all") - F.col("squares")) / 2).cast("long").alias("pairs")), "mixed")
    rest = stage(where_now.join(mixed, "bucket"), "rest")
    side = lambda x, rows: rows.select("bucket", F.col("rep").alias(x), F.col("rep_body").alias(f"{x}_body"), F.col("n_shingles").alias(f"n_{x}"), F.col("component").alias(f"c_{x}"))
    few = rest.where(F.col("pairs") <= bucket_pairs)
    cross = side("a", few).join(side("b", few), "bucket").where("a < b and c_a <> c_b").where(fits).select("a", "a_body", "b", "b_body")
    large = rest.where(F.col("pairs") > bucket_pairs).select("rep", "rep_body", "n_shingles", "component").distinct()
    if not large.isEmpty():
        cross = cross.union(_prefix_pairs(stage(large, "large"), texts, size, numerator, denominator))
    cross = cross.distinct().join(star, ["a", "a_body", "b", "b_body"], "left_anti")
    more = confirmed(cross)
    if not more.isEmpty():
        labels = components(links.union(more))

    named = sets.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(*whole, F.coalesce("component", "rep").alias("component_id"))
    out = prints.select("doc_id", "body", *whole).join(named, whole, "left")
    empty = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return out.select("doc_id", "body", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _prefix_pairs(large: DataFrame, texts: DataFrame, size: int, numerator: int, denominator: int) -> DataFrame:
    """All pairs of ``large`` that can be similar and lie in different components, by an exact prefix filter.

    Rarity is counted among ``large``, so shingles that all of them share come last. With its shingles
    rarest first, a set of n meets every set of similarity t that is no smaller on one of the first
    n - ceil(2t / (1 + t) * n) + 1 of its own and of the first n - ceil(t * n) + 1 of the other's. The first
    shingle that two sets share also bounds their overlap by what is left behind it in either. The rows
    that a component has of a shingle beyond ``CROWD`` meet other components' only, so a large group of
    near copies isn't compared with itself.
    """
    kept = large.join(texts.select(F.col("doc_id").alias("rep"), F.col("body").alias("rep_body"), "text"), ["rep", "rep_body"])
    id_type = texts.schema["doc_id"].dataType.simpleString()
    shingles = stage(kept.select("rep", "rep_body", "text").mapInArrow(tidy(_prefix_rows(size)), f"rep {id_type}, rep_body long, shingle long"), "shingles")
    rarity = stage(shingles.groupBy("shingle").agg(F.count("*").alias("df")), "rarity")
    ordered = shingles.join(rarity, "shingle").groupBy("rep", "rep_body").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    n = F.col("n_shingles")
    probed, indexed = n - F.ceil(n * numerator / denominator) + 1, n - F.ceil(n * (2 * numerator) / (numerator + denominator)) + 1
    first = ordered.join(large, ["rep", "rep_body"]).select("rep", "rep_body", "n_shingles", "component", F.posexplode(F.slice("s", F.lit(1), probed.cast("int"))).alias("place", "s")).where("s.df > 1")
    first = stage(first.select("rep", "rep_body", "n_shingles", "component", F.col("s.shingle").alias("shingle"), (n - F.col("place")).alias("left"), (F.col("place") < indexed).alias("indexed")), "prefixes")
    crowds = stage(first.groupBy("shingle", "component").agg(F.count("*").alias("rows")), "crowds")
    large_ones = crowds.where(F.col("rows") > CROWD).select("shingle", "component")
    side = lambda x, rows: rows.select("shingle", F.col("component").alias(f"c_{x}"), F.col("rep").alias(x), F.col("rep_body").alias(f"{x}_body"), F.col("n_shingles").alias(f"n_{x}"), F.col("left").alias(f"left_{x}"), F.col("indexed").alias(f"indexed_{x}"))
    # overlap / (n_a + n_b - overlap) >= t  <=>  overlap * (1 + t) >= t * (n_a + n_b)
    enough = F.least("left_a", "left_b") * (numerator + denominator) >= (F.col("n_a") + F.col("n_b")) * numerator
    fits = F.least("n_a", "n_b") * denominator >= F.greatest("n_a", "n_b") * numerator
    fits = fits & enough & F.when(F.struct("n_a", "a") < F.struct("n_b", "b"), F.col("indexed_a")).otherwise(F.col("indexed_b"))
    scattered = first.join(large_ones, ["shingle", "component"], "left_anti")
    pairs = side("a", scattered).join(side("b", scattered), "shingle").where("a < b and c_a <> c_b").where(fits)
    sides = large_ones.withColumnRenamed("component", "c_a").join(crowds.withColumnRenamed("component", "c_b"), "shingle").where((F.col("c_a") != F.col("c_b")) & ((F.col("rows") <= CROWD) | (F.col("c_a") < F.col("c_b")))).select("shingle", "c_a", "c_b")
    pairs = pairs.unionByName(sides.join(side("b", first), ["shingle", "c_b"]).join(side("a", first), ["shingle", "c_a"]).where("a <> b").where(fits).select(pairs.columns))
    swap = F.col("a") > F.col("b")
    ends = {"a": ("a", "b"), "a_body": ("a_body", "b_body"), "b": ("b", "a"), "b_body": ("b_body", "a_body")}
    return pairs.select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(name) for name, (x, y) in ends.items()]).distinct()
