"""Quality rules: plain limits, then robust multivariate outliers.

Statistics of every text are counted in Arrow batches. The rest is DataFrame functions: minimum
covariance determinant (MCD) estimates of transformed statistic vectors for each language and source, by
concentration steps over all rows from two starts until the determinants stop falling, and a limit on
the Mahalanobis distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, keyed, per_salt, salted, stage
from .textkernels import _BYTES, RAW_WORDS, U64, _bytes_of, mix, ngram_hashes, slices, tidy, window_starts, words_of

SYMBOLS = "#*$%&|<>"
#: Share of a group's rows that an MCD estimate rests on, and concentration steps beyond which not to settle is an error.
SUPPORT, MAX_STEPS = 0.75, 500
#: Steps end when no logarithm of a determinant falls by more. Subsets are cut at grid points, so it never settles fully.
SETTLED = 1e-3
#: Rows that the estimate of what is around a group (its language, then all) counts for in the group's own.
PRIOR_ROWS = 50
#: The limit: the chi-squared quantile that one in a million regular rows exceeds.
TAIL = 1e-6
#: Transformed statistics, and the least standard deviation of each: what differs by less is no outlier.
FEATURES: dict[str, tuple[str, float]] = {
    "f1": ("ln(word_chars / n_words)", 0.1),
    "f2": ("ln(1 + 100D * n_symbols / n_words)", 0.6),
    # shares as they are: a logarithm ends so early that not even the largest share could pass the limit
    "f3": ("double(n_dup_lines) / n_lines", 0.15),
    "f4": ("double(n_repeat_words) / n_words", 0.08),
}
_GRID = 64  # bins of a unit when quantiles are taken


def _distinct_mask(doc: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (doc, hash), a mask of each first equal pair in it, and the number of the pair's group."""
    order = np.lexsort((hashed, doc))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (hashed[order][1:] != hashed[order][:-1])
    return order, new, np.cumsum(new) - 1


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, dtype=bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    for batch in batches:
        for part in slices(batch):
            words = words_of(part.column("text"), RAW_WORDS)
            n, data = len(part), words.data
            _, offset = _bytes_of(part.column("text"))
            per_doc = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offset])
            chars = per_doc(RAW_WORDS[0][data] & ((data & 0xC0) != 0x80))
            symbols = per_doc(symbol[data])
            # lines: cut at every newline and at the ends of texts
            breaks = np.flatnonzero(data == 10)
            lines = per_doc(data == 10) + 1
            line_doc, last = np.repeat(np.arange(n), lines), np.cumsum(lines) - 1
            is_last, is_first = np.zeros(len(line_doc), dtype=bool), np.zeros(len(line_doc), dtype=bool)
            is_last[last], is_first[last - lines + 1] = True, True
            line_start, line_end = np.empty(len(line_doc), np.int64), np.empty(len(line_doc), np.int64)
            line_start[is_first], line_start[~is_first] = offset[:-1], breaks + 1
            line_end[is_last], line_end[~is_last] = offset[1:], breaks
            up, down = _BYTES.upto(len(data) + 2)
            total = np.concatenate([np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)])])
            hashed = mix((total[line_end] - total[line_start]) * down[line_start] + (line_end - line_start).astype(U64))
            has_word = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
            order, new, _ = _distinct_mask(line_doc[has_word], hashed[has_word])
            repeated_lines = np.bincount(line_doc[has_word][order][~new], minlength=n)
            # words within trigrams that occur twice
            at = window_starts(words, 3)
            gram = ngram_hashes(words.hash, 3)[at] if len(at) else np.zeros(0, U64)
            order, new, group = _distinct_mask(words.doc[at], gram)
            twice = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
            depth = np.zeros(len(words.start) + 1, dtype=np.int64)
            hit = at[order][twice]
            np.add.at(depth, hit, 1)
            np.add.at(depth, hit + 3, -1)
            covered = np.concatenate([[0], np.cumsum(np.cumsum(depth[:-1]) > 0)])
            repeated = covered[words.first[1:]] - covered[words.first[:-1]]
            columns = [words.count, chars, symbols, repeated_lines, repeated, lines]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in ("doc_id", "body", "lang", "source")], *[pa.array(x.astype(np.int64)) for x in columns]],
                ["doc_id", "body", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
            )


def chi2_cdf(x: float, dof: int) -> float:
    """For even degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


def _quantile(rows: DataFrame, by: list[str], value: Column, p: float) -> DataFrame:
    """(by, q): each group's p-quantile of ``value`` on a grid. Counts of bins are summed up, not rows sorted."""
    bins = rows.select(*by, F.floor(F.least(value, F.lit(1e6)) * _GRID).alias("bin")).groupBy(*by, "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*by).orderBy("bin")
    bins = bins.withColumns({"sum": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy(*by))})
    return bins.where(F.col("sum") >= F.col("all") * p).groupBy(*by).agg((F.min("bin") / _GRID).alias("q"))


_DIM = len(FEATURES)
_NAMES, _FLOORS = list(FEATURES), [floor for _, floor in FEATURES.values()]
_MEANS = [f"m{i}" for i in range(_DIM)]
_PAIRS = [(i, j) for i in range(_DIM) for j in range(i + 1)]
_SCATTER = {(i, j): f"s{i}{j}" for i, j in _PAIRS}
_FACTOR = {(i, j): f"l{i}{j}" for i, j in _PAIRS}


def _factored(estimate: DataFrame) -> DataFrame:
    """``estimate`` (means, scatter) with the scatter's Cholesky factor and the logarithm of its determinant."""
    for i, j in _PAIRS:
        value = F.col(_SCATTER[i, j])
        for k in range(j):
            value = value - F.col(_FACTOR[i, k]) * F.col(_FACTOR[j, k])
        # the floor on the diagonal keeps the factor real and says what difference is none
        value = F.sqrt(F.greatest(value, F.lit(_FLOORS[i] ** 2))) if i == j else value / F.col(_FACTOR[j, j])
        estimate = estimate.withColumn(_FACTOR[i, j], value)
    return estimate.withColumn("log_det", sum((2 * F.ln(_FACTOR[i, i]) for i in range(_DIM)), F.lit(0.0)))


def _distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution with the Cholesky factor's columns."""
    solved: list[Column] = []
    for i in range(_DIM):
        y = F.col(_NAMES[i]) - F.col(_MEANS[i])
        for j in range(i):
            y = y - F.col(_FACTOR[i, j]) * solved[j]
        solved.append(y / F.col(_FACTOR[i, i]))
    total = solved[0] * solved[0]
    for y in solved[1:]:
        total = total + y * y
    return total


def _concentrate(placed: DataFrame, by: list[str], scale: float) -> DataFrame:
    """One step: the estimate of each group's ``SUPPORT`` nearest rows by ``place``."""
    bound = cut(_quantile(placed, by, F.col("place"), SUPPORT))
    near = placed.join(per_salt(bound), [*by, "_salt"]).where(F.floor(F.least("place", F.lit(1e6)) * _GRID) / _GRID <= F.col("q"))
    moments = [F.avg(f).alias(m) for f, m in zip(_NAMES, _MEANS, strict=True)]
    moments += [(F.covar_pop(_NAMES[i], _NAMES[j]) * scale).alias(_SCATTER[i, j]) for i, j in _PAIRS]
    return cut(_factored(near.groupBy(*by).agg(F.count("*").alias("rows"), *moments)))


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """(lang, source, means, scatter, factor) for every group of ``rows`` (lang, source, _salt, statistics).

    MCD estimates are made for each language and source, for each language, and for all rows. From two
    starts (sums and maxima of the statistics' squared robust deviations), concentration steps go on until
    determinants stop falling; the start of the least determinant stays. A group's estimate is then
    mixed with that of its language, which is mixed with that of all rows, as ``PRIOR_ROWS`` rows of it
    would; what their means differ by widens the scatter. So a group of one row is judged, too, and
    there is no size at which anything changes.
    """
    by = ["level", "lang", "source"]
    levels = F.array(*[F.struct(F.lit(n).alias("level"), a.alias("lang"), b.alias("source")) for n, a, b in ((1, F.col("lang"), F.col("source")), (2, F.col("lang"), F.lit("")), (3, F.lit(""), F.lit("")))])
    salted_by = [*by, "_salt"]
    rows = rows.select(F.explode(levels).alias("g"), "_salt", *_NAMES).select("g.*", "_salt", *_NAMES)
    flat = rows.select(*salted_by, F.posexplode(F.array(*_NAMES)).alias("feature", "value"))
    medians = cut(_quantile(flat, [*by, "feature"], F.col("value"), 0.5).withColumnRenamed("q", "median"))
    spread = cut(_quantile(flat.join(per_salt(medians), [*salted_by, "feature"]), [*by, "feature"], F.abs(F.col("value") - F.col("median")), 0.5))
    start = medians.join(spread, [*by, "feature"]).groupBy(*by).pivot("feature", list(range(_DIM))).agg(F.first("median").alias("m"), F.first("q").alias("q"))
    start = cut(start)
    apart = [((F.col(f) - F.col(f"{i}_m")) / F.greatest(F.col(f"{i}_q") * 1.4826, F.lit(_FLOORS[i]))) ** 2 for i, f in enumerate(_NAMES)]
    total = apart[0]
    for x in apart[1:]:
        total = total + x
    starts = F.array(F.struct(F.lit(0).alias("start"), F.log1p(total).alias("place")), F.struct(F.lit(1).alias("start"), F.log1p(F.greatest(*apart)).alias("place")))
    begun = rows.join(per_salt(start), salted_by).select(*salted_by, *_NAMES, F.explode(starts).alias("s")).select(*salted_by, *_NAMES, "s.*")

    scale = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, _DIM), _DIM + 2)  # what the scatter of the inner rows lacks under normality
    estimate = _concentrate(begun, [*by, "start"], scale)
    for _ in range(MAX_STEPS):
        placed = rows.join(per_salt(estimate), salted_by).select(*salted_by, "start", *_NAMES, F.log1p(_distance()).alias("place"))
        after = _concentrate(placed, [*by, "start"], scale)
        fell = estimate.join(after.select(*by, "start", F.col("log_det").alias("now")), [*by, "start"]).agg(F.max(F.col("log_det") - F.col("now"))).first()[0]
        estimate = after
        if fell is None or fell <= SETTLED:
            break
    else:
        raise RuntimeError(f"determinants still fell after {MAX_STEPS} concentration steps")
    fields = ["rows", *_MEANS, *_SCATTER.values()]
    best = cut(estimate.groupBy(*by).agg(F.min(F.struct("log_det", "start", *fields)).alias("e")).select(*by, *[F.col(f"e.{f}").alias(f) for f in fields]))

    def mixed(own: DataFrame, around: DataFrame, on: list[str]) -> DataFrame:
        outer = around.select(*on, *[F.col(f).alias(f"o_{f}") for f in fields])
        both = (own.join(outer, on) if on else own.crossJoin(F.broadcast(outer))).withColumn("w", F.col("rows") / (F.col("rows") + PRIOR_ROWS))  # without keys, ``around`` is one row
        w, v = F.col("w"), 1 - F.col("w")
        means = [(w * F.col(m) + v * F.col(f"o_{m}")).alias(m) for m in _MEANS]
        apart = [F.col(m) - F.col(f"o_{m}") for m in _MEANS]
        scatter = [(w * F.col(s) + v * F.col(f"o_{s}") + w * v * apart[i] * apart[j]).alias(s) for (i, j), s in _SCATTER.items()]
        return both.select("lang", "source", "rows", *means, *scatter)

    level = lambda n: best.where(F.col("level") == n).drop("level")
    languages = mixed(level(2), level(3), [])
    return cut(_factored(mixed(level(1), languages, ["lang"])))


def quality_verdicts(docs: DataFrame, *, min_words: int = 50, max_repeat: tuple[int, int] = (50, 100), tail: float = TAIL, by: tuple[str, str] = ("lang", "source"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, body, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept.

    ``base_failed`` is the plain limits: under ``min_words`` words, or more than ``max_repeat`` of the
    words in 3-word windows that the text has twice or more. Of the rest, a text is rejected if its
    squared Mahalanobis distance to the MCD estimate of its language and source exceeds the chi-squared
    quantile of ``tail``; ``mcd_estimates`` says how groups of any size get theirs.

    Scale: texts are read once; the staged table of statistics has no text. The estimates rest on all
    rows: quantiles are sums of bin counts and moments are sums, both partial before their shuffle, so a
    source with a third of all rows is one row per task. Estimates are a row per group, cut before rows
    meet them; while sums follow, rows meet them on a salt, too, so that these are partial as well.

    Edge cases: null texts have no words and fail. Null languages and sources are groups like others.
    Rows that repeat, and rows that repeat a doc_id, are judged each by its own text; a null doc_id is
    one like others. A very long text is hashed block by block; what is held of it is some 50 bytes a
    word. Other columns are ignored; an empty table gives an empty result.
    """
    base = keyed(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col)
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by)
    id_type = base.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), lang.alias("lang"), source.alias("source"), text.alias("text"))
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    stats = columns.mapInArrow(tidy(_count_rows), f"doc_id {id_type}, body long, lang string, source string, {counts}")
    part, whole = max_repeat
    failed = (F.col("n_words") < min_words) | (whole * F.col("n_repeat_words") > part * F.col("n_words"))
    judged = ~F.col("base_failed") & (F.col("n_words") > 0)
    stats = stage(stats.withColumn("base_failed", failed), "stats").withColumns({f: F.when(judged, F.expr(e)) for f, (e, _) in FEATURES.items()})
    estimates = mcd_estimates(salted(stats.where(judged), "doc_id", "body").select("lang", "source", "_salt", *_NAMES)).drop("rows")
    out = stats.join(estimates, ["lang", "source"], "left").withColumn("distance", F.when(judged, _distance()))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi2_quantile(1 - tail, _DIM))
    return out.select("doc_id", "body", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
