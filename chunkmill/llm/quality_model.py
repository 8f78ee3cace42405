"""Quality classifier: a sparse rule ensemble, compiled to Spark columns.

Shallow boosted trees over text statistics are grown on labelled rows; every path from a root becomes a
rule, a conjunction of comparisons. A logistic regression with a lasso penalty keeps few of them, and
the weighted rules become one Column expression, so scoring is a scan without Python or a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, WORD, keyed

#: Labelled rows that a model is fitted on at most, the first by md5 of their doc_id.
MAX_TRAIN = 20_000
#: Ids of labelled rows that are sent to every executor at most; more meet the texts by a shuffle.
MAX_BROADCAST = 100_000

#: Statistics of a text, as SQL over n_chars, n_words, n_lines and the texts' pieces.
FEATURES = {
    "log_words": "ln(1D + n_words)",
    "word_length": "n_letters / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "bangs": "n_bangs / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(n_letters, 1)",
    "digits": "n_digits / greatest(n_letters, 1)",
    "stops": "n_stops / greatest(n_words, 1)",
    "commas": "n_commas / greatest(n_words, 1)",
    "bars": "n_bars / greatest(n_words, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "repeated_lines": "1D - n_distinct_lines / n_lines",
    "line_words": "n_words / cast(n_lines as double)",
    "other_letters": "(n_bytes - n_chars) / greatest(n_chars, 1)",
}


def with_features(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``texts`` with a struct column ``features``; all are finite for any text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("double")
    words = F.split(text, rf"[{ASCII_SPACE}]+")
    lines = F.split(text, "\n", -1)
    parts = {
        "n_chars": F.char_length(text), "n_bytes": F.octet_length(text), "n_words": F.regexp_count(text, F.lit(WORD)),
        "n_letters": F.char_length(text) - count(rf"[{ASCII_SPACE}]"), "n_symbols": count("[#*$%&<>]"), "n_bangs": count("!"), "n_capitals": count("[A-Z]"),
        "n_digits": count("[0-9]"), "n_stops": count(r"[.?]"), "n_commas": count(","), "n_bars": count(r"\|"),
        "n_distinct": F.size(F.array_distinct(words)), "n_lines": F.size(lines), "n_distinct_lines": F.size(F.array_distinct(lines)),
    }
    counted = texts.withColumn("_counts", F.struct(*[c.cast("double").alias(n) for n, c in parts.items()]))
    fields = []
    for name, sql in FEATURES.items():
        for part in sorted(parts, key=len, reverse=True):
            sql = sql.replace(part, f"_counts.{part}") if f"_counts.{part}" not in sql else sql
        fields.append(F.expr(sql).alias(name))
    return counted.withColumn("features", F.struct(*fields)).drop("_counts")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature number, is greater, threshold)."""

    tests: tuple[tuple[int, bool, float], ...]

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, t in self.tests:
            out &= (x[:, f] > t) == above
        return out

    def column(self, features: str = "features") -> Column:
        names = list(FEATURES)
        out = None
        for f, above, t in self.tests:
            c = F.col(features)[names[f]]
            test = c > F.lit(t) if above else c <= F.lit(t)
            out = test if out is None else out & test
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, least: int, tests: tuple, rows: np.ndarray, out: list[tuple[tuple, np.ndarray, float]]) -> None:
    """Adds every node below the root to ``out`` as (tests, rows, Newton step)."""
    best, total_g, total_h = (1e-3, -1, 0.0), gradient[rows].sum(), hessian[rows].sum()
    if depth and len(rows) >= 2 * least:
        for f, edges in enumerate(cuts):
            bin_of = np.searchsorted(edges, x[rows, f], side="left")
            g = np.cumsum(np.bincount(bin_of, gradient[rows], len(edges) + 1))[:-1]
            h = np.cumsum(np.bincount(bin_of, hessian[rows], len(edges) + 1))[:-1]
            n = np.cumsum(np.bincount(bin_of, minlength=len(edges) + 1))[:-1]
            gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            gain[(n < least) | (len(rows) - n < least)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, float(edges[gain.argmax()]))
    if best[1] < 0:
        return
    above = x[rows, best[1]] > best[2]
    for side in (False, True):
        some = rows[above == side]
        node = (*tests, (best[1], side, best[2]))
        out.append((node, some, gradient[some].sum() / (hessian[some].sum() + 1)))
        _grow(x, cuts, gradient, hessian, depth - 1, least, node, some, out)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3) -> list[Rule]:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 64))) for f in range(x.shape[1])]
    margin, rules, least = np.zeros(len(y)), {}, max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        nodes: list = []
        _grow(x, cuts, y - p, p * (1 - p), depth, least, (), np.arange(len(y)), nodes)
        if not nodes:
            break
        inner = {tests[:-1] for tests, _, _ in nodes}
        for tests, rows, step in nodes:
            rules.setdefault(Rule(tests))
            if tests not in inner:
                margin[rows] += rate * step
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """(bias, weights) by accelerated proximal gradient steps; ``z`` is 0/1."""
    n, k = z.shape
    full = np.hstack([np.ones((n, 1), np.float32), z.astype(np.float32)])
    v = np.ones(k + 1, np.float32)
    for _ in range(20):  # largest eigenvalue, for the step
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v) + 1e-12
    step = 4 * n / max(float(v @ (full.T @ (full @ v))), 1e-9)
    w = ahead = np.zeros(k + 1, np.float64)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(full @ ahead.astype(np.float32)).astype(np.float64)))
        new = ahead - step * (full.T @ (p - y).astype(np.float32)).astype(np.float64) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = new + (last - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> RuleEnsemble:
    """The ensemble for 0/1 labels. With no rows, or labels of one kind, the score is a smoothed constant."""
    positive, n = float(y.sum()), len(y)
    constant = RuleEnsemble(float(np.log((positive + 1) / (n - positive + 1))), (), ())
    if not 0 < positive < n:
        return constant
    rules = tree_rules(x, y)
    if not rules:
        return constant
    bias, weights = lasso_logistic(np.column_stack([r.of(x) for r in rules]), y, penalty)
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-4]
    return RuleEnsemble(bias, tuple(r for r, _ in kept), tuple(w for _, w in kept))


def fit_quality(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> RuleEnsemble:
    """Fits on at most ``max_train`` labelled documents, the first by md5 of doc_id.

    The bound is on what the driver collects: a row of numbers for each. ``labels`` holds only rows that
    may be learnt from. Null labels and labels other than 0 and 1 are left out; a label without a
    document is ignored, of a doc_id that repeats with other texts one text counts.
    """
    some = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    some = some.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(max_train).select(F.col(id_col).alias("doc_id"), "y")
    if max_train <= MAX_BROADCAST:
        some = F.broadcast(some)  # max_train ids at most, so that no text is shuffled to meet them
    found = with_features(keyed(docs, id_col, text_col).join(some, "doc_id")).select("doc_id", F.struct("body", "y", "features").alias("row"))
    found = found.groupBy("doc_id").agg(F.min("row").alias("row"))  # one text of a doc_id that repeats, so max_train rows at most
    rows = found.orderBy("doc_id").select("row.y", "row.features.*").collect()
    if not rows:
        return fit_rules(np.zeros((0, len(FEATURES))), np.zeros(0))
    table = np.array([tuple(r) for r in rows], dtype=np.float64)
    return fit_rules(table[:, 1:], table[:, 0])


def score_quality(docs: DataFrame, model: RuleEnsemble, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: label 1 likelier).

    A scan with built-in functions: no shuffle, no state. Null texts are scored as empty ones; null and
    repeated doc_ids are rows like others. A very long text is split once into words and once into lines,
    rows as large as itself. Other columns are ignored; an empty table gives an empty result.
    """
    return with_features(keyed(docs, id_col, text_col)).select("doc_id", model.score().alias("score"))
