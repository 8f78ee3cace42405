import random

import pytest
from pyspark.sql import functions as F

from chunkmill.operators.folds import merge_groups, sentence_windows, target_groups

MERGES = [
    ((300, 8191), [100, 250, 50, 400, 20], [(0, 2, 350, 2), (2, 5, 470, 2)]),
    ((300, 8191), [100, 100], [(0, 2, 200, 2)]),
    ((300, 8191), [400], [(0, 1, 400, None)]),
    ((300, 8191), [50], [(0, 1, 50, None)]),
    ((300, 8191), [299, 8191], [(0, 2, 8490, 2)]),
    ((300, 8191), [], []),
]


def run(spark, expression, tokens):
    row = spark.createDataFrame([(tokens,)], "t array<bigint>").select(F.transform(expression(F.col("t")), lambda g: F.struct(g["start"], g["end"], g["tokens"], g["merged_count"])).alias("g")).first()
    return [tuple(g) for g in row["g"]]


@pytest.mark.parametrize(("limits", "tokens", "groups"), MERGES)
def test_merge(spark, limits, tokens, groups):
    assert run(spark, lambda t: merge_groups(t, *limits), tokens) == groups


def test_target(spark):
    assert [g[:2] for g in run(spark, lambda t: target_groups(t, 100), [60, 60, 30, 200, 10])] == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert run(spark, lambda t: target_groups(t, 100), []) == []


def naive_merge(tokens, low, high):
    out, buffer = [], []
    for i, t in enumerate(tokens):
        buffer.append(i)
        total = sum(tokens[k] for k in buffer)
        if total >= low or total + total // len(buffer) > high:
            out.append(buffer)
            buffer = []
    if len(buffer) == 1 and tokens[buffer[0]] < low and out and sum(tokens[k] for k in out[-1]) + tokens[buffer[0]] <= high:
        out[-1] = out[-1] + buffer
    elif buffer:
        out.append(buffer)
    return [(g[0], g[-1] + 1) for g in out]


def test_merge_against_naive(spark):
    rng = random.Random(5)
    cases = [[rng.choice([0, 5, 30, 90, 400, 900]) for _ in range(rng.randint(0, 25))] for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t array<bigint>").select("i", merge_groups(F.col("t"), 100, 500).alias("g")).collect()
    for r in rows:
        assert [(g["start"], g["end"]) for g in r["g"]] == naive_merge(cases[r["i"]], 100, 500)


def naive_windows(tokens, target, ratio):
    back = max(1, int(len(tokens) * int(target * ratio) / target))
    out, i = [], 0
    while i < len(tokens):
        j, total = i, 0
        while j < len(tokens) and total + tokens[j] <= target:
            total += tokens[j]
            j += 1
        if j > i:
            out.append((i, j))
        i = max(i + 1, j - back)
    return out


def windows(spark, cases, target, ratio):
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t array<int>").select("i", sentence_windows(F.col("t"), target, ratio).alias("w")).collect()
    return [None if r["w"] is None else [tuple(w) for w in r["w"]] for r in sorted(rows)]


def test_windows(spark):
    assert windows(spark, [[10] * 10, [10, 10, 60, 10], [], None], 50, 0.2) == [[(0, 5), (3, 8), (6, 10), (8, 10), (9, 10)], [(0, 2), (1, 2), (3, 4)], [], None]
    assert len(windows(spark, [[8] * 100], 100, 0.15)[0]) == 100
    assert windows(spark, [[10] * 6], 20, 0) == [[(0, 2), (1, 3), (2, 4), (3, 5), (4, 6), (5, 6)]]
    rng = random.Random(3)
    cases = [[rng.choice([0, 1, 5, 10, 60]) for _ in range(rng.randint(0, 30))] for _ in range(300)] + [[60] * 9, [0] * 9, [50] * 9]
    assert windows(spark, cases, 50, 0.2) == [naive_windows(tokens, 50, 0.2) for tokens in cases]


def test_windows_of_a_long_document(spark):
    rng = random.Random(4)
    tokens = [rng.choice([1, 5, 10, 40, 120]) for _ in range(20_000)]
    assert windows(spark, [tokens], 100, 0.0001) == [naive_windows(tokens, 100, 0.0001)]


def test_windows_need_no_python_worker(spark):
    plan = spark.range(1).select(F.array("id").alias("t")).select(sentence_windows(F.col("t"), 50, 0.2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
