"""Periodic runs, toxicity by compression, and spelling variants against plain versions and on the edge cases of their contracts."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute
from oracle import SF

from chunkmill.llm import periodic_runs, spelling, toxicity
from chunkmill.llm.queries import QUERIES

rng = random.Random(11)
RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def given(spark, name: str = "documents") -> list[tuple[int, str | None]]:
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/{name}.parquet").select("doc_id", "text").collect()]


def test_periodic_runs_query(spark):
    got = {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    want = {d: brute.run_digests(brute.planted_periods(d, t)) for d, t in given(spark)}
    assert got == want and sum(w[0] > 0 for w in want.values()) >= 10


@pytest.mark.parametrize("tried", [7, 1 << 20])
def test_periodic_runs_of_small_alphabets(monkeypatch, tried):
    """Nested, touching and overlapping runs, in several texts at once, with any number of grid points at a time."""
    monkeypatch.setattr(periodic_runs, "_TRIED", tried)
    texts = [[rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.randrange(40))] for _ in range(150)]
    texts += [[0] * 300, [0, 1] * 90 + [1] * 20 + [0, 1] * 30, ([0] * 7 + [1]) * 9, [i % 5 for i in range(203)], [], [1], [1] * 5, [1] * 6]
    texts += [t[:20] + t[:20] + t[:20] + t[:20] + t[:11] for t in texts[:40]]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    word = np.array([4 * k + w for k, t in enumerate(texts) for w in t], np.int64)
    start, end, period = periodic_runs.runs_of(word, first)
    got = [(int(s), int(e - s), int(q)) for s, e, q in zip(start, end, period, strict=True)]
    want = [(int(first[k]) + s, length, q) for k, t in enumerate(texts) for s, length, q in brute.periodic_runs([str(w) for w in t])]
    assert got == want


CLASHES = ("runs", "n_words", "body", "key", "word", "n", "size", "score", "y", "h", "w", "text2")


def odd_rows(spark):
    long = " ".join(f"w{i % 4001}x{i // 7}" for i in range(60_000))
    texts = [(None, "a b " * 10), (1, long), (1, long), (1, "one two three"), (2, "same " * 70_000), (3, ""), (4, None), (None, None), (5, " \t\n ")]
    return spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASHES})


def test_periodic_runs_of_odd_rows(spark):
    rows = [(r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["text"]) for r in periodic_runs.collapse_runs(odd_rows(spark)).collect()]
    assert sorted((d, n, len(x)) for d, n, x, _ in rows) == [(0, 0, 0), (0, 20, 1), (1, 3, 0), (1, 60_000, 0), (1, 60_000, 0), (2, 70_000, 1), (3, 0, 0), (4, 0, 0), (5, 0, 0)]
    assert [(x, t) for d, n, x, t in rows if len(x)] == [([(0, 20, 2)], "a b"), ([(0, 70_000, 1)], "same")]
    assert periodic_runs.collapse_runs(odd_rows(spark).limit(0)).count() == 0


def prose(n: int) -> list[str]:
    return [rng.choice(("the", "of", "sing", "tion", "er", "an")) + rng.choice(("ing", "ed", "", "er", "all", "ound")) + rng.choice(("", "s", "ly")) for _ in range(n)]


def rated(insults: tuple[str, ...], n: int, first: int) -> list[tuple[int, str, int]]:
    """Texts of which every fifth has one of the insults, once or a few times, anywhere."""
    out = []
    for i in range(n):
        text = prose(rng.randrange(20, 200))
        if i % 5 == 0:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(insults))
        out.append((first + i, " ".join(text), int(i % 5 == 0)))
    return out


def test_toxicity_of_planted_insults(spark):
    rows = rated(("blockhead", "Zounds", "knavish"), 600, 0)
    held = rated(("blockhead", "Zounds", "knavish"), 300, 1000)
    docs = spark.createDataFrame(rows + held, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(docs, docs.where("doc_id < 1000").select("doc_id", "toxic"))
    assert all(x in model.toxic for x in (b" blockhead ", b" zounds ", b" knavish "))
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([(score[d] >= 0.5) == bool(y) for d, _, y in held]) > 0.97 and all(0 <= s <= 1 for s in score.values())
    assert toxicity.fit_toxicity(docs, docs.where("doc_id < 1000").select("doc_id", "toxic")) == model
    # all windows of a long text are seen
    long = spark.createDataFrame([(1, " ".join(prose(60_000))), (2, " ".join([*prose(60_000), "blockhead"]))], "doc_id long, text string")
    seen = {r["doc_id"]: (r["n_windows"], r["most_gained"]) for r in toxicity.score_toxicity(long, model).collect()}
    assert seen[1][0] == 10_000 and seen[2][1] >= toxicity.FLAGGED


def test_toxicity_of_odd_rows(spark):
    docs = odd_rows(spark)
    ids = sorted(r["doc_id"] or 0 for r in docs.select("doc_id").collect())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (9, 0), (5, None), (4, 7)], "doc_id long, toxic int"), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")):
        model = toxicity.fit_toxicity(docs, labels)
        scores = toxicity.score_toxicity(docs, model).collect()
        assert sorted(r["doc_id"] or 0 for r in scores) == ids and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_toxicity_held_out(spark):
    path = SF.replace("sf0.001", "sf0.01")
    rows = QUERIES["op12_toxicity"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9


def test_spelling_query(spark):
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in QUERIES["op13_spelling_variants"](spark, SF).collect()}
    assert got == brute.spelling_variants(brute.planted_words(given(spark)))
    assert sum(v[1] > 0 for v in got.values()) > 100


@pytest.mark.parametrize("limits", [(3, 5), (50_000, 100_000)])
def test_spelling_variants(spark, limits):
    """Small alphabets make every kind of edit, equal halves, ties of n and chains of forms."""
    words = ["".join(rng.choice("abÉ") for _ in range(rng.randrange(5, 9))) for _ in range(250)]
    occurrences = [w for w in words for _ in range(rng.choice((1, 3, 5, 6, 25, 30, 160)))] + ["colour"] * 400 + ["color"] * 90 + ["colours"] * 70 + ["colourss"] * 12 + ["×÷" * 4] * 5
    df = spark.createDataFrame([(w, 0, "x") for w in occurrences] + [(None, 0, "x")], "word string, n int, size string")
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.spelling_variants(df, min_length=5, shard_words=limits[0], scan_words=limits[1]).collect()}
    assert got == brute.spelling_variants(occurrences, min_length=5)
    assert got["colourss"][4] == "colour" and got["color"][2:] == (None, None, "color")
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_words_of_odd_texts(spark):
    docs = odd_rows(spark)
    found = spelling.words_of_texts(docs)
    assert sorted({r["word"] for r in found.where("doc_id is null").collect()}) == ["a", "b"] and found.where("doc_id = 2").count() == 70_000
    assert {r["word"] for r in spelling.spelling_variants(found, min_length=4).collect()} == {"same"}
    mixed = spark.createDataFrame([(1, "Straße-ÀÉ x_y ÿ2z")], "doc_id long, text string")
    assert [r["word"] for r in spelling.words_of_texts(mixed).collect()] == ["straße", "ÀÉ", "x", "y", "ÿ", "z"]


def test_forms_in_a_circle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MAX_ROUNDS", 3)
    with pytest.raises(RuntimeError):
        spelling.follow(spark.createDataFrame([("a", "b"), ("b", "a")], "word string, form string"))


def test_parts_go_to_the_model_a_few_at_a_time(monkeypatch):
    """The ids are those of whole texts, however many parts are sent at once."""
    import public_tokenizers

    from chunkmill.llm import binary_tokens

    text, found = " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i // 26)}x{i}" for i in range(400)), []
    for size in (binary_tokens.PARTS_AT_ONCE, 1, 7, 5_000):
        monkeypatch.setattr(binary_tokens, "PARTS_AT_ONCE", size)
        encoder = binary_tokens.WordCachedEncoder(public_tokenizers.path("word_bpe_49k.json"))
        found.append([x.tolist() for x in encoder.encode([text.encode(), b""])])
    assert found == [[encoder.tokenizer.encode(text, add_special_tokens=False).ids, []]] * 4
