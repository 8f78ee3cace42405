import tracemalloc
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkmill.document_queries import LIMITS, documents_as_xml
from chunkmill.operators.chunking import Limits, chunk_units, unit_pieces
from chunkmill.schema import UNITS
from chunkmill.sources import pull_xml
from chunkmill.sources.legal_xml import in_batches, markup_of, parse_documents, parse_units
from chunkmill.sources.pull_xml import parse_needed, pull_units
from oracle import SF

KINDS = st.sampled_from(
    [("article", "legalArticle"), ("article", "legalP"), ("section", "section"), ("div", "section"), ("main", "documentBody"), ("article", None), ("div", None), ("ol", None), ("li", None), ("h1", None), ("h2", None), ("h3", "section"), ("h4", None), ("span", "legalArticleValue"), ("p", None)]
)


def written(node) -> str:
    (tag, kind), text, children, tail = node
    named = f' class="{kind}" data-x-URL="{text}"' if kind else ' href="h"'
    return f"<{tag}{named}>{text}{''.join(map(written, children))}</{tag}>{tail}"


NODES = st.recursive(
    st.tuples(KINDS, st.sampled_from(["", " a ", "b c", "é&amp;"]), st.just([]), st.sampled_from(["", " t "])),
    lambda inner: st.tuples(KINDS, st.sampled_from(["", "x", " y z "]), st.lists(inner, max_size=5), st.sampled_from(["", "w "])),
    max_leaves=30,
)


def needed(rows: list[dict], maximum: int) -> list[dict]:
    """Of all rows, those of tiers that can be the lowest one with chunks."""
    if any(r["tier"] == 1 and r["parts"] is None and len(r["text"].encode()) <= maximum for r in rows):
        return [r for r in rows if r["tier"] == 1]
    return [r for r in rows if r["tier"] < 3] if any(r["tier"] == 2 for r in rows) else rows


@given(NODES, st.integers(1, 40), st.sampled_from([0, 4, 1000]))
@settings(max_examples=600, deadline=None)
def test_same_rows_as_a_tree(node, step, maximum):
    content = written(node[:3] + ("",)).encode()
    kept, pull_xml.STEP = pull_xml.STEP, step
    try:
        got = list(pull_units("d", content, maximum))
    finally:
        pull_xml.STEP = kept
    all_rows = parse_units("d", content)
    tiers, must = {r["tier"] for r in got}, needed(all_rows, maximum)
    assert got == [r for r in all_rows if r["tier"] in tiers] and [r for r in got if r in must] == must
    assert maximum < 1000 or got == must


def test_units_that_lose_all_their_sentences(spark):
    """Without an end of a sentence a large unit gives nothing in tier 1, so the section gives its text."""
    unit = f'<article class="legalP" id="u">{"word " * 300}</article>'
    page = f'<html><body><section class="section"><h2>S</h2><article class="legalArticle"><span class="legalArticleValue">1</span>{unit}</article></section></body></html>'
    rows, limits = spark.createDataFrame([("d", page)], "document_id string, content string"), Limits(50, 100, 10, 0.2)
    got, want = (chunk_units(x, limits).select("tier", "chunk_id", "text").collect() for x in (parse_needed(rows, 100), parse_documents(rows)))
    assert got == want and [(r["tier"], r["chunk_id"]) for r in got] == [(2, "section-u")]


@pytest.mark.parametrize("content", [b"", b"not xml", b"<a><b></a>", b"<a>&undefined;</a>", b"<a/><b/>", b"<a>" + b"x" * 200_000 + b"</b>", b"\xff\xfe"])
def test_same_errors_as_a_tree(content):
    assert list(pull_units("d", content, 500)) == parse_units("d", content)


def test_memory_is_that_of_one_article():
    unit = f'<article class="legalP">{"word " * 400}</article>'
    article = f'<article class="legalArticle"><span class="legalArticleValue">§</span>{unit * 5}</article>'
    content = f'<html><section class="section">{article * 1000}<h2>Late heading</h2></section></html>'.encode()
    assert len(content) > 10_000_000
    tracemalloc.start()
    rows = sum(r["section_heading"] == "Late heading" for r in pull_units("d", content, 8191))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 5000 and peak < 2_000_000


def test_same_chunks_from_fewer_rows(spark):
    pages = documents_as_xml(spark, SF).select("document_id", "content").cache()
    all_rows, fewer = parse_documents(pages), parse_needed(pages, LIMITS.maximum).cache()
    assert fewer.count() < all_rows.count()
    assert fewer.groupBy("document_id").agg(F.countDistinct("tier").alias("n")).where("n > 1").isEmpty()
    want, got = chunk_units(all_rows, LIMITS), chunk_units(fewer, LIMITS)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_null_and_repeated_documents(spark):
    good = '<html><main class="documentBody"><article class="legalP">a</article></main></html>'
    rows = spark.createDataFrame([("a", None), ("b", good), ("b", good), (None, good), ("c", "<html/>")], "document_id string, content string")
    got = sorted((str(r["document_id"]), r["text"], (r["error"] or "")[:15]) for r in parse_needed(rows, 500).collect())
    assert got == [("None", "a", ""), ("a", None, "not well-formed"), ("b", "a", ""), ("b", "a", "")]
    assert parse_needed(rows.limit(0), 500).count() == 0


@given(NODES, st.sampled_from([0, 4, 1000]))
@settings(max_examples=300, deadline=None)
def test_small_documents_from_a_tree(node, maximum):
    """One reading to a tree gives what the pull parser gives, with tiers that are needed and no others than it gives."""
    content = written(node[:3] + ("",)).encode()
    got, pulled, all_rows = list(pull_xml.needed_units("d", content, maximum)), list(pull_units("d", content, maximum)), parse_units("d", content)
    assert got == needed(all_rows, maximum) and [r for r in pulled if r in got] == got
    kept, pull_xml.WHOLE = pull_xml.WHOLE, 0
    try:
        assert list(pull_xml.needed_units("d", content, maximum)) == pulled
    finally:
        pull_xml.WHOLE = kept


def test_batches_hold_many_documents():
    rows = pa.RecordBatch.from_pylist([{"document_id": f"d{i}", "content": b'<m><main class="documentBody"><article class="legalP">a</article></main></m>'} for i in range(500)])
    for run in (in_batches(parse_units, UNITS), in_batches(lambda name, content: pull_xml.needed_units(name, content, 500), UNITS)):
        assert [len(b) for b in run(iter([rows]))] == [500]


@pytest.mark.parametrize("inner", ["", "a&amp;b", '<p x="&lt;&quot;&#10;&#9;&#13;\'&gt;"/>tail&gt;', "<p>x<q/>y</p> z", '<p xmlns="http://n" xmlns:a="http://a" a:b="c">t</p>', "<p><!-- gone -->é</p>"])
def test_markup_is_what_elementtree_writes(inner):
    e = ElementTree.fromstring(f'<r><s k="v">{inner}</s>end&amp;</r>')[0]
    assert markup_of(e) == ElementTree.tostring(e, encoding="unicode")


def test_units_are_parsed_and_shuffled_once(spark):
    """Pieces of all tiers come from one reading of the units, which are split and counted once, and meet in one shuffle."""
    units = parse_needed(documents_as_xml(spark, SF), LIMITS.maximum)
    for rows, shuffles in ((chunk_units(units, LIMITS), 1), (unit_pieces(units, LIMITS), 0)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        plan = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        assert plan.count("MapInArrow") == 1 and plan.count("Exchange ") == shuffles and plan.count("regexp_extract_all") == 3  # the split to units, and one count each of units and of parts
