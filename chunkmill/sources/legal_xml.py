"""Legal documents in XML to unit rows: the one step that leaves the JVM, once per document.

A parser failure is a row with ``error``, never a failed task. ``parse_units`` makes all rows of a
document's tree; ``pull_xml`` those that its chunks need, without a tree of the whole document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import lru_cache
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import stem
from ..schema import MARKED_UNITS, UNITS

# Fixed values of the document format.
ARTICLE, UNIT, SECTION, BODY = "legalArticle", "legalP", "section", "documentBody"
_REF, _TITLE, _CONTINUED = "legalArticleValue", "legalArticleTitle", "leddfortsettelse"
_ADDRESS, _URL = "data-absoluteaddress", re.compile(r"data-\w+-URL")
#: Characters that a batch of rows holds before it is handed on.
FULL = 1 << 22


def _text(e: ElementTree.Element) -> str:
    return "".join(e.itertext()).strip()


def of_class(e: ElementTree.Element, tag: str, name: str) -> Iterator[ElementTree.Element]:
    """Descendants in document order with exactly this class."""
    return (x for x in e.iter(tag) if x is not e and x.get("class") == name)


def _list_text(e: ElementTree.Element) -> str:
    """Every item below, nested ones too, with its marker."""
    return "\n".join(" ".join(filter(None, (li.get("data-name", ""), _text(li)))) if li.get("data-name") else _text(li) for li in e.iter("li"))


def unit_text(e: ElementTree.Element) -> str:
    """Direct text, lists with markers, other children, and what follows them, joined by blanks."""
    found = [(e.text or "").strip()]
    for child in e:
        found.append(_list_text(child) if child.tag in ("ol", "ul") else _text(child))
        found.append((child.tail or "").strip())
    return " ".join(filter(None, found))


def list_parts(e: ElementTree.Element) -> list[str] | None:
    """A unit's lists and the runs of other children between them; None if there is no list below.

    The unit's own text and what follows children is in no part.
    """
    if next(e.iter("ol"), None) is None and next(e.iter("ul"), None) is None:
        return None
    parts, run = [], []
    for child in e:
        if child.tag in ("ol", "ul"):
            parts += [" ".join(run)] if run else []
            parts.append(_list_text(child))
            run = []
        elif text := _text(child):
            run.append(text)
    return parts + ([" ".join(run)] if run else [])


def heading_of(section: ElementTree.Element) -> str:
    """The first h2 below, else the first h3, else the first h4."""
    return next((_text(h) for tag in ("h2", "h3", "h4") for h in section.iter(tag)), "")


def context(e: ElementTree.Element, parent: Mapping[ElementTree.Element, ElementTree.Element], title: str, outside: Sequence[str] = ()) -> dict:
    """The sections around an element; ``outside`` are headings of those beyond what ``parent`` knows."""
    path, at = [], parent.get(e)
    while at is not None:
        if at.get("class") == SECTION and (name := heading_of(at)):
            path.insert(0, name)
        at = parent.get(at)
    path = [*outside, *path]
    return {"document_title": title, "chapter_path": path, "section_heading": path[-1] if path else ""}


@lru_cache(1024)
def _is_url(name: str) -> bool:
    return _URL.fullmatch(name) is not None


def _write(e: ElementTree.Element, out: list[str]) -> None:
    tag, escape = e.tag, _escaped
    out.append(f"<{tag}")
    for k, v in e.items():
        if k[0] == "{":
            raise ValueError("a name space")
        v = escape(v)
        if '"' in v or "\r" in v or "\n" in v or "\t" in v:
            v = v.replace('"', "&quot;").replace("\r", "&#13;").replace("\n", "&#10;").replace("\t", "&#09;")
        out.append(f' {k}="{v}"')
    if e.text or len(e):
        out.append(f">{escape(e.text)}" if e.text else ">")
        for c in e:
            _write(c, out)
        out.append(f"</{tag}>")
    else:
        out.append(" />")
    if tag[0] == "{":
        raise ValueError("a name space")
    if e.tail:
        out.append(escape(e.tail))


def _escaped(text: str) -> str:
    if "&" in text or "<" in text or ">" in text:
        return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return text


def markup_of(e: ElementTree.Element) -> str:
    """``ElementTree.tostring``; without name spaces, which need prefixes, in a fraction of its time."""
    out: list[str] = []
    try:
        _write(e, out)
    except ValueError:
        return ElementTree.tostring(e, encoding="unicode")
    return "".join(out)


def _place(e: ElementTree.Element, markup: bool) -> dict:
    url = ""
    for k, v in e.items():
        if _is_url(k):
            url = v
            break
    links = [h for a in e.iter("a") if (h := a.get("href")) is not None]
    more = {"hrefs": links, "markup": markup_of(e)} if markup else {}
    return {"address": e.get(_ADDRESS, ""), "url": url, "cross_refs": links} | more


def article_rows(article: ElementTree.Element, around: dict, markup: bool = False) -> Iterator[dict]:
    """Tier 1: the units below an article."""
    spans = list(article.iter("span"))
    first = lambda name: next((_text(s) for s in spans if s.get("class") == name), None)
    around = around | {"paragraph_ref": first(_REF) or "", "paragraph_title": first(_TITLE)}
    for n, e in enumerate(of_class(article, "article", UNIT), 1):
        # what is cut out of a list has neither address nor references of its own
        yield {"tier": 1, "unit_id": e.get("id"), "ledd_number": n, "text": unit_text(e), "parts": list_parts(e)} | around | _place(e, markup)


def section_rows(section: ElementTree.Element, number: int, around: dict, markup: bool = False) -> Iterator[dict]:
    """Tier 2: the units below a section."""
    around = around | {"section_heading": heading_of(section)}
    for e in of_class(section, "article", UNIT):
        yield {"tier": 2, "section": number, "unit_id": e.get("id"), "text": _text(e)} | around | _place(e, markup)


def simple_row(e: ElementTree.Element, n: int, title: str, markup: bool = False) -> dict:
    """Tier 3: a unit right below the main element."""
    return {"tier": 3, "unit_id": e.get("id"), "ledd_number": n, "text": _text(e), "document_title": title} | _place(e, markup)


class Tree:
    """A whole document; ``tier`` gives the rows of one tier."""

    def __init__(self, content: bytes | memoryview, markup: bool = False) -> None:
        self.root, self.markup = ElementTree.fromstring(content), markup
        self.parent = {c: p for p in self.root.iter() for c in p}
        self.title = next((_text(h) for h in self.root.iter("h1")), "")

    def header(self) -> str | None:
        return next((markup_of(h) for h in self.root.iter("header")), None)

    def tier(self, number: int) -> Iterator[dict]:
        root = self.root
        if number == 1:
            for article in of_class(root, "article", ARTICLE):
                yield from article_rows(article, context(article, self.parent, self.title), self.markup)
        elif number == 2:
            for n, section in enumerate(of_class(root, "section", SECTION)):
                yield from section_rows(section, n, context(section, self.parent, self.title), self.markup)
        else:
            main = next((m for m in root.iter("main") if m is not root and m.get("class") == BODY), ())
            for n, e in enumerate((x for x in main if x.tag == "article" and x.get("class") == UNIT), 1):
                yield simple_row(e, n, self.title, self.markup)


def parse_units(document_id: str, content: bytes | memoryview, markup: bool = False) -> list[dict]:
    """Unit rows of all three tiers of one document; one row with ``error`` if it isn't well-formed.

    With ``markup`` they carry what enrichers read: the document's header, the unit's markup and its links.
    """
    blank = {f: None for f in (MARKED_UNITS if markup else UNITS).names} | {"document_id": document_id}
    try:
        tree = Tree(content, markup)
    except ElementTree.ParseError as error:
        return [blank | {"error": f"not well-formed: {error}"}]
    if markup:
        blank["header"] = tree.header()
    return [blank | {"seq": n} | x for n, x in enumerate(x for tier in (1, 2, 3) for x in tree.tier(tier))]


def in_batches(rows_of: Callable[[str | None, memoryview], Iterable[dict]], schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function from (document_id, content) to the rows of ``rows_of``, as many documents' in a batch as ``FULL`` characters hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for document_id, content in zip(batch.column("document_id"), batch.column("content"), strict=True):
                for row in rows_of(document_id.as_py(), memoryview(content.as_buffer() if content.is_valid else b"")):
                    rows.append(row)
                    held += len(row["text"] or "") + len(row.get("markup") or "") + len(row.get("header") or "") + 256
                    if held >= FULL:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return run


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(document_id, path, content) of the XML files below ``root``; the id is the file's stem."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(root)
    return found.select(stem(F.col("path")).alias("document_id"), "path", "content")


def parse_documents(documents: DataFrame, markup: bool = False) -> DataFrame:
    """Unit rows of (document_id, content); with ``markup`` in the columns that enrichers read, too."""
    schema = MARKED_UNITS if markup else UNITS
    return documents.select("document_id", F.col("content").cast("binary").alias("content")).mapInArrow(in_batches(lambda name, content: parse_units(name, content, markup), schema), schema)
