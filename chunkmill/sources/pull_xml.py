"""Unit rows of the tiers that a document's chunks need, parsed in memory bounded by one article or section.

Chunks are made of a document's lowest tier that gives any. A unit of tier 1 that is within the maximum
always gives one, and so does every unit of tier 2, so what comes after them is neither built nor counted
nor shuffled. That a unit is within the maximum is known without counting tokens if it has no list and no
more bytes than the maximum has tokens. Larger ones and lists may lose all their parts as too large, so
where no unit is known to fit, tier 2 is given as well.

A document of more than ``WHOLE`` bytes is read twice or more and never held as a tree: the first pass surveys what later ones need from
places that they haven't reached (the title, headings of sections, whether it is well-formed), each of the
others gives one tier from the outermost elements of its kind, each dropped when its rows are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import UNITS
from .legal_xml import ARTICLE, BODY, SECTION, UNIT, Tree, article_rows, context, in_batches, of_class, section_rows, simple_row

#: Bytes that a parser is fed at a time, and those up to which a document is read to a tree.
STEP, WHOLE = 1 << 16, 1 << 20
_LISTS, _HEADINGS = ("ol", "ul"), ("h2", "h3", "h4")


class Survey:
    """A parser target: the first h1, the heading of each section in order, and which tiers are needed."""

    def __init__(self, maximum: int) -> None:
        self._maximum = maximum
        self.first, self.second = False, False  # whether tiers 1 and 2 have rows
        self.settled = False  # a unit of tier 1 that is within the maximum for sure
        self._title: list[str] | None = None
        self._headings: list[dict[str, list[str]]] = []
        self._open: list[tuple[str, list[str] | None, list[int] | None]] = []
        self._sections: list[int] = []
        self._texts: list[list[str]] = []
        self._units: list[list[int]] = []  # of open units: bytes that their text has at most, and whether there is a list
        self._articles = self._grouping = 0

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        kind, inner = attributes.get("class"), bool(self._open)
        text = unit = None
        if kind == SECTION:
            self._sections.append(len(self._headings))
            self._headings.append({})
        if tag == "h1" and self._title is None:
            text = self._title = []
        elif tag in _HEADINGS and self._sections:
            text = []
            for n in self._sections:
                self._headings[n].setdefault(tag, text)
        if text is not None:
            self._texts.append(text)
        for u in self._units:
            u[0] += 2  # blanks around what is in it
            u[1] |= tag in _LISTS
        if tag == "article" and kind == UNIT:
            self.second |= self._grouping > 0
            if self._articles:
                self.first, unit = True, [0, False]
                self._units.append(unit)
        what = "article" if inner and tag == "article" and kind == ARTICLE else "grouping" if inner and tag == "section" and kind == SECTION else "section" if kind == SECTION else ""
        self._articles += what == "article"
        self._grouping += what == "grouping"
        self._open.append((what, text, unit))

    def data(self, characters: str) -> None:
        for text in self._texts:
            text.append(characters)
        if self._units:
            size = len(characters.encode())
            for u in self._units:
                u[0] += size

    def end(self, tag: str) -> None:
        what, text, unit = self._open.pop()
        self._articles -= what == "article"
        self._grouping -= what == "grouping"
        if what in ("grouping", "section"):
            self._sections.pop()
        if text is not None:
            self._texts.pop()
        if unit is not None:
            self._units.pop()
            self.settled |= not unit[1] and unit[0] <= self._maximum

    def close(self) -> None:
        pass

    @property
    def title(self) -> str:
        return "".join(self._title or ()).strip()

    def headings(self) -> list[str]:
        return [next(("".join(h[tag]).strip() for tag in _HEADINGS if tag in h), "") for h in self._headings]


def _steps(content: memoryview) -> Iterator[memoryview]:
    return (content[i : i + STEP] for i in range(0, len(content), STEP))


def _outermost(content: memoryview, wanted: Callable[[ElementTree.Element, ElementTree.Element], bool]) -> Iterator[tuple[ElementTree.Element, list[int]]]:
    """The outermost elements that are ``wanted`` (element, parent), each a whole tree, with the numbers of the sections around it. All else is dropped where it ends."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    around: list[tuple[ElementTree.Element, int | None]] = []
    held, sections = None, 0

    def events() -> Iterator[tuple[str, ElementTree.Element]]:
        for step in _steps(content):
            parser.feed(step)
            yield from parser.read_events()
        parser.close()
        yield from parser.read_events()

    for event, e in events():
        if event == "start":
            if held is None and around and wanted(e, around[-1][0]):
                held = e
            inside = e.get("class") == SECTION
            around.append((e, sections if inside else None))
            sections += inside
            continue
        around.pop()
        if e is held:
            yield e, [n for _, n in around if n is not None]
            held = None
        if held is None and around:
            around[-1][0].remove(e)


def _parents(e: ElementTree.Element) -> dict[ElementTree.Element, ElementTree.Element]:
    return {c: p for p in e.iter() for c in p}


def _tier(content: memoryview, seen: Survey, tier: int) -> Iterator[dict]:
    headings = seen.headings()
    outside = lambda numbers: [headings[n] for n in numbers if headings[n]]
    if tier == 1:
        for top, numbers in _outermost(content, lambda e, _: e.tag == "article" and e.get("class") == ARTICLE):
            parent, names = _parents(top), outside(numbers)
            for article in (top, *of_class(top, "article", ARTICLE)):
                yield from article_rows(article, context(article, parent, seen.title, names))
    elif tier == 2:
        number = 0
        for top, numbers in _outermost(content, lambda e, _: e.tag == "section" and e.get("class") == SECTION):
            parent, names = _parents(top), outside(numbers)
            for section in (top, *of_class(top, "section", SECTION)):
                yield from section_rows(section, number, context(section, parent, seen.title, names))
                number += 1
    else:
        main: list[ElementTree.Element] = []

        def below_main(e: ElementTree.Element, parent: ElementTree.Element) -> bool:
            if not main and e.tag == "main" and e.get("class") == BODY:
                main.append(e)
            return bool(main) and parent is main[0] and e.tag == "article" and e.get("class") == UNIT

        for n, (e, _) in enumerate(_outermost(content, below_main), 1):
            yield simple_row(e, n, seen.title)


def pull_units(document_id: str, content: bytes | memoryview | pa.Buffer, maximum: int) -> Iterator[dict]:
    """Unit rows of the tiers that are needed, as ``parse_units`` has them; one row with ``error`` if it isn't well-formed.

    ``maximum`` is that of a chunk in tokens, of which each has one byte at least.
    """
    blank = {f.name: None for f in UNITS} | {"document_id": document_id}
    content, seen = memoryview(content), Survey(maximum)
    parser = ElementTree.XMLParser(target=seen)
    try:
        for step in _steps(content):
            parser.feed(step)
        parser.close()
    except ElementTree.ParseError as error:
        yield blank | {"error": f"not well-formed: {error}"}
        return
    tiers = [1] * seen.first + [2] * (seen.second and not seen.settled) + [3] * (not seen.second and not seen.settled)
    seq = 0
    for tier in tiers:
        for row in _tier(content, seen, tier):
            yield blank | {"seq": seq} | row
            seq += 1


def needed_units(document_id: str, content: bytes | memoryview | pa.Buffer, maximum: int) -> Iterator[dict]:
    """As ``pull_units``; a document of at most ``WHOLE`` bytes is read once, to a tree, which takes half the time."""
    content = memoryview(content)
    if content.nbytes > WHOLE:
        yield from pull_units(document_id, content, maximum)
        return
    blank = {f: None for f in UNITS.names} | {"document_id": document_id}
    try:
        tree = Tree(content)
    except ElementTree.ParseError as error:
        yield blank | {"error": f"not well-formed: {error}"}
        return
    rows = list(tree.tier(1))
    if not any(r["parts"] is None and len(r["text"].encode()) <= maximum for r in rows):
        rows += list(tree.tier(2)) or tree.tier(3)
    for seq, row in enumerate(rows):
        yield blank | {"seq": seq} | row


def parse_needed(documents: DataFrame, maximum: int) -> DataFrame:
    """Unit rows of (document_id, content): per document, of the tiers that its chunks of ``maximum`` tokens are made of."""
    return documents.select("document_id", F.col("content").cast("binary").alias("content")).mapInArrow(in_batches(lambda name, content: needed_units(name, content, maximum), UNITS), UNITS)
