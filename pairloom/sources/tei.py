"""TEI documents to element rows.

Mixed content needs document order and tails, which the XML reader of Spark does not keep, so a document
is parsed by a small function inside the tasks; Spark splits, streams and shuffles the rows around it.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pairloom.functions.workers import in_parts, ship_by_value, small_batches

ship_by_value(__name__)

_TEI = "{http://www.tei-c.org/ns/1.0}"
_XML_ID = "{http://www.w3.org/XML/1998/namespace}id"
_COLUMNS = ("section", "pos", "el_type", "txt", "tail", "coords", "xml_id", "type", "target")
ELEMENT_ROWS = (
    "section string, pos int, el_type string, txt string, tail string, coords string, "
    "xml_id string, type string, target string"
)


def _without_labels(el: ET.Element) -> str:
    text = el.text or ""
    for inner in el:
        if inner.tag != f"{_TEI}label":
            text += _without_labels(inner)
        text += inner.tail or ""
    return text


#: Elements that begin and end a passage; others are part of the text around them.
_PASSAGES = {"div", "list", "item", "note", "table", "row", "cell", "quote", "cit", "lg", "l", "floatingText", "body", "abstract", "listBibl"}


class _Walk:
    """Rows of a section in document order: each element's own text, its children, then what follows it.

    Text goes on in the row that is open: a sentence, or the tail of a reference. Where none is open, text that
    is not blank begins a sentence of its own. Labels of formulas and the inside of figures are left out.
    """

    def __init__(self) -> None:
        self.rows: list[list] = []
        self.field: int | None = None

    def _row(self, kind: str, text: str, tail: str | None, el: ET.Element, field: int | None) -> None:
        self.rows.append([kind, text, tail, el])
        self.field = field

    def _text(self, text: str | None) -> None:
        if not text:
            return
        if self.field is not None:
            self.rows[-1][self.field] += text
        elif text.strip():
            self._row("s", text, None, ET.Element("s"), 1)

    def element(self, el: ET.Element) -> None:
        name = el.tag.removeprefix(_TEI) if isinstance(el.tag, str) else ""
        if name == "head":
            self._row("head", f"<b>{''.join(el.itertext())}</b>\n", None, el, None)
        elif name == "ref":
            words = "".join(el.itertext())
            if el.get("target"):
                words = f"[{words.rstrip(';')}]"
            else:
                el.attrib.pop("type", None)
            self._row("ref", words, "", el, 2)
        elif name == "formula":
            self._row("formula", _without_labels(el), None, el, None)
        elif name == "figure":
            self._row("figure", "", None, el, None)
        elif isinstance(el.tag, str):
            if name == "p":
                self._row("p", "\n", None, el, None)
            elif name == "s":
                self._row("s", "", None, el, 1)
            elif name in _PASSAGES:
                self.field = None
            self._text(el.text)
            self.inside(el)
            if name in _PASSAGES or name in ("p", "s"):
                self.field = None

    def inside(self, el: ET.Element) -> None:
        for child in el:
            self.element(child)
            self._text(child.tail)


def _blocks(root: ET.Element) -> Iterator[tuple[str, str, str | None, ET.Element]]:
    """Elements of a section in document order as type, text, tail and source element."""
    walk = _Walk()
    walk._text(root.text)
    walk.inside(root)
    yield from map(tuple, walk.rows)


def _references(root: ET.Element) -> Iterator[tuple[str, str, str | None, ET.Element]]:
    for n, el in enumerate(root.iter(f"{_TEI}biblStruct"), 1):
        raw = next((x for x in el.iter(f"{_TEI}note") if x.get("type") == "raw_reference"), None)
        words = "".join(raw.itertext()) if raw is not None else " ".join("".join(el.itertext()).split())
        yield "bibr", f"[{n}] {words}", None, el


def elements_of(content: bytes) -> list[tuple]:
    """Rows of one document: section, position and fields of each element; one row ``failed`` when it is not XML."""
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        return [("failed", 0, "failed", *[None] * 6)]
    rows: list[tuple] = []

    def add(section: str, found) -> None:
        for pos, (kind, text, tail, el) in enumerate(found):
            rows.append(
                (section, pos, kind, text, tail, el.get("coords"), el.get(_XML_ID), el.get("type"), el.get("target"))
            )

    title = root.find(f".//{_TEI}titleStmt/{_TEI}title")
    if title is not None:
        rows.append(("title", 0, "title", "".join(title.itertext()), None, None, None, None, None))
    for section, path in (("abstract", f".//{_TEI}abstract"), ("body", f".//{_TEI}text/{_TEI}body")):
        part = root.find(path)
        if part is not None:
            add(section, _blocks(part))
    back = root.find(f".//{_TEI}text/{_TEI}back")
    if back is not None:
        add("back", _references(back))
    return rows


def tei_elements(documents: DataFrame, keys: tuple[str, ...] = ("paper_id",), content: str = "content") -> DataFrame:
    """One row per element of each TEI document in ``content``."""
    source = documents.select(*keys, F.col(content).cast("binary").alias("__content"))
    names = list(keys)

    def parse(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        found = [
            (*key, *row)
            for *key, xml in part[[*names, "__content"]].itertuples(index=False)
            for row in (elements_of(bytes(xml)) if xml is not None else [])
        ]
        yield pd.DataFrame.from_records(found, columns=[*names, *_COLUMNS])

    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields if f.name in names)
    small_batches(documents.sparkSession)
    return source.mapInPandas(in_parts(parse, "__content"), f"{key_types}, {ELEMENT_ROWS}")
