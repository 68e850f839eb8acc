"""Recovering reader of feed documents (RSS, RDF, Atom).

Feeds in the wild are not always well-formed, so ``from_xml`` would lose
items or whole documents.  Here one scanner walks a document through its
states (text, tag, CDATA section, comment, processing instruction, doctype):

* CDATA sections are text as they stand: no entity, no tag, no comment
  inside them means anything;
* elsewhere character references and named HTML entities become characters;
  an ``&`` that starts none stays as it is;
* a ``<`` that starts no tag is text;
* an end tag that closes nothing is skipped, an unclosed element ends with
  its item, an unclosed item with the next one or with the document.

``read_items`` runs it in Arrow batches, a row an item, with no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructType

from feedloom.functions.workers import lean

_NAME = r"[A-Za-z_][\w.\-]*(?::[A-Za-z_][\w.\-]*)?"
_ATTRIBUTES = r"""(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*)?"""
_TOKEN = re.compile(
    rf"<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|(?P<skip><!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<![A-Za-z][^\[<>]*(?:\[.*?\]\s*)?>)"
    rf"|</(?P<end>{_NAME})\s*>|<(?P<start>{_NAME})(?P<attributes>{_ATTRIBUTES}/?)>|(?P<text>[^<]+|<)", re.S)
_ENTITY = re.compile(r"&(?:#(\d{1,9})|#[xX]([0-9a-fA-F]{1,8})|([A-Za-z][A-Za-z0-9]*));")
#: Characters of documents whose items are given on at a time.
PIECE = 1 << 20
_HREF = re.compile(r"""(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)')""")


def _character(m: re.Match) -> str:
    if m[3]:
        return html5.get(m[3] + ";", m[0])
    n = int(m[1]) if m[1] else int(m[2], 16)
    # what is no character in XML
    return chr(n) if n in (9, 10, 13) or 32 <= n < 0xD800 or 0xE000 <= n < 0xFFFE or 0xFFFF < n < 0x110000 else "�"


def unescape(s: str) -> str:
    """Character references and named entities as characters."""
    return _ENTITY.sub(_character, s) if "&" in s else s


@dataclass
class Element:
    """A wanted element of an item."""
    name: str
    prefixed: bool
    depth: int
    parent: str
    href: str | None = None
    parts: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return "".join(self.parts)


def scan(document: str, roots: Sequence[str], wanted: frozenset[str]) -> dict[str, list[list[Element]]]:
    """Items of a document by root name (local names): of each, its wanted
    elements at any depth, in document order."""
    found: dict[str, list[list[Element]]] = {r: [] for r in roots}
    item: list[Element] | None = None
    root = ""
    stack: list[tuple[str, Element | None]] = []
    for m in _TOKEN.finditer(document):
        kind = m.lastgroup
        if kind == "skip":
            continue
        if kind in ("text", "cdata"):
            if item is not None:
                t = m[kind] if kind == "cdata" else unescape(m["text"])
                for _, e in stack:
                    if e is not None:
                        e.parts.append(t)
            continue
        if kind == "end":
            local = m["end"].rsplit(":", 1)[-1]
            if item is None:
                continue
            if local == root and all(n != local for n, _ in stack):
                item, stack = None, []
                continue
            if any(n == local for n, _ in stack):
                while stack.pop()[0] != local:
                    pass
            continue
        prefix, _, local = m["start"].rpartition(":")
        closed = m["attributes"].endswith("/")
        if local in found and (item is None or local == root):
            item, root, stack = [], local, []
            found[local].append(item)
            if closed:
                item = None
            continue
        if item is None:
            continue
        e = None
        if local in wanted:
            href = _HREF.search(m["attributes"])
            e = Element(local, bool(prefix), len(stack), stack[-1][0] if stack else "", unescape(href[1] or href[2] or "") if href else None)
            item.append(e)
        if not closed:
            stack.append((local, e))
    return found


def first(elements: list[Element], name: str) -> Element | None:
    """The first element of that name; one without a prefix goes before."""
    of = [e for e in elements if e.name == name]
    return next((e for e in of if not e.prefixed), of[0] if of else None)


def child(elements: list[Element], name: str) -> Element | None:
    """The first of the item's own children of that name."""
    return first([e for e in elements if not e.depth], name)


def read_items(docs: DataFrame, body: str, keep: Sequence[str], roots: Sequence[str], wanted: Sequence[str],
               fields: Sequence[tuple[str, str]], pick) -> DataFrame:
    """``keep`` + ``blank, pos, found, fields``: a row for each item of each
    document (the items of the first of ``roots`` that it has), and one with
    null ``pos`` for a document without any.

    ``pick`` turns an item's elements into the values of ``fields`` (name,
    ``string`` or ``array<string>``); ``found`` says whether it holds any
    wanted element."""
    src = docs.select(*keep, docs[body].cast("string").alias("__body"))
    out = StructType([f for f in src.schema.fields if f.name != "__body"]).add("blank", "boolean").add("pos", "long").add("found", "boolean")
    for name, kind in fields:
        out = out.add(name, ArrayType(StringType()) if kind.startswith("array") else StringType())
    kinds = [pa.list_(pa.string()) if k.startswith("array") else pa.string() for _, k in fields]
    names = [*keep, "blank", "pos", "found", *[n for n, _ in fields]]
    want, roots_ = frozenset(wanted), tuple(roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column(b.num_columns - 1)
            at, blank, pos, found, values = [], [], [], [], []

            def flush() -> pa.RecordBatch:
                cols = [b.column(i).take(pa.array(at, pa.int64())) for i in range(len(keep))]
                columns = list(zip(*values)) if values else [[] for _ in fields]
                return pa.RecordBatch.from_arrays([*cols, pa.array(blank, pa.bool_()), pa.array(pos, pa.int64()), pa.array(found, pa.bool_()),
                                                   *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names)

            size = 0
            for row in range(b.num_rows):
                text = bodies[row].as_py()  # one document at a time
                # spaces around a document say nothing
                empty = not text or not text.strip()
                got = {} if empty else scan(text, roots_, want)
                items = next((got[r] for r in roots_ if got.get(r)), [])
                for i, elements in enumerate(items):
                    at.append(row)
                    blank.append(False)
                    pos.append(i)
                    found.append(bool(elements))
                    values.append(pick(elements))
                if not items:
                    at.append(row)
                    blank.append(empty)
                    pos.append(None)
                    found.append(False)
                    values.append([None] * len(fields))
                size += len(text or "")
                if size > PIECE:
                    yield flush()
                    at, blank, pos, found, values, size = [], [], [], [], [], 0
            if at:
                yield flush()
    return src.mapInArrow(lean(run), out)
