"""Job HTML (Python part): parsed-HTML text and directory cards.

F25, F27, SRC11.  An HTML tree walk has no native Spark expression, so
these are Arrow-batched Python stages: each task parses its own pages with
the standard-library tokenizer; nothing crosses the driver.
The tree rules follow the html.parser tree builder: an end tag closes the
most recent open element of that name (or nothing), void elements never
open, whitespace-only text runs become a single newline or space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.chunking import regex_html_text
from feedloom.functions.workers import lean

# Fixed values (must equal the reference): subtrees removed before text
# extraction.
STRIPPED_TAGS = ("script", "style", "nav", "header", "footer", "noscript", "svg", "iframe")

# The void elements of HTML (those without an end tag) and their
# obsolete predecessors, as the HTML standard lists them.
VOID_TAGS = frozenset((
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
))
_ASCII_SPACES = " \n\t\x0c\r"
_PRESERVE_WS = frozenset(("pre", "textarea"))
_BLANK_RUN = re.compile(r"\n\s*\n")


class _TextWalker(HTMLParser):
    """Collects text runs not inside any of ``strip`` elements."""

    def __init__(self, strip: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.strip = frozenset(strip)
        self.stack: list[str] = []
        self.hidden = 0
        self.buf: list[str] = []
        self.out: list[str] = []

    def _flush(self):
        if not self.buf:
            return
        s = "".join(self.buf)
        self.buf = []
        if s.strip(_ASCII_SPACES) == "" and not _PRESERVE_WS.intersection(self.stack):
            s = "\n" if "\n" in s else " "
        if self.hidden == 0:
            self.out.append(s)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID_TAGS:
            return
        self.stack.append(tag)
        if tag in self.strip:
            self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self._flush()

    def handle_endtag(self, tag):
        self._flush()
        if tag in VOID_TAGS or tag not in self.stack:
            return
        while self.stack:
            t = self.stack.pop()
            if t in self.strip:
                self.hidden -= 1
            if t == tag:
                break

    def handle_data(self, data):
        self.buf.append(data)

    def _other(self, *_):
        self._flush()

    handle_comment = handle_decl = handle_pi = unknown_decl = _other

    def text(self) -> list[str]:
        self.close()
        self._flush()
        return self.out


def html_text(raw: str | None, separator: str = "\n", strip: Sequence[str] = STRIPPED_TAGS,
              collapse_blank: bool = True) -> str | None:
    """Visible text of an HTML string (F25 with defaults; F27 with
    ``separator=' '``, ``strip=()``, ``collapse_blank=False``); None if the
    tokenizer fails on it."""
    if not raw:
        return ""
    w = _TextWalker(strip)
    try:
        w.feed(raw)
        parts = w.text()
    except Exception:
        return None
    text = separator.join(parts)
    if collapse_blank:
        text = _BLANK_RUN.sub("\n\n", text)
    return text.strip()


def clean_html(df: DataFrame, html_col: str, out_col: str = "clean_text", separator: str = "\n",
               strip: Sequence[str] = STRIPPED_TAGS, collapse_blank: bool = True) -> DataFrame:
    """The other columns of ``df`` and the text of ``html_col``,
    which itself is dropped.  A scalar Arrow UDF: only the HTML goes to
    Python and only the text comes back.  Where the tokenizer fails, the
    regex text (F26) stands in."""
    strip = tuple(strip)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from lean(lambda bs: (pd.Series([html_text(h, separator, strip, collapse_blank) for h in b], dtype=object) for b in bs))(batches)

    keep = [c for c in df.columns if c not in (html_col, out_col)]
    t = df.select(*keep, text(F.col(html_col)).alias(out_col), regex_html_text(html_col).alias("__plain"))
    return t.select(*keep, F.coalesce(out_col, "__plain").alias(out_col))


def fragment_text(df: DataFrame, html_col: str, out_col: str = "fragment_text") -> DataFrame:
    """HTML fragment -> text joined with single spaces."""
    return clean_html(df, html_col, out_col, separator=" ", strip=(), collapse_blank=False)


# Fixed values (must equal the reference): the directory-card selectors.
CARD_PRIMARY_CLASS = "_company_159g8_11"
CARD_FALLBACK_HREF_PREFIX = "/companies/"
NAME_PRIMARY_CLASS = "_name_159g8_25"
NAME_FALLBACK_CLASS = "font-bold"


class _CardWalker(HTMLParser):
    """Finds the ``a`` elements of a page: href, classes, text, and for each
    name class the first ``span`` in document order that has it (spans are
    seen when they open, so an outer one comes before those inside it)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, dict | None]] = []  # open elements; a node for a and span only
        self.text: list[dict] = []  # the open a and span nodes
        self.cards: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        node = None
        if tag in ("a", "span"):
            a = dict(attrs)
            node = {"tag": tag, "cls": (a.get("class") or "").split(), "href": a.get("href"), "parts": [], "names": {}}
            if tag == "a":
                self.cards.append(node)
            else:
                for card in self.text:
                    if card["tag"] == "a":
                        for c in node["cls"]:
                            card["names"].setdefault(c, node)
            self.text.append(node)
        self.stack.append((tag, node))

    def handle_endtag(self, tag):
        if tag in VOID_TAGS or all(t != tag for t, _ in self.stack):
            return
        while self.stack:
            t, node = self.stack.pop()
            if node is not None:
                self.text.pop()
            if t == tag:
                break

    def handle_data(self, data):
        for node in self.text:
            node["parts"].append(data)

    def parse(self, raw: str) -> list[dict]:
        self.feed(raw)
        self.close()
        return self.cards


def _cards_of(raw: str | None) -> list[tuple]:
    if not raw:
        return []
    cards = _CardWalker().parse(raw)
    primary = [c for c in cards if CARD_PRIMARY_CLASS in c["cls"]]
    chosen = primary or [c for c in cards if (c["href"] or "").startswith(CARD_FALLBACK_HREF_PREFIX)]
    rows = []
    for pos, c in enumerate(chosen):
        name = c["names"].get(NAME_PRIMARY_CLASS) or c["names"].get(NAME_FALLBACK_CLASS)
        rows.append((pos, c["href"] or "", "".join(name["parts"]).strip() if name else "", "".join(c["parts"])))
    return rows


def directory_cards(df: DataFrame, html_col: str, keep: Sequence[str]) -> DataFrame:
    """SRC11: one row per directory card: ``keep`` columns + ``card_pos``,
    ``href``, ``raw_name``, ``card_text``."""
    keep = list(keep)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{k}` {fields[k]}" for k in keep]
                       + ["card_pos long", "href string", "raw_name string", "card_text string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf[keep + [html_col]].itertuples(index=False):
                base = tuple(rec[:-1])
                for card in _cards_of(rec[-1]):
                    out.append(base + card)
            yield pd.DataFrame(out, columns=keep + ["card_pos", "href", "raw_name", "card_text"])

    return df.select(*keep, html_col).mapInPandas(lean(run), schema)
