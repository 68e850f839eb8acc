"""Parse landed feed documents into entry rows (SRC1, SRC3-SRC10).

Input: one row per fetched document, at least ``(feed, source_url, body)``
plus whatever ordering columns the caller carries (``source_priority``,
``page``).  Each parser emits one row per entry with ``pos`` (the entry's
position in its document), so first-wins order survives the shuffle.
Parsing is per row and needs no shuffle.  XML goes through the recovering
reader (``xml_items``), JSON through ``from_json``; what can't be read fails
nothing and is listed by ``feed_rejects``, ``paper_rejects`` and
``json_rejects``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import collapse_ws, first_non_empty, py_strip
from feedloom.sources.xml_items import Element, child, first, read_items

PAPER_FIELDS = (("id", "string"), ("title", "string"), ("published", "string"), ("summary", "string"), ("comment", "string"),
                ("authors", "array<string>"))
ITEM_FIELDS = (("title", "string"), ("link_text", "string"), ("link_href", "string"), ("pubDate", "string"), ("published", "string"),
               ("updated", "string"), ("description", "string"), ("encoded", "string"), ("summary", "string"))
_ITEM_WANTED = ("title", "link", "pubDate", "published", "updated", "description", "encoded", "summary")
#: Why a feed document, or an item of it, gives no record.
EMPTY, NO_ITEMS, BAD_ITEM, BAD_DOCUMENT = "empty_document", "no_items", "unreadable_item", "unreadable_document"


def _text(e: Element | None) -> str | None:
    return None if e is None else e.text


def _pick_paper(elements: list[Element]) -> list:
    own = [_text(child(elements, n)) for n, _ in PAPER_FIELDS[:-1]]
    return [*own, [e.text for e in elements if e.name == "name" and e.parent == "author" and e.depth == 1]]


def _pick_item(elements: list[Element]) -> list:
    """Fields at any depth, in document order; of several links the first."""
    link = first(elements, "link")
    rest = [_text(first(elements, n)) for n in _ITEM_WANTED[2:]]
    return [_text(first(elements, "title")), _text(link), None if link is None else link.href, *rest]


def _pick_child(elements: list[Element]) -> list:
    return _pick_item([e for e in elements if not e.depth])


def _explode(df: DataFrame, arr, keep: Sequence[str]) -> DataFrame:
    out = df.select(*keep, F.posexplode_outer(arr).alias("pos", "e")).where(F.col("e").isNotNull())
    return out.withColumn("pos", F.col("pos").cast("bigint"))


def _papers(docs: DataFrame, body: str, keep: Sequence[str]) -> DataFrame:
    wanted = [n for n, _ in PAPER_FIELDS[:-1]] + ["author", "name"]
    return read_items(docs, body, keep, ["entry"], wanted, PAPER_FIELDS, _pick_paper)


def atom_paper_entries(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """SRC1: Atom paper feed -> ``raw_id, paper_url, title, authors,
    published_raw, search_text`` per entry.  Entries without an id are
    dropped; the id is the text after the last ``/abs/`` (version kept)."""
    e = _papers(docs, body, keep)
    raw_id = py_strip(F.col("id"))
    arxiv_id = F.element_at(F.split(raw_id, "/abs/", -1), -1)
    title = F.col("title")
    authors = F.filter(F.transform("authors", lambda n: py_strip(n)), lambda n: n != "")
    return (e.where(raw_id.isNotNull() & (raw_id != ""))
             .select(*keep, "pos",
                     raw_id.alias("raw_id"),
                     F.concat(F.lit("https://arxiv.org/abs/"), arxiv_id).alias("paper_url"),
                     F.when(title.isNotNull() & (title != ""),
                            collapse_ws(F.replace(py_strip(title), F.lit("\n"), F.lit(" "))))
                      .otherwise(F.lit("Untitled")).alias("title"),
                     authors.alias("authors"),
                     py_strip(F.coalesce(F.col("published"), F.lit(""))).alias("published_raw"),
                     F.concat(F.coalesce(F.col("summary"), F.lit("")), F.lit(" "),
                              F.coalesce(F.col("comment"), F.lit(""))).alias("search_text")))


def _lost(read: DataFrame, keep: Sequence[str], lost: Column) -> DataFrame:
    reason = (F.when(F.col("blank"), F.lit(EMPTY)).when(F.col("pos").isNull(), F.lit(NO_ITEMS))
               .otherwise(F.lit(BAD_ITEM)))
    return read.where(lost).select(*keep, "pos", reason.alias("reason"))


def paper_rejects(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """The other side of ``atom_paper_entries``: documents without entries
    (``pos`` null) and entries without an id."""
    e = _papers(docs, body, keep)
    return _lost(e, keep, F.coalesce(py_strip(F.col("id")), F.lit("")) == "")


def _items(docs: DataFrame, body: str, keep: Sequence[str], roots: Sequence[str], pick=_pick_item) -> DataFrame:
    return read_items(docs, body, keep, roots, _ITEM_WANTED, ITEM_FIELDS, pick)


def feed_items(docs: DataFrame, body: str = "body", feed_url: str = "source_url",
               keep: Sequence[str] = ()) -> DataFrame:
    """SRC3/SRC4: ``item``s at any depth (RSS, RDF), else Atom ``entry``s,
    with the field chains: date = pubDate -> published -> updated; link = the
    first link's text -> its ``href`` -> feed URL; body = encoded ->
    description -> summary -> title."""
    e = _items(docs, body, [*keep, feed_url], ["item", "entry"]).where("found")
    title = py_strip(F.coalesce(F.col("title"), F.lit("")))
    return e.select(
        *keep, F.col(feed_url), "pos",
        title.alias("title"),
        F.coalesce(first_non_empty(py_strip(F.col("link_text")), "link_href"), F.col(feed_url)).alias("url"),
        py_strip(first_non_empty("pubDate", "published", "updated")).alias("date_raw"),
        F.coalesce(first_non_empty("encoded", "description", "summary"), title).alias("body_html"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
    )


def feed_rejects(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """The other side of ``feed_items``: ``keep`` + ``pos, reason`` for every
    document without items (``pos`` null) and every item that holds none of
    the fields."""
    return _lost(_items(docs, body, keep, ["item", "entry"]), keep, ~F.col("found"))


def product_rss_items(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """SRC5: items at any depth with their own title, link text and
    description; entries without a link are dropped (P4)."""
    e = _items(docs, body, keep, ["item"], _pick_child).where("found")
    url = py_strip(F.col("link_text"))
    return (e.select(*keep, "pos", py_strip(F.coalesce(F.col("title"), F.lit(""))).alias("title"),
                     url.alias("url"), F.coalesce(F.col("description"), F.lit("")).alias("description"))
             .where(F.col("url").isNotNull() & (F.col("url") != "")))


def json_array_entries(docs: DataFrame, element_schema: str, body: str = "body",
                       path: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """SRC6/SRC7/SRC10 (and the pages of SRC8/SRC9): JSON array (at the top
    level, or under key ``path``) -> one row per element, fields in ``e``."""
    schema = f"array<struct<{element_schema}>>" if path is None else f"struct<{path}:array<struct<{element_schema}>>>"
    parsed = F.from_json(F.col(body), schema, {"mode": "PERMISSIVE"})
    # (a lone object would be read as an array of one)
    arr = F.when(F.ltrim(F.col(body)).startswith("["), parsed) if path is None else parsed[path]
    # one element of another kind voids the array: only then by elements
    each = F.transform(_json_array(F.col(body), path), lambda v: F.when(
        F.schema_of_variant(v).startswith("OBJECT"), F.from_json(F.to_json(v), f"struct<{element_schema}>")))
    return _explode(docs.select(*keep, body), F.coalesce(arr, each), keep)


def _json_array(body: Column, path: str | None) -> Column:
    return F.try_variant_get(F.try_parse_json(body), "$" if path is None else f"$.{path}", "array<variant>")


def json_rejects(docs: DataFrame, body: str = "body", path: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The other side of ``json_array_entries``: ``keep`` + ``pos, reason``
    for every document that is blank, no JSON or holds no elements there
    (``pos`` null), and every element that is no object."""
    d = docs.select(*keep, (F.trim(F.coalesce(body, F.lit(""))) == "").alias("__blank"), F.try_parse_json(body).isNull().alias("__broken"),
                    _json_array(F.col(body), path).alias("__a"))
    e = d.select(*keep, "__blank", "__broken", (F.coalesce(F.size("__a"), F.lit(0)) <= 0).alias("__none"),
                 F.posexplode_outer("__a").alias("pos", "__e"))
    reason = (F.when(F.col("__blank"), F.lit(EMPTY)).when(F.col("__broken"), F.lit(BAD_DOCUMENT)).when(F.col("__none"), F.lit(NO_ITEMS))
               .when(~F.coalesce(F.schema_of_variant("__e"), F.lit("VOID")).startswith("OBJECT") & F.col("pos").isNotNull(), F.lit(BAD_ITEM)))
    return e.select(*keep, F.col("pos").cast("bigint").alias("pos"), reason.alias("reason")).where("reason is not null")


def pages_before_first_bad(pages: DataFrame, feed: Sequence[str], page: str = "page",
                           ok: str = "ok", max_pages: int | None = None) -> DataFrame:
    """SRC8/SRC9 paging stop rule: keep the pages of a feed that come before
    its first failing or empty page.  One tiny aggregate per feed (the first
    bad page number) is joined back; no page is gathered anywhere."""
    feed = list(feed)
    p = pages if max_pages is None else pages.where(F.col(page) <= max_pages)
    first_bad = p.groupBy(*feed).agg(F.min(F.when(~F.col(ok), F.col(page))).alias("__first_bad"))
    return (p.join(first_bad, feed, "left")
             .where(F.col("__first_bad").isNull() | (F.col(page) < F.col("__first_bad")))
             .drop("__first_bad"))
