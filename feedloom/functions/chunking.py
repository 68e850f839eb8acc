"""Job HTML (native part) and fence stripping: F26, F28, F29, F30.

The chunker is a higher-order ``aggregate`` fold over a document's
paragraphs, so it runs inside the JVM per row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_, py_strip

DEFAULT_CHUNK = 4000


def regex_html_text(html) -> Column:
    """drop script/style blocks, tags -> space, collapse whitespace."""
    h = col_(html)
    t = F.regexp_replace(h, r"(?is)<(script|style).*?>.*?</\1>", "")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    t = py_strip(F.regexp_replace(t, r"(?U)\s+", " "))
    return F.when(h.isNotNull() & (h != ""), t).otherwise(F.lit(""))


def _slices(p: Column, m: int) -> Column:
    n = F.ceil(F.length(p) / F.lit(m)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(p, i * m + 1, F.lit(m)))


def chunk_text(text, max_chunk: int = DEFAULT_CHUNK) -> Column:
    """F28 greedy packing.  Whole text when it fits (not trimmed); else
    blank-line paragraphs, trimmed, empties skipped, packed while
    ``n + len + 2 <= M``; an over-long paragraph is hard-sliced."""
    m = int(max_chunk)
    t = col_(text)
    paras = F.filter(F.transform(F.split(t, "\n\n", -1), lambda p: py_strip(p)), lambda p: p != "")
    init = F.struct(F.array().cast("array<string>").alias("chunks"),
                    F.lit(None).cast("string").alias("cur"),
                    F.lit(0).cast("bigint").alias("n"))

    def step(acc, p):
        ln = F.length(p).cast("bigint")
        fits = acc["n"] + ln + 2 <= m
        flushed = F.when(acc["cur"].isNull(), acc["chunks"]).otherwise(F.array_append(acc["chunks"], acc["cur"]))
        grown = F.when(acc["cur"].isNull(), p).otherwise(F.concat(acc["cur"], F.lit("\n\n"), p))
        return (
            F.when(fits, F.struct(acc["chunks"].alias("chunks"), grown.alias("cur"), (acc["n"] + ln + 2).alias("n")))
            .when(ln > m, F.struct(F.concat(flushed, _slices(p, m)).alias("chunks"),
                                   F.lit(None).cast("string").alias("cur"), F.lit(0).cast("bigint").alias("n")))
            .otherwise(F.struct(flushed.alias("chunks"), p.alias("cur"), ln.alias("n")))
        )

    def finish(acc):
        return F.when(acc["cur"].isNull(), acc["chunks"]).otherwise(F.array_append(acc["chunks"], acc["cur"]))

    packed = F.aggregate(paras, init, step, finish)
    return (F.when(t.isNull() | (t == ""), F.array().cast("array<string>"))
             .when(F.length(t) <= m, F.array(t))
             .otherwise(packed))


def strip_code_fence(text) -> Column:
    """trim; remove an opening three-backtick fence (+ language word)
    and a closing fence; trim again."""
    t = py_strip(col_(text))
    inner = F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z]*\n?", ""), r"\n?```$", "")
    return py_strip(F.when(t.startswith("```"), inner).otherwise(t))
