"""Whitespace and string helpers with Python ``str`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace()), generated
# from the Unicode tables; btrim over this set is str.strip() without regex.
PY_WHITESPACE = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def collapse_ws(c) -> Column:
    """``re.sub(r"\\s+", " ", s).strip()``."""
    return py_strip(F.regexp_replace(col_(c), r"(?U)\s+", " "))


def nullif_empty(c) -> Column:
    c = col_(c)
    return F.when(c != F.lit(""), c)


def first_non_empty(*cols) -> Column:
    """``a or b or c``: the first value that is neither null nor empty."""
    return F.coalesce(*[nullif_empty(c) for c in cols])


def truncate(c, n: int) -> Column:
    """``s[:n]`` counting code points."""
    return F.substring(col_(c), 1, n)
