"""Evaluate expensive expressions exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns whose values are computed once per row.

    A filter on a projected column is normally pushed below the projection
    by substituting the column's expression, so an expensive expression
    (a date-format chain, a URL fingerprint used as a join key) would run
    in the filter and again in the projection.  Columns produced by a
    one-row ``inline`` generator are opaque to that rewrite: the filter
    stays above, reading the computed value."""
    packed = F.array(F.struct(*[e.alias(k) for k, e in exprs.items()]))
    return df.select("*", F.inline(packed))
