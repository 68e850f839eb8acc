"""Job TAG: rule-based classification (F14-F16).  First hit wins; the
substrings also hit inside words, as in the reference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_

# Fixed values (must equal the reference): role families and their
# trigger substrings, tested in this order; the fallback family last.
ROLE_RULES = [
    ("Research & Science", ["research", "scientist"]),
    ("Product Management", ["product", "pm"]),
    ("Data & Analytics", ["data", "analyst"]),
    ("Design & UX", ["design", "ui"]),
]
ROLE_DEFAULT = "Engineering"

# Fixed values (must equal the reference): pricing models and triggers, in
# order.  "$" is tested on the original text, the rest on lower case.
PRICING_RULES = [
    ("FREEMIUM", ["freemium", "free trial"]),
    ("ENTERPRISE", ["enterprise", "custom pricing"]),
    ("FREE", ["open-source", "apache", "mit", "free"]),
    ("PAID", ["paid", "subscription", "$"]),
]
PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]


def _any_contains(c: Column, words) -> Column:
    cond = None
    for w in words:
        t = c.contains(w)
        cond = t if cond is None else (cond | t)
    return cond


def role_family(title) -> Column:
    """F14; a null title is treated as empty (Engineering)."""
    t = F.lower(F.coalesce(col_(title), F.lit("")))
    out = None
    for fam, words in ROLE_RULES:
        out = F.when(_any_contains(t, words), F.lit(fam)) if out is None else out.when(_any_contains(t, words), F.lit(fam))
    return out.otherwise(F.lit(ROLE_DEFAULT))


def pricing_model(text) -> Column:
    """F15; null or empty text gives null; no hit gives null."""
    raw = col_(text)
    low = F.lower(raw)
    out = None
    for model, words in PRICING_RULES:
        cond = None
        for w in words:
            t = raw.contains(w) if w == "$" else low.contains(w)
            cond = t if cond is None else (cond | t)
        out = F.when(cond, F.lit(model)) if out is None else out.when(cond, F.lit(model))
    return F.when(raw.isNotNull() & (raw != ""), out)
