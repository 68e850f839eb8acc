"""F32: redaction of sensitive values in a property map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_

# Fixed values (must equal the reference): key fragments that mark a value
# as secret, and the replacement text.
SECRET_KEY_PARTS = ["key", "token", "secret", "auth", "password"]
REDACTED = "***REDACTED***"


def is_secret_key(k: Column) -> Column:
    low = F.lower(k)
    cond = None
    for p in SECRET_KEY_PARTS:
        cond = low.contains(p) if cond is None else cond | low.contains(p)
    return cond


def redact_map(m) -> Column:
    """Replace the value of every secret-looking key."""
    return F.transform_values(col_(m), lambda k, v: F.when(is_secret_key(k), F.lit(REDACTED)).otherwise(v))
