"""Job EXTRACTION-RESULTS: landed extraction responses.

Input: ``responses(doc_id, tier, provider, raw, error)``, one row per
attempt.  Validation is column logic over ``try_parse_json`` variants, so
it stays in whole-stage code; the lax coercions follow the reference's
model library (see ``feedloom.schemas.VALIDATION``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.chunking import strip_code_fence
from feedloom.schemas import DEFAULTS, VALIDATION

OK = "ok"
MALFORMED = "malformed_json"
INVALID = "schema_invalid"
PROVIDER_ERROR = "provider_error"

_INT_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
_BOOL_TEXT = ["0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes"]
_TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind_ok(fv: Column, kind: str, domain) -> Column:
    t = F.schema_of_variant(fv)
    num = F.try_variant_get(fv, "$", "double")
    text = F.try_variant_get(fv, "$", "string")
    if kind == "str":
        return t == "STRING"
    if kind == "int":
        return (t == "BIGINT") | (t == "BOOLEAN") | \
               ((t.startswith("DECIMAL") | (t == "DOUBLE")) & (num == F.floor(num))) | \
               ((t == "STRING") & text.rlike(_INT_TEXT))
    if kind == "bool":
        return (t == "BOOLEAN") | \
               ((t.isin("BIGINT", "DOUBLE") | t.startswith("DECIMAL")) & num.isin(0.0, 1.0)) | \
               ((t == "STRING") & F.lower(text).isin(_BOOL_TEXT))
    if kind == "enum":
        return (t == "STRING") & text.isin(list(domain))
    if kind == "list_str":
        arr = F.try_variant_get(fv, "$", "array<variant>")
        return (t.startswith("ARRAY")) & F.forall(arr, lambda x: F.schema_of_variant(x) == "STRING")
    raise ValueError(kind)


def _typed(fv: Column, kind: str) -> Column:
    text = F.try_variant_get(fv, "$", "string")
    if kind in ("str", "enum"):
        return text
    if kind == "int":
        t = F.schema_of_variant(fv)
        return (F.when(t == "BOOLEAN", F.try_variant_get(fv, "$", "boolean").cast("bigint"))
                 .when(t == "STRING", F.regexp_extract(text, r"[+-]?\d+", 0).try_cast("bigint"))
                 .when(t == "DOUBLE", F.try_variant_get(fv, "$", "double").try_cast("bigint"))
                 .otherwise(F.try_variant_get(fv, "$", "bigint")))
    if kind == "bool":
        t = F.schema_of_variant(fv)
        return (F.when(t == "BOOLEAN", F.try_variant_get(fv, "$", "boolean"))
                 .when(t == "STRING", F.lower(text).isin(_TRUE_TEXT))
                 .otherwise(F.try_variant_get(fv, "$", "double") == 1.0))
    if kind == "list_str":
        return F.try_variant_get(fv, "$", "array<string>")
    raise ValueError(kind)


def _violations(root_t: Column, fields: list[tuple[Column, Column]], record_type: str) -> Column:
    checks = [F.when(~root_t.startswith("OBJECT"), F.lit("not_object"))]
    for (name, kind, required, nullable, domain), (fv, ft) in zip(VALIDATION[record_type], fields):
        bad = (F.when(fv.isNull(), F.lit(f"missing:{name}") if required else F.lit(None))
                .when(ft == "VOID", F.lit(None) if nullable else F.lit(f"null:{name}"))
                .when(~_kind_ok(fv, kind, domain), F.lit(f"type:{name}")))
        checks.append(bad)
    return F.array_compact(F.array(*checks))


def violations(v: Column, record_type: str) -> Column:
    """V1: array of rule violations for a parsed response (empty = valid)."""
    fields = [(_field(v, f[0]), F.schema_of_variant(_field(v, f[0]))) for f in VALIDATION[record_type]]
    return _violations(F.schema_of_variant(v), fields, record_type)


def validate_responses(df: DataFrame, record_type: str, raw_col: str = "raw",
                       error_col: str = "error") -> DataFrame:
    """Adds ``clean``, ``violations``, ``outcome`` (T2), ``rate_limited``
    (F31) and one typed column per schema field (null unless valid).

    Each stage is its own projection: the parsed variant and each field's
    value are computed once per row and referenced by the later rules
    (the optimizer does not re-inline non-trivial shared expressions)."""
    spec = VALIDATION[record_type]
    base = df.select("*", F.when(F.col(error_col).isNull(), strip_code_fence(F.col(raw_col))).alias("clean"))
    parsed = base.select("*", F.try_parse_json(F.col("clean")).alias("__v"))
    fcols = []
    for i, (name, *_rest) in enumerate(spec):
        fcols.append(_field(F.col("__v"), name).alias(f"__f{i}"))
    withf = parsed.select("*", F.schema_of_variant(F.col("__v")).alias("__root"), *fcols)
    withf = withf.select("*", *[F.schema_of_variant(F.col(f"__f{i}")).alias(f"__t{i}") for i in range(len(spec))])
    pairs = [(F.col(f"__f{i}"), F.col(f"__t{i}")) for i in range(len(spec))]
    viol = withf.select("*", F.when(F.col("__v").isNotNull(), _violations(F.col("__root"), pairs, record_type))
                        .alias("violations"))
    err = F.lower(F.col(error_col))
    outcome = (F.when(F.col(error_col).isNotNull(), F.lit(PROVIDER_ERROR))
                .when(F.col("__v").isNull(), F.lit(MALFORMED))
                .when(F.size("violations") > 0, F.lit(INVALID))
                .otherwise(F.lit(OK)))
    rate = F.coalesce(F.col(error_col).contains("429") | err.contains("rate limit") | err.contains("quota"),
                      F.lit(False))
    out = viol.select("*", outcome.alias("outcome"), rate.alias("rate_limited"))
    defaults = DEFAULTS.get(record_type, {})
    typed = []
    for i, (name, kind, *_r) in enumerate(spec):
        fv = F.col(f"__f{i}")
        val = _typed(fv, kind)
        if name in defaults:
            d = defaults[name]
            lit = F.array().cast("array<string>") if d == [] else F.lit(d)
            val = F.when(fv.isNull(), lit).otherwise(val)
        typed.append(F.when(F.col("outcome") == OK, val).alias(name))
    out = out.select("*", *typed)
    temps = ["__v", "__root"] + [f"__f{i}" for i in range(len(spec))] + [f"__t{i}" for i in range(len(spec))]
    return out.drop(*temps)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows (with reasons) as two outputs."""
    return (validated.where(F.col("outcome") == OK),
            validated.where(F.col("outcome") != OK))


def first_valid_by_tier(validated: DataFrame, docs: DataFrame | None, record_type: str,
                        key: str = "doc_id") -> DataFrame:
    """Per document, the lowest-tier valid response; none -> nulls.

    ``min`` over ``struct(tier, ...)`` of valid attempts (null for the
    others, which ``min`` skips) aggregates map-side, so a document with
    many attempts never gathers them in one task.  Pass ``docs`` only when
    some documents have no attempt at all; that join is a shuffle join,
    since both sides grow with the data."""
    fields = [f[0] for f in VALIDATION[record_type]]
    packed = F.when(F.col("outcome") == OK, F.struct("tier", "provider", *fields))
    best = validated.groupBy(key).agg(F.min(packed).alias("__b"))
    best = best.select(key, *[F.col(f"__b.{c}").alias(c) for c in ["tier", "provider", *fields]])
    if docs is None:
        return best
    return docs.select(key).join(best.hint("merge"), key, "left")


def failover_rate(validated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents answered by their first tier, by a later one (failed
    over) and by none, and the failover share in parts per million."""
    tiers = validated.groupBy(key).agg(F.min("tier").alias("first"), F.min(F.when(F.col("outcome") == OK, F.col("tier"))).alias("got"))
    n = F.count(F.lit(1))
    over = F.count_if(F.col("got") > F.col("first"))
    return tiers.agg(n.alias("documents"), F.count_if(F.col("got") == F.col("first")).alias("first_tier"),
                     over.alias("failed_over"), F.count_if(F.col("got").isNull()).alias("unanswered"),
                     F.expr("try_divide(count_if(got > first) * 1000000, count(1))").cast("bigint").alias("failover_ppm"))


def attempt_outcomes(validated: DataFrame) -> DataFrame:
    """T2 summary: attempts per provider and outcome, with rate-limit count."""
    return (validated.groupBy("provider", "outcome")
            .agg(F.count(F.lit(1)).alias("attempts"),
                 F.count_if(F.col("rate_limited")).alias("rate_limited")))


def split_by_source_url(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10: records without a source URL are rejected (kept aside with the
    reason); the rest pass.  Papers fall back to ``content.paper_url``
    first (SNK2), as the store does."""
    src = F.col("source.url")
    if "paper_url" in envelopes.schema["content"].dataType.fieldNames():
        src = F.coalesce(F.when(src != "", src), F.col("content.paper_url"))
    ok = F.coalesce(src != "", F.lit(False))
    return (envelopes.where(ok),
            envelopes.where(~ok).withColumn("violations", F.array(F.lit("missing:source.url"))))
