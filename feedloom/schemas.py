"""Record schemas (envelope + content), validation specs and tab layouts."""

from __future__ import annotations

from pyspark.sql import types as T

from feedloom.functions.tags import PRICING_MODELS

SCHEMA_VERSION = "1.0"

# record type names, and the order the store reads them back in
RECORD_TYPES = ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]

SOURCE = T.StructType([T.StructField("name", T.StringType()), T.StructField("url", T.StringType())])

CONTENT = {
    "STARTUP": T.StructType([T.StructField("entityName", T.StringType()),
                             T.StructField("employeeCount", T.LongType())]),
    "PRODUCT": T.StructType([T.StructField("startupName", T.StringType()),
                             T.StructField("pricingModel", T.StringType())]),
    "RESEARCH_PAPER": T.StructType([T.StructField("title", T.StringType()),
                                    T.StructField("authors", T.ArrayType(T.StringType())),
                                    T.StructField("paper_url", T.StringType()),
                                    T.StructField("github_url", T.StringType()),
                                    T.StructField("github_stars", T.LongType()),
                                    T.StructField("published_date", T.StringType())]),
    "JOB": T.StructType([T.StructField("company", T.StringType()),
                         T.StructField("date", T.StringType()),
                         T.StructField("is_remote", T.BooleanType()),
                         T.StructField("role_family", T.StringType())]),
    "NEWS": T.StructType([T.StructField("title", T.StringType()),
                          T.StructField("publication_date", T.StringType()),
                          T.StructField("full_text", T.StringType())]),
}


def envelope_schema(record_type: str) -> T.StructType:
    return T.StructType([
        T.StructField("schemaVersion", T.StringType()),
        T.StructField("recordType", T.StringType()),
        T.StructField("content", CONTENT[record_type]),
        T.StructField("source", SOURCE),
        T.StructField("collectedAt", T.StringType()),
    ])


# Validation specs: (field, kind, required, nullable, domain).  "required"
# means a missing key is rejected; "nullable" means JSON null is accepted.
VALIDATION = {
    "STARTUP": [("entityName", "str", True, False, None), ("employeeCount", "int", False, True, None)],
    "PRODUCT": [("startupName", "str", True, False, None),
                ("pricingModel", "enum", False, True, PRICING_MODELS)],
    "RESEARCH_PAPER": [("title", "str", True, False, None), ("authors", "list_str", False, False, None),
                       ("paper_url", "str", True, False, None), ("github_url", "str", False, True, None),
                       ("github_stars", "int", False, True, None),
                       ("published_date", "str", True, False, None)],
    "JOB": [("company", "str", True, False, None), ("date", "str", True, False, None),
            ("is_remote", "bool", False, False, None), ("role_family", "str", False, False, None)],
    "NEWS": [("title", "str", True, False, None), ("publication_date", "str", True, False, None),
             ("full_text", "str", True, False, None)],
}

# Defaults applied when an optional key is absent.
DEFAULTS = {
    "RESEARCH_PAPER": {"authors": []},
    "JOB": {"is_remote": True, "role_family": "Engineering"},
}

# Flat export tabs: (tab name, record type, [(header, source path)]).
TABS = {
    "startups": ("STARTUP", [("Entity Name", "content.entityName"), ("Employee Count", "content.employeeCount"),
                             ("Source Name", "source.name"), ("Source URL", "source.url"),
                             ("Collected At", "collectedAt")]),
    "products": ("PRODUCT", [("Startup Name", "content.startupName"), ("Pricing Model", "content.pricingModel"),
                             ("Source Name", "source.name"), ("Source URL", "source.url"),
                             ("Collected At", "collectedAt")]),
    "research_papers": ("RESEARCH_PAPER", [("Title", "content.title"), ("Authors", "content.authors"),
                                           ("Paper URL", "content.paper_url"), ("GitHub URL", "content.github_url"),
                                           ("GitHub Stars", "content.github_stars"),
                                           ("Published Date", "content.published_date")]),
    "jobs": ("JOB", [("Company", "content.company"), ("Date", "content.date"), ("Is Remote", "content.is_remote"),
                     ("Role Family", "content.role_family"), ("Source Name", "source.name"),
                     ("Source URL", "source.url")]),
    "news": ("NEWS", [("Title", "content.title"), ("Source Name", "source.name"), ("URL", "source.url"),
                      ("Publication Date", "content.publication_date"), ("Text Snippet", "content.full_text")]),
}
LOG_TAB = [("Raw Name", "raw_name"), ("Canonical Name", "canonical_name"), ("Match Method", "match_method")]
