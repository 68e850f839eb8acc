"""Job EXTRACT: structured values out of feed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_, py_strip

# Fixed values (must equal the reference): owner names that are site
# routes, not repository owners.
DENIED_OWNERS = ["topics", "sponsors", "features", "pricing", "about", "blog"]

# Fixed values (must equal the reference): patterns of repository links and
# keys, title splits and employee ranges.
REPO_LINK_RE = r"https?://github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)"
_REPO_KEY_RE = r"github\.com/([^/#?]+)/([^/#?]+)"
_JOB_TITLE_SPLIT = r"(?iU)\s+at\s+|\s+-\s+|\s+:\s+"
_PRODUCT_TITLE_SPLIT = r"(?iU)\s+by\s+|\s+-\s+"
_EMPLOYEES_RE = r"(?iU)(\d+)\s*-\s*(\d+)\s+employees?"


def repo_link(text) -> Column:
    """first repository link in the text whose owner is not denied,
    trailing ``.,;:)>]`` stripped from the repo, rebuilt as https."""
    t = col_(text)
    owners = F.regexp_extract_all(t, F.lit(REPO_LINK_RE), 1)
    repos = F.regexp_extract_all(t, F.lit(REPO_LINK_RE), 2)
    pairs = F.zip_with(owners, repos, lambda o, r: F.struct(o.alias("o"), r.alias("r")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["o"]).isin(DENIED_OWNERS))
    first = F.get(kept, 0)
    repo = F.regexp_replace(first["r"], r"[.,;:)>\]]+$", "")
    return F.when(first.isNotNull(), F.concat(F.lit("https://github.com/"), first["o"], F.lit("/"), repo))


def repo_key(link) -> Column:
    """``struct(owner, repo)`` from a repository link, or null."""
    u = col_(link)
    cleaned = F.regexp_replace(F.regexp_replace(py_strip(u), r"/+$", ""), r"\.git$", "")
    owner = F.regexp_extract(cleaned, _REPO_KEY_RE, 1)
    repo = F.regexp_extract(cleaned, _REPO_KEY_RE, 2)
    ok = u.contains("github.com") & cleaned.rlike(_REPO_KEY_RE) & ~F.lower(owner).isin(DENIED_OWNERS)
    return F.when(ok, F.struct(owner.alias("owner"), repo.alias("repo")))


def job_company(title, default: str = "AI Tech Company") -> Column:
    """second part of the title split on at / - / : (any case)."""
    parts = F.split(F.coalesce(col_(title), F.lit("")), _JOB_TITLE_SPLIT, -1)
    return F.when(F.size(parts) > 1, py_strip(F.get(parts, 1))).otherwise(F.lit(default))


def product_vendor(title) -> Column:
    """second part of the title split on by / -, else the first."""
    parts = F.split(F.coalesce(col_(title), F.lit("")), _PRODUCT_TITLE_SPLIT, -1)
    return F.when(F.size(parts) > 1, py_strip(F.get(parts, 1))).otherwise(py_strip(F.get(parts, 0)))


def model_owner(model_id) -> Column:
    """``owner`` of ``owner/name`` (split once)."""
    return F.substring_index(col_(model_id), "/", 1)


def employee_upper(card_text) -> Column:
    """upper bound ``b`` of ``a - b employees``."""
    t = col_(card_text)
    return F.when(t.rlike(_EMPLOYEES_RE), F.regexp_extract(t, _EMPLOYEES_RE, 2).try_cast("bigint"))


def absolute_url(href, base: str) -> Column:
    """prefix a site-relative href with ``base``."""
    h = F.coalesce(col_(href), F.lit(""))
    return F.when(h.startswith("/"), F.concat(F.lit(base), h)).otherwise(h)


def profile_url(ident, base: str) -> Column:
    """``base/ident``, or the bare ``base`` when the id is empty."""
    i = col_(ident)
    return F.when(i.isNotNull() & (i != ""), F.concat(F.lit(base + "/"), i)).otherwise(F.lit(base))
