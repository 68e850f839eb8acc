"""DuckDB SQL equivalents of the registered plans (the correctness oracle).

The logic is written apart from the Spark code: RE2 patterns (no Java flags),
DuckDB string/date functions.  Helpers below only assemble SQL text.  Of the
fixed values, the seed list and the rule tables of the taggers are shared
with the library; everything else is stated here again.
"""

from __future__ import annotations

from feedloom.functions.names import DEFAULT_SEEDS
from feedloom.functions.tags import PRICING_RULES, ROLE_DEFAULT, ROLE_RULES
from feedloom.plans import inputs as I

SQL: dict[str, str] = {}

URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def norm_url(u: str) -> str:
    t = strip(u)
    g = lambda i: f"regexp_extract({t}, {q(URL_RE)}, {i})"
    return (f"(CASE WHEN {u} IS NULL OR {u} = '' THEN '' ELSE "
            f"(CASE WHEN {g(1)} <> '' THEN lower({g(1)}) || ':' ELSE '' END) || "
            f"(CASE WHEN {g(2)} <> '' THEN '//' || lower({g(2)}) ELSE '' END) || "
            f"regexp_replace(regexp_replace({g(3)}, ';[^/]*$', ''), '/+$', '') END)")


def host(u: str) -> str:
    return f"lower(regexp_extract({strip(u)}, {q(URL_RE)}, 2))"


def fp(*parts: str) -> str:
    segs = ", ".join(f"CASE WHEN {p} <> '' THEN lower({strip(p)}) END" for p in parts)
    return f"sha256(concat_ws('|', {segs}))"


def collapse(e: str) -> str:
    return strip(f"regexp_replace({e}, '\\s+', ' ', 'g')")


def iso(ts: str) -> str:
    return (f"(CASE WHEN {ts} IS NULL THEN NULL ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
            f"(CASE WHEN epoch_us({ts}) % 1000000 <> 0 THEN '.' || strftime({ts}, '%f') ELSE '' END) || '+00:00' END)")


def regex_html_text(h: str) -> str:
    t = f"regexp_replace({h}, '(?is)<script.*?>.*?</script>|<style.*?>.*?</style>', '', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    return f"(CASE WHEN {h} IS NULL OR {h} = '' THEN '' ELSE {collapse(t)} END)"


def role_family(t: str) -> str:
    low = f"lower(coalesce({t}, ''))"
    arms = " ".join("WHEN " + " OR ".join(f"contains({low}, {q(w)})" for w in ws) + f" THEN {q(fam)}"
                    for fam, ws in ROLE_RULES)
    return f"(CASE {arms} ELSE {q(ROLE_DEFAULT)} END)"


def pricing(t: str) -> str:
    arms = []
    for model, ws in PRICING_RULES:
        conds = [f"contains({t}, {q(w)})" if w == "$" else f"contains(lower({t}), {q(w)})" for w in ws]
        arms.append("WHEN " + " OR ".join(conds) + f" THEN {q(model)}")
    return f"(CASE WHEN {t} IS NULL OR {t} = '' THEN NULL ELSE (CASE {' '.join(arms)} END) END)"


def url_variant(u: str, k: str) -> str:
    head = f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
    return (f"(CASE WHEN {k} = 0 THEN {u} WHEN {k} = 1 THEN upper({head}) || substr({u}, length({head}) + 1) "
            f"ELSE {u} || (CASE WHEN contains({u}, '?') THEN '&utm_source=feed' ELSE '?utm_source=feed' END) END)")


PAGE_VARIANTS = (
    "(SELECT page_id, k AS variant, (page_id + k) % 3 AS priority, " + url_variant("url", "k") + " AS url, html "
    "FROM (SELECT *, 0 AS k FROM pages UNION ALL SELECT *, 1 FROM pages UNION ALL SELECT *, 2 FROM pages))"
)
TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
LANG = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"

SQL["page_role_summary"] = f"""
WITH v AS (SELECT *, {norm_url('url')} AS norm_url FROM {PAGE_VARIANTS}),
d AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY priority, page_id, variant) = 1),
t AS (SELECT norm_url, {regex_html_text('html')} AS text FROM d),
g AS (SELECT {host('norm_url')} AS host, {role_family('text')} AS role_family, {pricing('text')} AS pricing_model FROM t)
SELECT role_family, count(*) AS pages, count(DISTINCT pricing_model) AS pricing_models,
       count(DISTINCT host) AS hosts FROM g GROUP BY role_family
"""

SQL["url_normalize"] = f"""
SELECT page_id, {norm_url('url')} AS norm_url, {host('url')} AS host,
       substr({collapse(TITLE)}, 1, 200) AS title_snippet FROM pages
"""

SQL["record_fingerprint"] = f"SELECT page_id, {fp(norm_url('url'), TITLE, LANG)} AS fingerprint FROM pages"

SQL["url_dedup_first_wins"] = f"""
SELECT norm_url, page_id, variant, url FROM (SELECT *, {norm_url('url')} AS norm_url FROM {PAGE_VARIANTS})
QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY priority, page_id, variant) = 1
"""

SQL["product_dedup_exact_url"] = f"""
WITH u AS (SELECT 1 AS source_priority, page_id, url FROM pages
  UNION ALL SELECT 2, page_id, {url_variant('url', '1')} FROM pages
  UNION ALL SELECT 3, page_id, url FROM pages)
SELECT source_priority, page_id, url FROM u
QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_priority, page_id) = 1
"""

FRONTIER = (f"(SELECT page_id, url, html FROM {PAGE_VARIANTS} UNION ALL "
            "SELECT page_id, regexp_extract(url, '^[^?#]*', 0) || '/next', html FROM pages)")

SQL["frontier_new_only"] = f"""
SELECT norm_url, min(page_id) AS page_id FROM (SELECT page_id, {norm_url('url')} AS norm_url FROM {FRONTIER}) f
WHERE norm_url NOT IN (SELECT {norm_url('url')} FROM pages) GROUP BY norm_url
"""

SQL["ledger_new_only"] = f"""
SELECT fingerprint, min(page_id) AS page_id, 'PAGE' AS record_type
FROM (SELECT page_id, {fp(norm_url('url'), LANG)} AS fingerprint FROM {FRONTIER}) f
WHERE fingerprint NOT IN (SELECT {fp(norm_url('url'), LANG)} FROM pages) GROUP BY fingerprint
"""

SQL["freshness_filter"] = f"""
SELECT event_id, user_id, event_type, {iso('ts')} AS published FROM events
WHERE ts BETWEEN TIMESTAMP '{I.AS_OF_FRESH}' - INTERVAL 24 HOUR AND TIMESTAMP '{I.AS_OF_FRESH}' + INTERVAL 1 HOUR
"""

_ABS_SQL = [
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'", "ts"),
    ("strftime(ts, '%Y-%m-%d %H:%M:%S')", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%d')", "date_trunc('day', ts)"),
    ("strftime(ts, '%b %-d, %Y')", "date_trunc('day', ts)"),
    ("strftime(ts, '%B %-d, %Y')", "date_trunc('day', ts)"),
    ("strftime(ts, '%-d %b %Y')", "date_trunc('day', ts)"),
    ("strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M') || 'Z'", "date_trunc('minute', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M') || '+02:00'", "date_trunc('minute', ts) - INTERVAL 2 HOUR"),
    ("strftime(ts, '%Y-%m-%dT%H')", "date_trunc('hour', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '7Z'", "ts"),
    ("strftime(ts, '%a, %d %b %Y %H:%M') || ' GMT'", "date_trunc('minute', ts)"),
    ("strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' EST'", "date_trunc('second', ts) + INTERVAL 5 HOUR"),
    ("strftime(ts, '%A, %d %b %Y %H:%M:%S') || ' GMT'", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-0530'", "date_trunc('second', ts) + INTERVAL 330 MINUTE"),
]
SQL["publish_time_absolute"] = (
    f"SELECT event_id, CASE event_id % {len(_ABS_SQL)} " + " ".join(f"WHEN {i} THEN {t}" for i, (t, _) in enumerate(_ABS_SQL))
    + f" END AS date_text, CASE event_id % {len(_ABS_SQL)} "
    + " ".join(f"WHEN {i} THEN {iso(p)}" for i, (_, p) in enumerate(_ABS_SQL)) + " END AS published FROM events"
)

_A = f"TIMESTAMP '{I.AS_OF_RELATIVE}'"
_D = f"(CAST(epoch({_A}) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT))"
SQL["publish_time_relative"] = f"""
WITH r AS (SELECT event_id, event_id % 7 AS k, {_D} AS d FROM events),
p AS (SELECT event_id, k,
  CASE k WHEN 0 THEN 'Posted ' || CAST(d // 60 AS VARCHAR) || ' minutes ago'
         WHEN 1 THEN CAST(d // 3600 AS VARCHAR) || ' hours ago'
         WHEN 2 THEN CAST(d // 86400 AS VARCHAR) || ' days ago'
         WHEN 3 THEN CAST(d AS VARCHAR) || ' secs ago'
         WHEN 4 THEN CAST(d // 3600 AS VARCHAR) || ' HRS AGO'
         WHEN 5 THEN 'Yesterday'
         ELSE CAST(d // 604800 AS VARCHAR) || ' weeks ago' END AS rel_text,
  CASE k WHEN 0 THEN {_A} - to_seconds(d // 60 * 60)
         WHEN 1 THEN {_A} - to_seconds(d // 3600 * 3600)
         WHEN 2 THEN {_A} - to_seconds(d // 86400 * 86400)
         WHEN 3 THEN {_A} - to_seconds(d)
         WHEN 4 THEN {_A} - to_seconds(d // 3600 * 3600)
         WHEN 5 THEN {_A} - INTERVAL 1 DAY
         ELSE NULL END AS t FROM r)
SELECT event_id, rel_text, {iso('t')} AS published,
       coalesce(t BETWEEN {_A} - INTERVAL 24 HOUR AND {_A} + INTERVAL 1 HOUR, false) AS fresh FROM p
"""


# ---------------------------------------------------------------- names
# The company-suffix patterns, in their order.
SUFFIXES = [
    r"\binc\.?\b", r"\bllc\.?\b", r"\bcorp\.?\b", r"\bcorporation\b", r"\bltd\.?\b", r"\blimited\b", r"\bco\.?\b",
    r"\bcompany\b", r"\bgmbh\b", r"\bpbc\b", r"\btechnologies\b", r"\btech\b", r"\blabs?\b",
]


def strip_suffixes(e: str) -> str:
    for p in SUFFIXES:
        e = strip(f"regexp_replace({e}, {q(p)}, '', 'gi')")
    return e


def norm_name(e: str) -> str:
    n = strip_suffixes(strip(f"lower({e})"))
    n = f"regexp_replace({n}, '[^\\w\\s]', '', 'g')"
    return f"(CASE WHEN {e} IS NULL OR {e} = '' THEN '' ELSE {strip(f'regexp_replace({n}, {q(chr(92) + 's+')}, {q(' ')}, {q('g')})')} END)"


def heuristic(e: str) -> str:
    h = strip(f"regexp_replace({strip_suffixes(e)}, '[,.]', '', 'g')")
    return f"(CASE WHEN {h} <> '' THEN {h} ELSE {e} END)"


SEEDS_VALUES = ", ".join(f"({i}, {q(s)})" for i, s in enumerate(DEFAULT_SEEDS))
SEED_TABLE = f"""(SELECT key, arg_max(canonical, rank) AS canonical FROM (
  SELECT {norm_name('canonical')} AS key, canonical, pos * 2 AS rank FROM (VALUES {SEEDS_VALUES}) s(pos, canonical)
  UNION ALL
  SELECT replace({norm_name('canonical')}, ' ', ''), canonical, pos * 2 + 1 FROM (VALUES {SEEDS_VALUES}) s(pos, canonical)
) GROUP BY key)"""

SEED_LIST = "[" + ", ".join(q(s) for s in DEFAULT_SEEDS) + "]"


def company_name(key: str, own: str) -> str:
    base = f"(CASE WHEN {key} % 3 = 0 THEN {own} ELSE {SEED_LIST}[{key} % {len(DEFAULT_SEEDS)} + 1] END)"
    arms = []
    for i, pat in enumerate(I.NAME_VARIANTS):
        if pat == "lower":
            v = f"lower({base})"
        elif pat == "nospace":
            v = f"replace({base}, ' ', '')"
        else:
            pre, post = pat.split("{}")
            v = f"{q(pre)} || {base} || {q(post)}"
        arms.append(f"WHEN {i} THEN {v}")
    return f"(CASE ({key} // 3) % {len(I.NAME_VARIANTS)} {' '.join(arms)} END)"


COMPANY_NAMES = (f"(SELECT 1 AS src, s_suppkey AS key, {company_name('s_suppkey', 's_name')} AS raw_name FROM supplier "
                 f"UNION ALL SELECT 2, c_custkey, {company_name('c_custkey', 'c_name')} FROM customer)")


def resolved(src_rel: str) -> str:
    return f"""(SELECT n.*, {strip('n.raw_name')} AS raw_clean,
  CASE WHEN n.raw_name IS NULL OR {strip('n.raw_name')} = '' THEN 'Unknown'
       WHEN s1.canonical IS NOT NULL THEN s1.canonical WHEN s2.canonical IS NOT NULL THEN s2.canonical
       ELSE {heuristic(strip('n.raw_name'))} END AS canonical_name,
  CASE WHEN n.raw_name IS NULL OR {strip('n.raw_name')} = '' THEN NULL
       WHEN s1.canonical IS NOT NULL THEN 'exact_seed_match' WHEN s2.canonical IS NOT NULL THEN 'nospace_seed_match'
       ELSE 'normalized' END AS match_method
FROM (SELECT *, {norm_name(strip('raw_name'))} AS nk FROM {src_rel}) n
LEFT JOIN {SEED_TABLE} s1 ON n.nk = s1.key
LEFT JOIN {SEED_TABLE} s2 ON replace(n.nk, ' ', '') = s2.key)"""


SQL["resolve_names"] = f"SELECT src, key, raw_name, canonical_name, match_method FROM {resolved(COMPANY_NAMES)}"
SQL["resolution_log"] = (f"SELECT raw_clean AS raw_name, canonical_name, match_method FROM {resolved(COMPANY_NAMES)} "
                         "WHERE match_method IS NOT NULL")
SQL["resolution_rates"] = f"""
WITH l AS (SELECT match_method FROM {resolved(COMPANY_NAMES)} WHERE match_method IS NOT NULL)
SELECT match_method, count(*) AS n, CAST(count(*) * 1000000 // (SELECT count(*) FROM l) AS BIGINT) AS share_ppm
FROM l GROUP BY match_method
"""
SQL["startup_dedup_canonical"] = f"""
WITH s AS (SELECT 1 AS source_priority, key, raw_name FROM {COMPANY_NAMES} WHERE src = 1
  UNION ALL SELECT 2, key, raw_name FROM {COMPANY_NAMES} WHERE src = 2
  UNION ALL SELECT 3, key, raw_name FROM {COMPANY_NAMES} WHERE src = 1)
SELECT lower(canonical_name) AS entity_key, source_priority, key, canonical_name FROM {resolved('s')}
QUALIFY row_number() OVER (PARTITION BY lower(canonical_name) ORDER BY source_priority, key) = 1
"""

# ---------------------------------------------------------------- tags / extract
SQL["role_family"] = f"SELECT doc_id, {role_family('text')} AS role_family FROM documents"
SQL["pricing_model"] = f"SELECT doc_id, {pricing('text')} AS pricing_model FROM documents"


def split_part_n(e: str, pat: str, idx: int) -> str:
    return f"regexp_split_to_array({e}, {q(pat)})[{idx}]"


_JOB_SPLIT = r"(?i)\s+at\s+|\s+-\s+|\s+:\s+"
_PROD_SPLIT = r"(?i)\s+by\s+|\s+-\s+"
SQL["title_company_split"] = f"""
WITH b AS (SELECT p_partkey,
  upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS pn,
  [' at ', ' - ', ' : ', ' AT '][p_partkey % 4 + 1] AS sep, coalesce(n_name, '') AS nn,
  CASE WHEN p_partkey % 2 = 0 THEN p_name || ' by ' || p_brand ELSE p_name || ' - ' || p_type END AS product_title,
  replace(p_brand, '#', '') || '/' || replace(p_name, ' ', '-') AS model_id
  FROM part LEFT JOIN nation ON CAST(p_partkey % 25 AS INTEGER) = n_nationkey),
t AS (SELECT *, pn || sep || nn AS job_title FROM b)
SELECT p_partkey, job_title,
  CASE WHEN len(regexp_split_to_array(job_title, {q(_JOB_SPLIT)})) > 1
       THEN {strip(split_part_n('job_title', _JOB_SPLIT, 2))} ELSE 'AI Tech Company' END AS company,
  product_title,
  CASE WHEN len(regexp_split_to_array(product_title, {q(_PROD_SPLIT)})) > 1
       THEN {strip(split_part_n('product_title', _PROD_SPLIT, 2))}
       ELSE {strip(split_part_n('product_title', _PROD_SPLIT, 1))} END AS vendor,
  split_part(model_id, '/', 1) AS model_owner
FROM t
"""

LINKED_DOCS = """(SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN text ELSE text || ' Code: ' ||
  'https://github.com/' || (CASE WHEN doc_id % 4 = 0 THEN 'topics' ELSE 'org' || lang END) || '/r' || CAST(doc_id AS VARCHAR)
  || ['.', ')', '.git'][doc_id % 3 + 1] || ' mirror ' || 'https://github.com/org' || lang || '/m' || CAST(doc_id AS VARCHAR) || '.'
  END AS text FROM documents)"""
_LINK_RE = r"https?://github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)"
_DENY = "('topics', 'sponsors', 'features', 'pricing', 'about', 'blog')"
REPO_LINK = f"""(list_filter(regexp_extract_all(text, {q(_LINK_RE)}, 0),
  lambda m: lower(regexp_extract(m, {q(_LINK_RE)}, 1)) NOT IN {_DENY})[1])"""


def repo_link_sql() -> str:
    m = "first_match"
    return (f"CASE WHEN {m} IS NULL THEN NULL ELSE 'https://github.com/' || regexp_extract({m}, {q(_LINK_RE)}, 1) || '/' || "
            f"regexp_replace(regexp_extract({m}, {q(_LINK_RE)}, 2), '[.,;:)>\\]]+$', '') END")


SQL["repo_link_extract"] = f"SELECT doc_id, {repo_link_sql()} AS github_url FROM (SELECT doc_id, {REPO_LINK} AS first_match FROM {LINKED_DOCS})"

_KEY_RE = r"github\.com/([^/#?]+)/([^/#?]+)"
SQL["star_join"] = f"""
WITH p AS (SELECT doc_id, {repo_link_sql()} AS github_url FROM (SELECT doc_id, {REPO_LINK} AS first_match FROM {LINKED_DOCS})),
k AS (SELECT *, regexp_replace(regexp_replace({strip('github_url')}, '/+$', ''), '\\.git$', '') AS c FROM p),
kk AS (SELECT doc_id, github_url,
  CASE WHEN contains(github_url, 'github.com') AND regexp_matches(c, {q(_KEY_RE)})
        AND lower(regexp_extract(c, {q(_KEY_RE)}, 1)) NOT IN {_DENY}
       THEN regexp_extract(c, {q(_KEY_RE)}, 1) END AS owner,
  CASE WHEN contains(github_url, 'github.com') AND regexp_matches(c, {q(_KEY_RE)})
        AND lower(regexp_extract(c, {q(_KEY_RE)}, 1)) NOT IN {_DENY}
       THEN regexp_extract(c, {q(_KEY_RE)}, 2) END AS repo FROM k),
s AS (SELECT owner, repo, max(stars) AS stars FROM (SELECT 'org' || d.lang AS owner, 'r' || CAST(l.doc_id AS VARCHAR) AS repo,
  CAST(l.quality * 1000 + l.toxic * 10 + l.doc_id % 10 AS BIGINT) AS stars FROM labels l JOIN documents d USING (doc_id))
  GROUP BY owner, repo)
SELECT kk.doc_id, kk.github_url, CASE WHEN kk.github_url IS NOT NULL THEN s.stars END AS github_stars
FROM kk LEFT JOIN s ON kk.owner = s.owner AND kk.repo = s.repo
"""

_EMP_RE = r"(?i)(\d+)\s*-\s*(\d+)\s+employees?"
SQL["employee_range"] = f"""
WITH c AS (SELECT c_custkey, c_mktsegment,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE c_name || ' | ' || CAST(c_custkey % 50 + 1 AS VARCHAR) || ' - '
    || CAST((c_custkey % 50 + 1) * (c_custkey % 9 + 2) AS VARCHAR)
    || CASE WHEN c_mktsegment = 'BUILDING' THEN ' Employees' ELSE ' employees' END END AS card,
  CASE WHEN c_custkey % 2 = 0 THEN '/companies/' || lower(replace(c_name, '#', '-'))
       ELSE 'https://www.ycombinator.com/companies/' || CAST(c_custkey AS VARCHAR) END AS href,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE lower(c_mktsegment) END AS ident FROM customer)
SELECT c_custkey,
  CASE WHEN regexp_matches(card, {q(_EMP_RE)}) THEN TRY_CAST(regexp_extract(card, {q(_EMP_RE)}, 2) AS BIGINT) END AS employee_count,
  CASE WHEN starts_with(href, '/') THEN 'https://www.ycombinator.com' || href ELSE href END AS full_url,
  CASE WHEN ident <> '' THEN 'https://huggingface.co/' || ident ELSE 'https://huggingface.co' END AS profile_url
FROM c
"""


# ---------------------------------------------------------------- feeds
def first_line(t: str) -> str:
    return f"split_part({t}, chr(10), 1)"


PAPER_ID = "substr(sha256(text), 1, 10) || 'v' || CAST(doc_id % 2 + 1 AS VARCHAR)"
PUB_TS = "(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 28 AS INTEGER)) + to_hours(doc_id % 24))"
SNAPSHOT = """(SELECT owner, repo, max(stars) AS stars FROM (SELECT 'org' || d.lang AS owner, 'r' || CAST(l.doc_id AS VARCHAR) AS repo,
  CAST(l.quality * 1000 + l.toxic * 10 + l.doc_id % 10 AS BIGINT) AS stars FROM labels l JOIN documents d USING (doc_id))
  GROUP BY owner, repo)"""


def paper_rows() -> str:
    search = "text || ' ' || CASE WHEN doc_id % 3 = 0 THEN 'Code: https://github.com/org' || lang || '/r' || CAST(doc_id AS VARCHAR) ELSE '' END"
    authors = ("'Author ' || CAST(doc_id % 5 AS VARCHAR) || CASE WHEN doc_id % 2 = 0 THEN ', Author ' || "
               "CAST(doc_id % 3 + 5 AS VARCHAR) ELSE '' END")
    title = f"CASE WHEN {strip(first_line('text'))} = '' THEN 'Untitled' ELSE {collapse(first_line('text'))} END"
    return f"""(SELECT doc_id // {I.FEED_SIZE} AS feed_id, doc_id AS pos, 'https://arxiv.org/abs/' || {PAPER_ID} AS paper_url,
  {title} AS title, {authors} AS authors, {PUB_TS} AS pub,
  (list_filter(regexp_extract_all({search}, {q(_LINK_RE)}, 0),
     lambda m: lower(regexp_extract(m, {q(_LINK_RE)}, 1)) NOT IN {_DENY})[1]) AS first_match FROM documents)"""


def papers(limit: int | None) -> str:
    """Paper records: per feed the newest first and each paper once; with a
    limit, of the first 2 * limit entries that many."""
    over = f"WHERE rk <= {2 * limit}" if limit else ""
    top = f"QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY rk) <= {limit}" if limit else ""
    return f"""(WITH e AS (SELECT *, {repo_link_sql()} AS github_url FROM {paper_rows()}),
r AS (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY pub DESC, paper_url, pos) AS rk FROM e),
o AS (SELECT * FROM r {over}),
dd AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY feed_id, paper_url ORDER BY rk) = 1),
f AS (SELECT * FROM dd {top}),
k AS (SELECT *, regexp_replace(regexp_replace({strip('github_url')}, '/+$', ''), '\\.git$', '') AS c FROM f)
SELECT k.feed_id, k.paper_url, k.title, k.authors, {iso('k.pub')} AS published_date, k.github_url,
  CASE WHEN k.github_url IS NOT NULL THEN s.stars END AS github_stars
FROM k LEFT JOIN {SNAPSHOT} s ON regexp_extract(k.c, {q(_KEY_RE)}, 1) = s.owner AND regexp_extract(k.c, {q(_KEY_RE)}, 2) = s.repo)"""

PAPERS = papers(None)
SQL["paper_feed_parse"] = f"SELECT * FROM {papers(3)}"
SQL["paper_run_summary"] = f"""SELECT count(*) AS total_collected, count(DISTINCT paper_url) AS unique_papers,
  count(*) FILTER (WHERE github_url IS NOT NULL) AS with_github, count(*) FILTER (WHERE github_url IS NULL) AS without_github
FROM {PAPERS}"""

_JOB_ROLES = "[" + ", ".join(q(r) for r in I.JOB_ROLES) + "]"
_FRESH_A = f"TIMESTAMP '{I.AS_OF_FRESH}'"


def _doc_company() -> str:
    own = "upper(substr(source, 1, 1)) || lower(substr(source, 2)) || ' Group'"
    return company_name("doc_id", own)


JOB_ROWS = f"""(SELECT doc_id // {I.FEED_SIZE} AS feed_id, doc_id % {I.FEED_SIZE} AS pos,
  {_JOB_ROLES}[doc_id % {len(I.JOB_ROLES)} + 1] || [' at ', ' - ', ' : ', ' | '][doc_id % 4 + 1] || {_doc_company()} AS title,
  CASE WHEN doc_id % 5 = 0 THEN 'https://jobs.example.org/feed/' || CAST(doc_id // {I.FEED_SIZE} AS VARCHAR)
       ELSE 'https://jobs.example.org/' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '?a=1&b=2' END END AS url,
  {_FRESH_A} - to_hours(CAST(doc_id % 40 AS BIGINT)) AS t FROM documents)"""

SQL["rss_jobs"] = f"""
WITH j AS (SELECT *, CASE WHEN len(regexp_split_to_array(title, {q(_JOB_SPLIT)})) > 1
    THEN {strip(split_part_n('title', _JOB_SPLIT, 2))} ELSE 'AI Tech Company' END AS raw_name
  FROM {JOB_ROWS} WHERE t BETWEEN {_FRESH_A} - INTERVAL 24 HOUR AND {_FRESH_A} + INTERVAL 1 HOUR)
SELECT feed_id, pos, canonical_name AS company, {iso('t')} AS date, true AS is_remote, {role_family('title')} AS role_family, url
FROM {resolved('j')}
"""

_NEWS_TITLE = "(CASE doc_id % 6 WHEN 4 THEN 'Café' || chr(160) WHEN 1 THEN '1 < 2 ' WHEN 5 THEN 'R&D <item> ' ELSE '' END || " + first_line("text") + ")"
SQL["rss_news"] = f"""
SELECT feed_id, pos, title, url, {iso('t')} AS publication_date, full_text FROM (
  SELECT doc_id // {I.FEED_SIZE} AS feed_id, doc_id % {I.FEED_SIZE} AS pos, {strip(_NEWS_TITLE)} AS title,
    CASE WHEN doc_id % 7 = 0 THEN 'https://news.example.org/feed/' || CAST(doc_id // {I.FEED_SIZE} AS VARCHAR)
         ELSE 'https://news.example.org/a/' || CAST(doc_id AS VARCHAR) END AS url,
    {_FRESH_A} - to_hours(CAST(doc_id % 40 AS BIGINT)) AS t,
    substr({strip("replace(text, '&', 'and')")}, 1, 2000) AS full_text FROM documents)
WHERE t BETWEEN {_FRESH_A} - INTERVAL 24 HOUR AND {_FRESH_A} + INTERVAL 1 HOUR
"""


_FEEDS = f"(SELECT DISTINCT doc_id // {I.FEED_SIZE} AS feed_id FROM documents)"
SQL["feed_rejects"] = f"""SELECT feed_id, CAST(CASE feed_id % 5 WHEN 3 THEN 0 END AS BIGINT) AS pos,
  CASE feed_id % 5 WHEN 1 THEN 'empty_document' WHEN 2 THEN 'no_items' WHEN 3 THEN 'unreadable_item' ELSE 'empty_document' END AS reason
FROM {_FEEDS} WHERE feed_id % 5 <> 0"""
SQL["paper_rejects"] = SQL["feed_rejects"]
SQL["json_rejects"] = f"""SELECT feed_id, CAST(CASE feed_id % 5 WHEN 3 THEN 0 END AS BIGINT) AS pos,
  CASE feed_id % 5 WHEN 1 THEN 'empty_document' WHEN 2 THEN 'no_items' WHEN 3 THEN 'unreadable_item' ELSE 'unreadable_document' END AS reason
FROM (SELECT DISTINCT s_suppkey // {I.FEED_SIZE} AS feed_id FROM supplier) WHERE feed_id % 5 <> 0"""
SQL["json_rejects_kept"] = f"""SELECT s_suppkey // {I.FEED_SIZE} AS feed_id, count(*) AS entries FROM supplier
WHERE s_suppkey // {I.FEED_SIZE} % 5 IN (0, 3) GROUP BY 1"""
SQL["feed_reject_counts"] = f"""SELECT reason, count(*) AS n FROM (SELECT reason FROM ({SQL['feed_rejects']})
  UNION ALL SELECT 'kept' FROM documents WHERE doc_id // {I.FEED_SIZE} % 5 IN (0, 3)) GROUP BY reason"""


# ---------------------------------------------------------------- JSON / paged / cards
def first_non_empty(*es: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({e}, '')" for e in es) + ")"


def _name(key: str, own: str) -> str:
    return company_name(key, own)


ORG_SRC = f"""(SELECT feed_id, pos, org_id, raw_name,
    CASE WHEN org_id IS NOT NULL AND org_id <> '' THEN 'https://huggingface.co/' || org_id ELSE 'https://huggingface.co' END AS url
  FROM (SELECT s_suppkey // {I.FEED_SIZE} AS feed_id, s_suppkey % {I.FEED_SIZE} AS pos, id AS org_id,
          {first_non_empty('fullname', 'name', 'id')} AS raw_name
        FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE lower(replace(s_name, '#', '-')) END AS id,
                {_name('s_suppkey', 's_name')} AS name,
                CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {_name('s_suppkey', 's_name')} || ' Inc.' END AS fullname
              FROM supplier))
  WHERE raw_name IS NOT NULL)"""
SQL["json_orgs"] = f"SELECT feed_id, pos, raw_name, canonical_name AS entity_name, url FROM {resolved(ORG_SRC)}"

MODEL_SRC = f"""(SELECT feed_id, pos, model_id, split_part(model_id, '/', 1) AS raw_name, 'https://huggingface.co/' || model_id AS url
  FROM (SELECT p_partkey // {I.FEED_SIZE} AS feed_id, p_partkey % {I.FEED_SIZE} AS pos,
          CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 10 = 0 THEN replace(p_name, ' ', '-')
               ELSE replace(p_brand, '#', '') || '/' || replace(p_name, ' ', '-') END AS model_id FROM part)
  WHERE model_id <> '' AND contains(model_id, '/'))"""
SQL["json_models"] = f"SELECT feed_id, pos, url, canonical_name AS startup_name, 'FREE' AS pricing_model FROM {resolved(MODEL_SRC)}"

_ORD_T = f"({_FRESH_A} - to_hours(CAST(o_orderkey % 40 AS BIGINT)))"
JSON_JOBS = f"""(SELECT o_orderkey // {I.FEED_SIZE} AS feed_id, o_orderkey % {I.FEED_SIZE} AS pos,
    {_JOB_ROLES}[o_orderkey % {len(I.JOB_ROLES)} + 1] || [' at ', ' - ', ' : ', ' | '][o_orderkey % 4 + 1] || o_orderpriority AS title,
    CASE WHEN o_orderkey % 9 = 0 THEN 'AI Company' ELSE {_name('o_orderkey', "'Client ' || CAST(o_custkey AS VARCHAR)")} END AS raw_name,
    CASE WHEN o_orderkey % 7 = 0 THEN 'https://remote.example.org/api/jobs'
         ELSE 'https://remote.example.org/job/' || CAST(o_orderkey AS VARCHAR) END AS url,
    {_ORD_T} AS t FROM orders)"""
SQL["json_jobs"] = f"""
SELECT feed_id, pos, canonical_name AS company, {iso('t')} AS date, true AS is_remote, {role_family('title')} AS role_family, url
FROM {resolved(f"(SELECT * FROM {JSON_JOBS} WHERE t BETWEEN {_FRESH_A} - INTERVAL 24 HOUR AND {_FRESH_A} + INTERVAL 1 HOUR)")}
"""

_PQ = I.PAGE_ITEMS * I.PAGES_PER_QUERY


def paged(key: str, table: str, cols: str) -> str:
    """Items of pages before each query's first bad page."""
    return f"""(WITH it AS (SELECT {key} // {_PQ} AS query_id, ({key} % {_PQ}) // {I.PAGE_ITEMS} + 1 AS page,
      {key} % {I.PAGE_ITEMS} AS pos, {cols} FROM {table}),
    pg AS (SELECT DISTINCT query_id, page,
      ((query_id % 3 = 0 AND page = query_id % 5 + 10) OR (query_id % 3 = 1 AND page = 12)) AS bad FROM it),
    fb AS (SELECT query_id, min(page) FILTER (WHERE bad) AS first_bad FROM pg GROUP BY query_id)
    SELECT it.* FROM it JOIN fb USING (query_id) WHERE fb.first_bad IS NULL OR it.page < fb.first_bad)"""


ORG_PAGED = f"""(SELECT query_id, page, pos, login AS raw_name, coalesce(html_url, 'https://github.com/' || login) AS url
  FROM {paged('c_custkey', 'customer', "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'org-' || lower(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) END AS login, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'https://github.com/' || (CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'org-' || lower(c_mktsegment) || '-' || CAST(c_custkey AS VARCHAR) END) END AS html_url")}
  WHERE login <> '')"""
SQL["paged_orgs"] = f"SELECT query_id, page, pos, canonical_name AS entity_name, url FROM {resolved(ORG_PAGED)}"

_DESCS = "['Open-source toolkit', 'Freemium plan', 'Enterprise ready', 'Paid $9', 'Limited preview', 'A tool']"
REPO_PAGED = f"""(SELECT query_id, page, pos, url, owner AS raw_name, description
  FROM {paged('p_partkey', 'part', "'team-' || replace(p_brand, 'Brand#', '') AS owner, CASE WHEN p_partkey % 17 = 0 THEN '' ELSE 'https://github.com/team-' || replace(p_brand, 'Brand#', '') || '/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS VARCHAR) END AS url, " + _DESCS + "[p_partkey % 6 + 1] || ' for ' || p_type AS description")}
  WHERE url <> '')"""
SQL["paged_repos"] = f"SELECT query_id, page, pos, url, canonical_name AS startup_name, {pricing('description')} AS pricing_model FROM {resolved(REPO_PAGED)}"

CARDS = f"""(SELECT c_custkey // {I.CARD_PAGE} AS page_id, c_custkey % {I.CARD_PAGE} AS card_pos,
    {strip(_name('c_custkey', 'c_name') + f" || CASE WHEN c_custkey % 3 = 0 AND c_custkey // {I.CARD_PAGE} % 2 = 0 THEN ' Group' ELSE '' END")} AS raw_name,
    (c_custkey % 50 + 1) * (c_custkey % 9 + 2) AS employee_count,
    'https://www.ycombinator.com/companies/' || lower(replace(c_name, '#', '-')) AS url FROM customer)"""
SQL["html_cards"] = f"SELECT page_id, card_pos, raw_name, canonical_name AS entity_name, employee_count, url FROM {resolved(CARDS)}"

_PDESC = "['Free trial available', 'Custom pricing', 'MIT licensed', 'Subscription', 'New launch']"
_VENDOR = _name('p_partkey', "'Maker ' || p_brand")
PRODUCT_RSS = f"""(SELECT feed_id, pos, url,
    CASE WHEN len(regexp_split_to_array(title, {q(_PROD_SPLIT)})) > 1 THEN {strip(split_part_n('title', _PROD_SPLIT, 2))}
         ELSE {strip(split_part_n('title', _PROD_SPLIT, 1))} END AS raw_name, {pricing('description')} AS pricing_model
  FROM (SELECT p_partkey // {I.FEED_SIZE} AS feed_id, p_partkey % {I.FEED_SIZE} AS pos,
          CASE WHEN p_partkey % 8 = 0 THEN '' ELSE 'https://products.example.org/p/' || CAST(p_partkey // 2 AS VARCHAR) END AS url,
          CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' by ' || {_VENDOR} ELSE p_name || ' - ' || {_VENDOR} END AS title,
          {_PDESC}[p_partkey % 5 + 1] AS description FROM part) WHERE url <> '')"""
SQL["rss_products"] = f"SELECT feed_id, pos, url, canonical_name AS startup_name, pricing_model FROM {resolved(PRODUCT_RSS)}"

STARTUP_CANDS = f"""(SELECT 1 AS source_priority, feed_id AS page, pos, raw_name, CAST(NULL AS BIGINT) AS employee_count, url,
    'Hugging Face Organizations' AS source_name FROM {ORG_SRC}
  UNION ALL SELECT 2, query_id * 100 + page, pos, raw_name, NULL, url, 'GitHub AI Organizations' FROM {ORG_PAGED}
  UNION ALL SELECT 3, page_id, card_pos, raw_name, employee_count, url, 'Y Combinator Directory' FROM {CARDS})"""
SQL["startup_records"] = f"""
SELECT canonical_name AS entity_name, employee_count, source_name, url, source_priority, page, pos
FROM {resolved(STARTUP_CANDS)}
QUALIFY row_number() OVER (PARTITION BY lower(canonical_name) ORDER BY source_priority, page, pos) = 1
"""

PRODUCT_CANDS = f"""(SELECT 1 AS source_priority, feed_id AS page, pos, url, raw_name, 'FREE' AS pricing_model,
    'Hugging Face Models' AS source_name FROM {MODEL_SRC}
  UNION ALL SELECT 2, query_id * 100 + page, pos, url, raw_name, {pricing('description')}, 'GitHub AI Products' FROM {REPO_PAGED}
  UNION ALL SELECT 3, feed_id, pos, url, raw_name, pricing_model, 'Product Hunt AI' FROM {PRODUCT_RSS})"""
SQL["product_records"] = f"""
SELECT canonical_name AS startup_name, pricing_model, source_name, url, source_priority, page, pos
FROM {resolved(f"(SELECT * FROM {PRODUCT_CANDS} QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_priority, page, pos) = 1)")}
"""


# ---------------------------------------------------------------- HTML text / chunks
SQL["html_regex_text"] = f"SELECT page_id, {regex_html_text('html')} AS text FROM pages"

M = 4000


def chunks_sql(doc_rel: str) -> str:
    """Greedy packing as a recursive CTE over numbered paragraphs."""
    nl2 = "chr(10) || chr(10)"
    return f"""(WITH RECURSIVE d AS (SELECT doc_id, text AS t FROM {doc_rel}),
whole AS (SELECT doc_id, 0 AS g, 0 AS s, t AS chunk FROM d WHERE t IS NOT NULL AND t <> '' AND length(t) <= {M}),
raw AS (SELECT doc_id, unnest(string_split(t, {nl2})) AS para, generate_subscripts(string_split(t, {nl2}), 1) AS ord
        FROM d WHERE length(t) > {M}),
p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS i, para, length(para) AS L
      FROM (SELECT doc_id, ord, {strip('para')} AS para FROM raw) WHERE para <> ''),
r AS (SELECT doc_id, i, CASE WHEN L + 2 <= {M} THEN L + 2 WHEN L > {M} THEN 0 ELSE L END AS n, 1 AS g,
             L > {M} AND NOT (L + 2 <= {M}) AS big FROM p WHERE i = 1
      UNION ALL
      SELECT p.doc_id, p.i,
        CASE WHEN r.n + p.L + 2 <= {M} THEN r.n + p.L + 2 WHEN p.L > {M} THEN 0 ELSE p.L END,
        CASE WHEN r.n + p.L + 2 <= {M} AND r.n > 0 THEN r.g ELSE r.g + 1 END,
        NOT (r.n + p.L + 2 <= {M}) AND p.L > {M}
      FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i + 1),
pg AS (SELECT p.doc_id, p.i, p.para, p.L, r.g, r.big FROM p JOIN r USING (doc_id, i)),
packed AS (SELECT doc_id, g, 0 AS s, string_agg(para, {nl2} ORDER BY i) AS chunk FROM pg WHERE NOT big GROUP BY doc_id, g),
sliced AS (SELECT doc_id, g, s, substr(para, s * {M} + 1, {M}) AS chunk
           FROM (SELECT doc_id, g, para, unnest(range(0, CAST(ceil(L / {M}) AS BIGINT))) AS s FROM pg WHERE big)),
allc AS (SELECT * FROM whole UNION ALL SELECT * FROM packed UNION ALL SELECT * FROM sliced)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g, s) - 1 AS chunk_idx, chunk, length(chunk) AS chunk_len FROM allc)"""


SQL["chunk_documents"] = f"SELECT doc_id, CAST(chunk_idx AS BIGINT) AS chunk_idx, chunk, CAST(chunk_len AS BIGINT) AS chunk_len FROM {chunks_sql('documents')}"
PARA_DOCS = "(SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents)"
SQL["chunk_packing"] = f"SELECT doc_id, CAST(chunk_idx AS BIGINT) AS chunk_idx, chunk, CAST(chunk_len AS BIGINT) AS chunk_len FROM {chunks_sql(PARA_DOCS)}"
SQL["chunk_stats"] = f"""
SELECT d.doc_id, coalesce(c.n, 0) AS n_chunks, CAST(length(d.text) AS BIGINT) AS text_len, c.first_chunk
FROM {PARA_DOCS} d LEFT JOIN (SELECT doc_id, count(*) AS n, arg_min(chunk, chunk_idx) AS first_chunk
  FROM {chunks_sql(PARA_DOCS)} GROUP BY doc_id) c USING (doc_id)
"""

# ---------------------------------------------------------------- responses
_PM = "CASE o_orderpriority " + " ".join(f"WHEN {q(p)} THEN {q(v)}" for p, v in I.PRIORITY_TO_PRICING) + " ELSE 'null' END"
_NAME = "'Client ' || CAST(o_custkey AS VARCHAR)"
RESPONSES = f"""(SELECT o_orderkey AS doc_id, 1 AS tier, 'primary' AS provider,
    '```json' || chr(10) || '{{"startupName": "' || {_NAME} || '", "pricingModel": ' || {_PM} || '}}' || chr(10) || '```' AS raw,
    CASE WHEN o_orderstatus = 'F' THEN '429 Too Many Requests' END AS error FROM orders
  UNION ALL SELECT o_orderkey, 2, 'secondary',
    CASE o_orderkey % 4 WHEN 0 THEN '{{"startupName": "' || {_NAME}
      WHEN 1 THEN '{{"startupName": ' || CAST(o_custkey AS VARCHAR) || '}}'
      WHEN 2 THEN '```' || chr(10) || '{{"startupName": "' || {_NAME} || '", "pricingModel": "FREE"}}```'
      ELSE '{{"pricingModel": "PAID"}}' END,
    CASE WHEN o_orderkey % 10 = 0 THEN 'Quota exceeded for project' END FROM orders
  UNION ALL SELECT o_orderkey, 3, 'tertiary', '{{"startupName": "' || {_NAME} || '", "pricingModel": "FREE", "extra": 1}}',
    CASE WHEN o_orderstatus = 'O' THEN 'upstream connect error 503' END FROM orders)"""


def fence_strip(t: str) -> str:
    s = strip(t)
    inner = f"regexp_replace(regexp_replace({s}, '^```[a-zA-Z]*\\n?', ''), '\\n?```$', '')"
    return strip(f"(CASE WHEN starts_with({s}, '```') THEN {inner} ELSE {s} END)")


_DOM = "('FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE')"
VALIDATED = f"""(WITH a AS (SELECT *, CASE WHEN error IS NULL THEN {fence_strip('raw')} END AS clean FROM {RESPONSES}),
b AS (SELECT *, clean IS NOT NULL AND json_valid(clean) AS parsed FROM a),
c AS (SELECT *, CASE WHEN parsed THEN json_type(clean) END AS jt,
   CASE WHEN parsed THEN json_type(clean, '$.startupName') END AS t1,
   CASE WHEN parsed THEN json_type(clean, '$.pricingModel') END AS t2,
   CASE WHEN parsed THEN json_extract_string(clean, '$.pricingModel') END AS v2 FROM b),
d AS (SELECT *, CASE WHEN parsed THEN list_filter([
    CASE WHEN jt <> 'OBJECT' THEN 'not_object' END,
    CASE WHEN t1 IS NULL THEN 'missing:startupName' WHEN t1 = 'NULL' THEN 'null:startupName'
         WHEN t1 <> 'VARCHAR' THEN 'type:startupName' END,
    CASE WHEN t2 IS NULL OR t2 = 'NULL' THEN NULL WHEN t2 <> 'VARCHAR' OR v2 NOT IN {_DOM} THEN 'type:pricingModel' END],
    lambda x: x IS NOT NULL) END AS viol FROM c)
SELECT doc_id, tier, provider,
  CASE WHEN error IS NOT NULL THEN 'provider_error' WHEN NOT parsed THEN 'malformed_json'
       WHEN len(viol) > 0 THEN 'schema_invalid' ELSE 'ok' END AS outcome,
  array_to_string(viol, ',') AS violations,
  coalesce(contains(error, '429') OR contains(lower(error), 'rate limit') OR contains(lower(error), 'quota'), false) AS rate_limited,
  CASE WHEN error IS NULL AND parsed AND len(viol) = 0 THEN json_extract_string(clean, '$.startupName') END AS startupName,
  CASE WHEN error IS NULL AND parsed AND len(viol) = 0 THEN v2 END AS pricingModel
FROM d)"""

SQL["validate_split"] = f"SELECT * FROM {VALIDATED}"
SQL["validated_records"] = f"SELECT doc_id, tier, startupName, pricingModel FROM {VALIDATED} WHERE outcome = 'ok'"
SQL["first_valid_by_tier"] = f"""
SELECT o.o_orderkey AS doc_id, b.tier, b.provider, b.startupName, b.pricingModel FROM orders o
LEFT JOIN (SELECT * FROM {VALIDATED} WHERE outcome = 'ok' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY tier) = 1) b
ON o.o_orderkey = b.doc_id
"""
SQL["attempt_outcomes"] = f"""SELECT provider, outcome, count(*) AS attempts, count(*) FILTER (WHERE rate_limited) AS rate_limited
FROM {VALIDATED} GROUP BY provider, outcome"""

SQL["failover_rate"] = f"""WITH t AS (SELECT doc_id, min(tier) AS f, min(tier) FILTER (WHERE outcome = 'ok') AS g FROM {VALIDATED} GROUP BY doc_id)
SELECT count(*) AS documents, count(*) FILTER (WHERE g = f) AS first_tier, count(*) FILTER (WHERE g > f) AS failed_over,
  count(*) FILTER (WHERE g IS NULL) AS unanswered, CAST(count(*) FILTER (WHERE g > f) * 1000000 // count(*) AS BIGINT) AS failover_ppm FROM t"""


def typed(table: str, key: str, violations: list[str], values: dict[str, str]) -> str:
    """Records whose fields take each form in turn: the rules' verdict on
    each form is written out by the row's number ``k``."""
    viol = "list_filter([" + ", ".join(violations) + "], lambda x: x IS NOT NULL)"
    cols = ", ".join(f"CASE WHEN len(v) = 0 THEN {e} END AS {n}" for n, e in values.items())
    return f"""SELECT k AS doc_id, CASE WHEN len(v) > 0 THEN 'schema_invalid' ELSE 'ok' END AS outcome,
  array_to_string(v, ',') AS violations, {cols} FROM (SELECT *, {viol} AS v FROM (SELECT *, CAST({key} AS BIGINT) AS k FROM {table}))"""


SQL["validate_startup"] = typed("supplier", "s_suppkey", [
    "CASE WHEN k % 7 = 3 THEN 'missing:entityName' END", "CASE WHEN k % 10 IN (3, 8) THEN 'type:employeeCount' END"],
    {"entityName": "s_name", "employeeCount": "CAST([12, 12, 12, NULL, 1, NULL, 9007199254740993, NULL, NULL, -3][k % 10 + 1] AS BIGINT)"})
SQL["validate_research_paper"] = typed("part", "p_partkey", [
    "CASE k % 6 WHEN 3 THEN 'type:authors' WHEN 4 THEN 'null:authors' WHEN 5 THEN 'type:authors' END",
    "CASE WHEN k % 11 = 0 THEN 'missing:published_date' END"],
    {"authors": "CASE WHEN k % 6 = 0 THEN 'A|B' ELSE '' END", "github_stars": "CAST([5, 5, NULL, 5, 0][k % 5 + 1] AS BIGINT)",
     "published_date": "'2024-01-01'"})
SQL["validate_job"] = typed("orders", "o_orderkey", [
    "CASE k % 9 WHEN 4 THEN 'type:is_remote' WHEN 6 THEN 'null:is_remote' WHEN 7 THEN 'type:is_remote' END"],
    {"is_remote": "k % 9 NOT IN (2, 8)", "role_family": "CASE WHEN k % 2 = 0 THEN 'Design' ELSE 'Engineering' END"})
SQL["validate_news"] = typed("customer", "c_custkey", [
    "CASE k % 5 WHEN 1 THEN 'null:full_text' WHEN 2 THEN 'type:full_text' WHEN 3 THEN 'missing:full_text' END"],
    {"full_text": "CASE WHEN k % 5 = 0 THEN 't' ELSE '' END"})

SQL["redact_props"] = """
SELECT event_id, array_to_string(list_sort([
  'Authorization=***REDACTED***', 'api_key=***REDACTED***', 'session_token=***REDACTED***',
  'page=' || event_type, 'k=' || json_extract_string(props, '$.k')]), ';') AS props_redacted FROM events
"""


# ---------------------------------------------------------------- limit / tabs / edges / fallback
STARTUP_RECORDS = f"""(SELECT canonical_name AS entity_name, employee_count, source_name, url, source_priority, page, pos
FROM {resolved(STARTUP_CANDS)}
QUALIFY row_number() OVER (PARTITION BY lower(canonical_name) ORDER BY source_priority, page, pos) = 1)"""
SQL["priority_fill_limit"] = f"""SELECT entity_name, url, source_priority, page, pos FROM {STARTUP_RECORDS}
ORDER BY source_priority, page, pos LIMIT 1000"""

PRODUCT_RECORDS = f"""(SELECT canonical_name AS startup_name, pricing_model, source_name, url, source_priority, page, pos
FROM {resolved(f"(SELECT * FROM {PRODUCT_CANDS} QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_priority, page, pos) = 1)")})"""
SQL["priority_fill_first_source"] = SQL["priority_fill_limit"].replace("LIMIT 1000", "LIMIT 5")
SQL["resolution_log_cut"] = f"""WITH r AS (SELECT * FROM {resolved(STARTUP_CANDS)}),
f AS (SELECT source_priority AS sp, page AS pg, pos AS ps, row_number() OVER (ORDER BY source_priority, page, pos) AS i FROM (
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY lower(canonical_name) ORDER BY source_priority, page, pos) = 1)),
c AS (SELECT sp, pg, ps FROM f WHERE i = 40)
SELECT raw_clean AS raw_name, canonical_name, match_method FROM r WHERE match_method IS NOT NULL AND (
  NOT EXISTS (SELECT * FROM c) OR EXISTS (SELECT * FROM c WHERE source_priority < sp OR (source_priority = sp AND (page < pg OR (page = pg AND pos <= ps)))))"""
_COLL = "'2024-01-15T12:00:00+00:00'"


def txt(e: str) -> str:
    return f"coalesce(CAST({e} AS VARCHAR), '')"


SQL["tab_startups"] = f"""SELECT entity_name AS "Entity Name", {txt('employee_count')} AS "Employee Count",
  source_name AS "Source Name", url AS "Source URL", {_COLL} AS "Collected At" FROM {STARTUP_RECORDS}"""
SQL["tab_products"] = f"""SELECT startup_name AS "Startup Name", {txt('pricing_model')} AS "Pricing Model",
  source_name AS "Source Name", url AS "Source URL", {_COLL} AS "Collected At" FROM {PRODUCT_RECORDS}"""
SQL["tab_research_papers"] = f"""SELECT title AS "Title", authors AS "Authors", paper_url AS "Paper URL",
  {txt('github_url')} AS "GitHub URL", {txt('github_stars')} AS "GitHub Stars", published_date AS "Published Date" FROM {PAPERS}"""
JOBS = f"""(WITH j AS (SELECT *, CASE WHEN len(regexp_split_to_array(title, {q(_JOB_SPLIT)})) > 1
    THEN {strip(split_part_n('title', _JOB_SPLIT, 2))} ELSE 'AI Tech Company' END AS raw_name
  FROM {JOB_ROWS} WHERE t BETWEEN {_FRESH_A} - INTERVAL 24 HOUR AND {_FRESH_A} + INTERVAL 1 HOUR)
SELECT feed_id, pos, canonical_name AS company, {iso('t')} AS date, true AS is_remote, {role_family('title')} AS role_family, url
FROM {resolved('j')})"""
SQL["tab_jobs"] = f"""SELECT company AS "Company", date AS "Date", 'True' AS "Is Remote", role_family AS "Role Family",
  'Job feed ' || CAST(feed_id AS VARCHAR) AS "Source Name", url AS "Source URL" FROM {JOBS}"""
SQL["tab_news"] = f"""SELECT title AS "Title", 'News feed ' || CAST(feed_id AS VARCHAR) AS "Source Name", url AS "URL",
  publication_date AS "Publication Date", substr(full_text, 1, 200) AS "Text Snippet" FROM ({SQL['rss_news']})"""
_FIRST_PRODUCTS = f"(SELECT * FROM {PRODUCT_CANDS} QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_priority, page, pos) = 1)"
_JOB_NAMES = f"""(SELECT *, CASE WHEN len(regexp_split_to_array(title, {q(_JOB_SPLIT)})) > 1
    THEN {strip(split_part_n('title', _JOB_SPLIT, 2))} ELSE 'AI Tech Company' END AS raw_name
  FROM {JOB_ROWS} WHERE t BETWEEN {_FRESH_A} - INTERVAL 24 HOUR AND {_FRESH_A} + INTERVAL 1 HOUR)"""
SQL["tab_entity_mapping_log"] = " UNION ALL ".join(
    f"""SELECT raw_clean AS "Raw Name", canonical_name AS "Canonical Name", match_method AS "Match Method"
FROM {resolved(src)} WHERE match_method IS NOT NULL""" for src in (STARTUP_CANDS, _FIRST_PRODUCTS, _JOB_NAMES))

SQL["relationship_edges"] = f"""
SELECT s.entity_name AS src, 'LAUNCHED' AS rel, p.url AS dst FROM {STARTUP_RECORDS} s JOIN {PRODUCT_RECORDS} p ON s.entity_name = p.startup_name
UNION ALL
SELECT s.entity_name, 'POSTED', j.url FROM {STARTUP_RECORDS} s JOIN {JOBS} j ON s.entity_name = j.company
UNION ALL
SELECT paper_url, 'HAS_REPO', github_url FROM {PAPERS} WHERE github_url IS NOT NULL
"""

_URL_E = "'https://site.example.org/e/' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR)"
SQL["missing_date_fallback"] = f"""
WITH c AS (SELECT event_id, {fp(norm_url(_URL_E))} AS link_hash,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS p,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE date_trunc('second', ts) + INTERVAL 1 HOUR END AS m FROM events),
pr AS (SELECT {fp(norm_url(_URL_E))} AS link_hash, min(TIMESTAMP '2024-01-20 00:00:00') AS first_seen FROM events
       WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1)
SELECT event_id, {iso(f"coalesce(p, m, first_seen, TIMESTAMP '{I.AS_OF_RELATIVE}')")} AS published,
  CASE WHEN p IS NOT NULL THEN 'published' WHEN m IS NOT NULL THEN 'last_modified'
       WHEN first_seen IS NOT NULL THEN 'previous_crawl' ELSE 'first_seen' END AS date_source
FROM c LEFT JOIN pr USING (link_hash)
"""

SQL["missing_date_history"] = f"""
WITH s AS (SELECT event_id, ts, max(ts) OVER (PARTITION BY CAST(user_id AS VARCHAR) || '/' || event_type ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events)
SELECT event_id, {iso("CASE WHEN event_id % 10 <> 0 THEN ts ELSE coalesce(seen, ts) END")} AS published,
  CASE WHEN event_id % 10 <> 0 THEN 'published' WHEN seen IS NOT NULL THEN 'history' ELSE 'first_seen' END AS date_source FROM s
"""

STORED = {
    "STARTUP": f"SELECT 'STARTUP' AS record_type, url AS source_url, entity_name AS key, CAST(employee_count AS VARCHAR) AS more, source_name FROM {STARTUP_RECORDS}",
    "PRODUCT": f"SELECT 'PRODUCT', url, startup_name, pricing_model, source_name FROM {PRODUCT_RECORDS}",
    "RESEARCH_PAPER": f"SELECT 'RESEARCH_PAPER', paper_url, title, CAST(github_stars AS VARCHAR), 'arXiv' FROM {PAPERS}",
    "JOB": f"SELECT 'JOB', url, company, 'true', 'Job feed ' || CAST(feed_id AS VARCHAR) FROM {JOBS}",
    "NEWS": f"SELECT 'NEWS', url, title, full_text, 'News feed ' || CAST(feed_id AS VARCHAR) FROM ({SQL['rss_news']})",
}
SQL["store_roundtrip"] = "SELECT * FROM (" + " UNION ALL ".join(STORED.values()) + ") WHERE source_url <> ''"
SQL["store_counts"] = f"SELECT record_type, count(*) AS n, count(*) AS n_payload_url_match FROM ({SQL['store_roundtrip']}) GROUP BY record_type"
SQL["url_rejects"] = f"""SELECT 'JOB' AS record_type, CASE WHEN contains(url, '/feed/') THEN 'missing:source.url' ELSE 'ok' END AS reason,
  company, 'Job feed ' || CAST(feed_id AS VARCHAR) AS source_name FROM {JOBS}"""
SQL["stream_dedup"] = f"SELECT event_id, user_id, event_type, {iso('ts')} AS published FROM events"
SQL["stream_ledger_restart"] = SQL["stream_dedup"]
SQL["stream_dedup_stateful"] = SQL["stream_dedup"]
SQL["stream_freshness"] = SQL["freshness_filter"]

SQL["job_fingerprint_dedup"] = f"""
WITH j AS ({SQL['json_jobs']}),
f AS (SELECT *, {fp(norm_url('url'), 'company', 'date')} AS fingerprint FROM j)
SELECT fingerprint, feed_id, pos, company, date, url FROM f
QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY feed_id, pos) = 1
"""
SQL["stream_feed_parse"] = SQL["rss_jobs"]
_TAB_COLUMNS = {
    "startups": ["Entity Name", "Employee Count", "Source Name", "Source URL", "Collected At"],
    "products": ["Startup Name", "Pricing Model", "Source Name", "Source URL", "Collected At"],
    "research_papers": ["Title", "Authors", "Paper URL", "GitHub URL", "GitHub Stars", "Published Date"],
    "jobs": ["Company", "Date", "Is Remote", "Role Family", "Source Name", "Source URL"],
    "news": ["Title", "Source Name", "URL", "Publication Date", "Text Snippet"],
    "entity_mapping_log": ["Raw Name", "Canonical Name", "Match Method"],
}


def _exported(output: str, tab: str) -> str:
    cols = ", ".join(f"""coalesce("{c}", '')""" for c in _TAB_COLUMNS[tab])
    return f"SELECT {q(output)} AS output, concat_ws(chr(31), {cols}) AS row_text FROM ({SQL['tab_' + tab]})"


SQL["export_roundtrip"] = " UNION ALL ".join([*[_exported(t, t) for t in _TAB_COLUMNS], _exported("research_papers_json", "research_papers")])
SQL["topic_clusters_check"] = """SELECT count(*) AS vectors, 0::BIGINT AS not_once, 0::BIGINT AS not_nearest, 0::BIGINT AS wrong_distance, 0::BIGINT AS off_centre FROM embeddings"""
SQL["embedding_neighbours"] = """WITH s AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour,
    round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT id, CAST(row_number() OVER w AS INTEGER) AS rank, neighbour, similarity FROM s
WINDOW w AS (PARTITION BY id ORDER BY similarity DESC, neighbour) QUALIFY row_number() OVER w <= 10"""
SQL["embedding_recall"] = """SELECT CAST(10 * count(*) AS BIGINT) AS neighbours, true AS recall_met FROM embeddings WHERE vec_id % 50 = 0"""

# ---------------------------------------------------------------- HTML text by pattern (regular markup only)
_HIDDEN = "|".join(f"<{t}(\\s[^>]*)?>.*?</{t}>" for t in ("script", "style", "nav", "header", "footer", "noscript", "svg", "iframe"))


def unescape(e: str) -> str:
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        e = f"replace({e}, {q(name)}, '{c}')"
    return e


_RUNS = f"string_split(regexp_replace(regexp_replace(html, '(?is){_HIDDEN}', chr(30), 'g'), '(?s)<!--.*?-->|<[^>]*>', chr(30), 'g'), chr(30))"
CLEAN = f"""(SELECT page_id, trim(regexp_replace(array_to_string(list_transform(list_filter({_RUNS}, lambda r: r <> ''),
    lambda r: CASE WHEN trim(r, ' ' || chr(9) || chr(10) || chr(12) || chr(13)) <> '' THEN {unescape('r')} WHEN contains(r, chr(10)) THEN chr(10) ELSE ' ' END),
    chr(10)), '\\n\\s*\\n', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(12) || chr(13)) AS clean_text FROM pages)"""
SQL["html_clean_text"] = f"SELECT page_id, clean_text FROM {CLEAN}"
_PAGE_DOCS = f"(SELECT page_id AS doc_id, clean_text AS text FROM {CLEAN})"
SQL["extraction_input"] = f"""SELECT doc_id AS page_id, arg_min(chunk, chunk_idx) AS first_chunk, CAST(count(*) AS BIGINT) AS n_chunks
FROM {chunks_sql(_PAGE_DOCS)} GROUP BY doc_id"""
