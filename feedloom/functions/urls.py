"""Job URL: canonical URL and fingerprint columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_, py_strip

# generic-URL split: scheme, authority (after //), path (up to ? or #)
_URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"

# The scheme lists of the standard URL library.  Schemes that
# carry ";params" on the last path segment, and schemes that take "//host".
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
               "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
               "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync",
               "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services"]


def normalize_url(url) -> Column:
    """Trim; lower-case scheme and authority; keep path case; drop the last
    segment's ``;params``, the query and the fragment; strip trailing ``/``.
    Null or empty input gives the empty string."""
    u = py_strip(col_(url))
    scheme = F.regexp_extract(u, _URL_RE, 1)
    # authority group is optional: distinguish "no //" from "// with empty host"
    has_auth = u.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")
    host = F.regexp_extract(u, _URL_RE, 2)
    path = F.regexp_extract(u, _URL_RE, 3)
    sch = F.lower(scheme)
    path = F.when(sch.isin(USES_PARAMS), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)
    path = F.regexp_replace(path, r"/+$", "")
    no_host = ~(has_auth & (host != ""))
    authority = (
        F.when(~no_host, F.concat(F.lit("//"), F.lower(host)))
        .when(path.startswith("//"), F.lit("//"))
        .when((sch != "") & sch.isin(USES_NETLOC) & ((path == "") | path.startswith("/")), F.lit("//"))
        .otherwise(F.lit(""))
    )
    out = F.concat(
        F.when(sch != "", F.concat(sch, F.lit(":"))).otherwise(F.lit("")),
        authority,
        path,
    )
    return F.when(col_(url).isNull() | (col_(url) == ""), F.lit("")).otherwise(out)


def url_host(url) -> Column:
    return F.lower(F.regexp_extract(py_strip(col_(url)), _URL_RE, 2))


def fingerprint(*parts) -> Column:
    """SHA-256 hex of the non-empty parts, each trimmed and lower-cased,
    joined with ``|``.  Empty/null parts are dropped; a blank part stays as
    an empty segment."""
    segs = [F.when(col_(p) != "", F.lower(py_strip(col_(p)))) for p in parts]
    joined = F.concat_ws("|", *segs) if segs else F.lit("")
    return F.sha2(joined, 256)


def record_fingerprint(norm_url, canonical_name, published) -> Column:
    """normalised URL | canonical name | published date."""
    return fingerprint(norm_url, canonical_name, published)
