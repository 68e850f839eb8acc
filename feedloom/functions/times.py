"""Job TIME: publish-time normalisation (F4-F7) and freshness.

No function here reads the clock.  ``as_of`` is the instant the reference
calls "now"; pass ``F.current_timestamp()`` explicitly in a live stream.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_, nullif_empty, py_strip

_REL_RE = r"(?U)(\d+)\s+(minute|min|hour|hr|day|sec|second)s?\s+ago"

# (guard regex on the lower-cased text, Spark pattern).  Guards keep the
# parser as strict as the reference: "2024", "2024-01" and "18:00" must not
# parse, which a bare cast would accept.
_ABSOLUTE = [
    # ISO date-time, in the form that _iso_canonical gives it
    (r"^\d{4}-\d{1,2}-\d{1,2}t\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?(z|[+-]\d\d:\d\d)?$",
     "yyyy-M-d'T'H:m:s[.SSSSSS][XXX]"),
    (r"^\d{4}-\d{2}-\d{2}t\d{2}:\d{2}(z|[+-]\d\d:\d\d)?$", "yyyy-MM-dd'T'HH:mm[XXX]"),
    (r"^\d{4}-\d{2}-\d{2}t\d{2}(z|[+-]\d\d:\d\d)?$", "yyyy-MM-dd'T'HH[XXX]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^[a-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[a-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [a-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{8}t\d{6}$", "yyyyMMdd'T'HHmmss"),
]


def _iso_canonical(s: Column) -> Column:
    """Space between date and time -> "t"; a fraction's comma -> point and its
    digits beyond the sixth dropped; "+hhmm" and "+hh" -> "+hh:mm"."""
    t = F.regexp_replace(s, r"^(\d{4}-\d{1,2}-\d{1,2}) (\d)", "$1t$2")
    t = F.regexp_replace(t, r"(t\d{1,2}:\d{1,2}:\d{1,2})[.,](\d{1,6})\d*", "$1.$2")
    t = F.regexp_replace(t, r"(t\d.*[+-]\d\d)(\d\d)$", "$1:$2")
    return F.regexp_replace(t, r"(t\d[^+-]*[+-]\d\d)$", "$1:00")


# Mail-style dates ("Mon, 22 Jan 2024 10:00:00 GMT"): weekday (short or full)
# dropped, seconds optional, zone names mapped to an offset, then parsed with
# an explicit pattern.
_MAIL_RE = r"^(?:[a-z]{3,9},?\s+)?(\d{1,2} [a-z]{3} \d{4} \d{1,2}:\d{2})(:\d{2})? ([a-z]{1,3}|[+-]\d{4})$"
# The zone names of mail dates.
_MAIL_ZONES = {
    "gmt": "+0000", "utc": "+0000", "ut": "+0000", "z": "+0000", "est": "-0500", "edt": "-0400", "cst": "-0600",
    "cdt": "-0500", "mst": "-0700", "mdt": "-0600", "pst": "-0800", "pdt": "-0700",
}


def to_ts(as_of) -> Column:
    """A timestamp column from a datetime, ISO string or Column."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    return F.to_timestamp(F.lit(str(as_of)))


def _minus_micros(t: Column, n: Column, unit_us: int) -> Column:
    return F.timestamp_micros(F.try_subtract(F.unix_micros(t), F.try_multiply(n, F.lit(unit_us))))


def parse_relative(s: Column, as_of: Column) -> Column:
    """F4 on lower-cased, stripped text; null when it is not relative."""
    amount = F.regexp_extract(s, _REL_RE, 1).try_cast("bigint")
    unit = F.regexp_extract(s, _REL_RE, 2)
    matched = s.rlike(_REL_RE)
    by_unit = (
        F.when(unit.contains("sec"), _minus_micros(as_of, amount, 1_000_000))
        .when(unit.contains("min"), _minus_micros(as_of, amount, 60_000_000))
        .when(unit.contains("hour") | unit.contains("hr"), _minus_micros(as_of, amount, 3_600_000_000))
        .when(unit.contains("day"), _minus_micros(as_of, amount, 86_400_000_000))
    )
    return (
        F.when(s.contains("yesterday"), as_of - F.expr("INTERVAL 1 DAY"))
        .when(s.contains("ago") & matched, by_unit)
    )


def _iso_week(s: Column) -> Column:
    """ISO week date ``YYYY-Www-D`` (or ``YYYYWwwD``)."""
    m = r"^(\d{4})-?w(\d{2})-?([1-7])$"
    y = F.regexp_extract(s, m, 1).try_cast("int")
    w = F.regexp_extract(s, m, 2).try_cast("int")
    d = F.regexp_extract(s, m, 3).try_cast("int")
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    week1_monday = F.date_sub(jan4, (F.dayofweek(jan4) + 5) % 7)
    day = F.date_add(week1_monday, (w - 1) * 7 + (d - 1))
    ok = s.rlike(m) & (w >= 1) & (w <= 53)
    return F.when(ok, F.to_timestamp(day))


def parse_absolute(s: Column, mail_dates: bool = True, iso: Column | None = None) -> Column:
    """F5 (+ F7 when ``mail_dates``) on lower-cased, stripped text.
    ``iso`` may pass ``_iso_canonical(s)`` already projected."""
    c = _iso_canonical(s) if iso is None else iso
    cands = [F.when(c.rlike(g), F.try_to_timestamp(c, F.lit(fmt))) for g, fmt in _ABSOLUTE]
    cands.append(_iso_week(s))
    if mail_dates:
        body = F.concat(F.regexp_extract(s, _MAIL_RE, 1),
                        F.coalesce(nullif_empty(F.regexp_extract(s, _MAIL_RE, 2)), F.lit(":00")))
        zone = F.regexp_extract(s, _MAIL_RE, 3)
        off = zone
        for name, value in _MAIL_ZONES.items():
            off = F.when(zone == name, F.lit(value)).otherwise(off)
        cands.append(F.when(s.rlike(_MAIL_RE) & off.rlike(r"^[+-]"),
                            F.try_to_timestamp(F.concat_ws(" ", body, off), F.lit("d MMM yyyy H:mm:ss Z"))))
    return F.coalesce(*cands)


def _parsed(raw: Column, s: Column, iso: Column, as_of, on_unparsed: str, mail_dates: bool) -> Column:
    """The parser: ``raw`` text, its cleaned and its canonical form."""
    if on_unparsed not in ("now", "null"):
        raise ValueError("on_unparsed must be 'now' or 'null'")
    now = to_ts(as_of)
    parsed = F.coalesce(
        F.when(s.contains("ago") | s.contains("yesterday"), parse_relative(s, now)),
        parse_absolute(s, mail_dates, iso),
    )
    parsed = F.when(raw.isNotNull() & (raw != ""), parsed)
    return F.coalesce(parsed, now) if on_unparsed == "now" else parsed


def parse_date(raw, as_of, on_unparsed: str = "null", mail_dates: bool = True) -> Column:
    """Publish text -> UTC instant.

    ``on_unparsed='now'`` reproduces the reference's ``default_now=True``
    (unparsed and empty text become ``as_of``); ``'null'`` keeps them null.
    """
    raw = col_(raw)
    s = F.lower(py_strip(raw))
    return _parsed(raw, s, _iso_canonical(s), as_of, on_unparsed, mail_dates)


def with_parsed_date(df, raw: str, out: str, as_of, on_unparsed: str = "null", mail_dates: bool = True):
    """DataFrame form of ``parse_date``: the cleaned text is projected once
    (a non-cheap expression used by every branch is not re-inlined by the
    optimizer), which keeps the generated code small enough to compile."""
    s = "__date_s"
    d = df.withColumn(s, F.lower(py_strip(F.col(raw))))
    d = d.withColumn("__date_iso", _iso_canonical(F.col(s)))
    parsed = _parsed(F.col(raw), F.col(s), F.col("__date_iso"), as_of, on_unparsed, mail_dates)
    from feedloom.functions.once import compute_once
    return compute_once(d, **{out: parsed}).drop(s, "__date_iso")


def format_iso(ts, as_of=None) -> Column:
    """ISO-8601 in UTC, ``+00:00`` suffix, micros only when non-zero.
    Null becomes ``as_of`` when given (the reference formats "now")."""
    t = col_(ts)
    if as_of is not None:
        t = F.coalesce(t, to_ts(as_of))
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNotNull(),
                  F.concat(whole, F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                           F.lit("+00:00")))


def fresh_window(ts, as_of, hours: int = 24) -> Column:
    """P3 predicate ``as_of - hours <= ts <= as_of + 1h`` (null when ts is
    null).  With a literal ``as_of`` it folds to two literal bounds, which
    the Parquet scan can use against row-group statistics."""
    t = col_(ts)
    now = to_ts(as_of)
    lo = now - F.make_dt_interval(F.lit(0), F.lit(hours))
    hi = now + F.expr("INTERVAL 1 HOUR")
    return (t >= lo) & (t <= hi)


def is_fresh(ts, as_of, hours: int = 24) -> Column:
    """P3 as a boolean column; null is never fresh."""
    return F.coalesce(fresh_window(ts, as_of, hours), F.lit(False))


def freshness_filter(df, ts_col: str, as_of, hours: int = 24):
    """DataFrame form of P3 (a pushable filter; null rows are dropped)."""
    return df.filter(fresh_window(ts_col, as_of, hours))
