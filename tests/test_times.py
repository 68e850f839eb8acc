from helpers import one
from feedloom.functions.times import format_iso, is_fresh, parse_date

T = "2024-01-21 12:00:00"

GOLDEN = [
    ("2 hours ago", "2024-01-21T10:00:00+00:00", True),
    ("3 days ago", "2024-01-18T12:00:00+00:00", False),
    ("2024-01-21T12:00:00+00:00", "2024-01-21T12:00:00+00:00", True),
    ("2024-01-20T13:00:00Z", "2024-01-20T13:00:00+00:00", True),   # T - 23 h
    ("2024-01-20T11:00:00Z", "2024-01-20T11:00:00+00:00", False),  # T - 25 h
    ("yesterday", "2024-01-20T12:00:00+00:00", True),              # inclusive at a fixed as-of
    ("2024-01-21 13:00:00", "2024-01-21T13:00:00+00:00", True),    # T + 1 h
    ("2024-01-21 13:00:01", "2024-01-21T13:00:01+00:00", False),   # T + 1 h 1 s
    ("3 weeks ago", None, False),
    ("jan 5, 2024", "2024-01-05T00:00:00+00:00", False),
    ("January 5, 2024", "2024-01-05T00:00:00+00:00", False),
    ("5 Jan 2024", "2024-01-05T00:00:00+00:00", False),
    ("20240120", "2024-01-20T00:00:00+00:00", False),
    ("2024-W03-6", "2024-01-20T00:00:00+00:00", False),
    ("2024", None, False),
    ("2024-01", None, False),
    ("18:00", None, False),
    ("Mon, 22 Jan 2024 10:00:00 GMT", "2024-01-22T10:00:00+00:00", False),
    ("2024-01-05T10:00:00.123+05:30", "2024-01-05T04:30:00.123000+00:00", False),
    ("2024-01-22T10:00Z", "2024-01-22T10:00:00+00:00", False),
    ("2024-01-21T14:00+02:00", "2024-01-21T12:00:00+00:00", True),
    ("2024-01-21T14+02", "2024-01-21T12:00:00+00:00", True),
    ("2024-01-21T10", "2024-01-21T10:00:00+00:00", True),
    ("2024-01-21T10:00:00.1234567Z", "2024-01-21T10:00:00.123456+00:00", True),
    ("2024-01-21T10:00:00,5+0000", "2024-01-21T10:00:00.500000+00:00", True),
    ("Sun, 21 Jan 2024 10:00 GMT", "2024-01-21T10:00:00+00:00", True),
    ("Sunday, 21 Jan 2024 05:00:00 EST", "2024-01-21T10:00:00+00:00", True),
    ("21 Jan 2024 11:30:00 +0130", "2024-01-21T10:00:00+00:00", True),
    ("Sun, 21 Jan 2024 10:00:00 XYZ", None, False),
    ("", None, False),
    (None, None, False),
]


def test_parse_and_freshness_golden(spark):
    vals = [g[0] for g in GOLDEN]
    got = one(spark, vals, "s string", format_iso(parse_date("s", T)))
    fresh = one(spark, vals, "s string", is_fresh(parse_date("s", T), T))
    assert got == [g[1] for g in GOLDEN]
    assert fresh == [g[2] for g in GOLDEN]


def test_unparsed_now_reproduces_reference_default(spark):
    got = one(spark, ["3 weeks ago", "", "garbage"], "s string", format_iso(parse_date("s", T, on_unparsed="now")))
    assert got == ["2024-01-21T12:00:00+00:00"] * 3


def test_mail_dates_can_be_disabled(spark):
    got = one(spark, ["Mon, 22 Jan 2024 10:00:00 GMT"], "s string", parse_date("s", T, mail_dates=False))
    assert got == [None]


import datetime as _dt  # noqa: E402

from hypothesis import given, settings, strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

# (Spark pattern used to write the text, truncation of the instant it must parse back to)
ROUND_TRIP = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second"), ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", None),
    ("yyyy-MM-dd HH:mm:ss", "second"), ("yyyy-MM-dd", "day"), ("MMM d, yyyy", "day"),
    ("MMMM d, yyyy", "day"), ("d MMM yyyy", "day"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "second"),
    ("yyyyMMdd", "day"), ("yyyy-MM-dd'T'HH:mm:ssxx", "second"),
]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.datetimes(min_value=_dt.datetime(1990, 1, 1), max_value=_dt.datetime(2037, 12, 31)),
                min_size=1, max_size=12))
def test_formats_round_trip(spark, instants):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(instants)], "i long, t timestamp")
    cols = []
    for k, (fmt, unit) in enumerate(ROUND_TRIP):
        exp = F.col("t") if unit is None else F.date_trunc(unit, "t")
        cols += [format_iso(parse_date(F.date_format("t", fmt), T)).alias(f"g{k}"), format_iso(exp).alias(f"e{k}")]
    for r in df.select(*cols).collect():  # one job per example, all formats
        for k, (fmt, _unit) in enumerate(ROUND_TRIP):
            assert r[f"g{k}"] == r[f"e{k}"], fmt
