import hashlib
from urllib.parse import urlparse, urlunparse

from hypothesis import given, settings, strategies as st

from helpers import one
from feedloom.functions.urls import fingerprint, normalize_url

CASES = [
    ("HTTP://Tide.Example.NET/Gauge/7/?page=2#top", "http://tide.example.net/Gauge/7"),
    ("https://tide.example.net/gauge", "https://tide.example.net/gauge"),
    ("http://a.com//", "http://a.com"),
    ("a.com/B/", "a.com/B"),
    ("//h/x/", "//h/x"),
    ("http://U@H.com:80/X;p=1?q#f", "http://u@h.com:80/X"),
    ("http://a/b;c/d;e", "http://a/b;c/d"),
    ("?q", ""),
    ("", ""),
    (None, ""),
]


def test_normalize_url_golden(spark):
    got = one(spark, [c for c, _ in CASES], "u string", normalize_url("u"))
    assert got == [e for _, e in CASES]


def _py_norm(url):
    if not url:
        return ""
    p = urlparse(url.strip())
    return urlunparse((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), "", "", ""))


_seg = st.text(alphabet="abcXYZ09-._~", min_size=1, max_size=6)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["http", "HTTPS", "ftp"]), _seg, st.lists(_seg, max_size=3),
                          st.booleans(), st.booleans()), min_size=1, max_size=10))
def test_normalize_matches_stdlib_and_is_idempotent(spark, parts):
    urls = [f"{s}://{h}.com/" + "/".join(p) + ("/" if slash else "") + ("?a=1#f" if q else "")
            for s, h, p, slash, q in parts]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select("u", normalize_url("u").alias("n")).select("u", "n", normalize_url("n").alias("nn")).collect()
    for r in rows:
        assert r.n == _py_norm(r.u)
        assert r.nn == r.n


FP = [
    (("https://openai.com/blog", "OpenAI", None), "c3c47cb1571896ddce856a4ce3e5545249709a376f6f3c3c9e013ccbff9214bc"),
    (("https://openai.com/blog ", "OPENAI", None), "c3c47cb1571896ddce856a4ce3e5545249709a376f6f3c3c9e013ccbff9214bc"),
    (("a", "", "b"), "0eab8a0a3380abf4c7d1fb0b43b66aafbb64a4b953e4eb2dccca579461912d0c"),
    (("a", " ", "b"), "23360994fdaa608ee91c88e2901c2e83d5322dc145fafebe06e4d9036d5d1e28"),
    ((None, None, None), "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"),
]


def test_fingerprint_golden(spark):
    got = one(spark, [a for a, _ in FP], "a string, b string, c string", fingerprint("a", "b", "c"))
    assert got == [h for _, h in FP]
    for args, h in FP:
        assert hashlib.sha256("|".join(str(a).strip().lower() for a in args if a).encode()).hexdigest() == h
