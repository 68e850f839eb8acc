import re
import zlib
from collections import Counter

import pytest
from fixtures_llm import empty, messy, prose, rows
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from feedloom.llm.spelling import matrix, near, op13_spelling, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def edits(w, alphabet):
    for i in range(len(w)):
        yield w[:i] + w[i + 1:]
        for c in alphabet:
            yield w[:i] + c + w[i + 1:]
    for i in range(len(w) + 1):
        for c in alphabet:
            yield w[:i] + c + w[i:]


def brute(docs):
    count = Counter()
    for d, t in docs:
        for m in RUN.findall(t or ""):
            w = m.translate(UPPER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            count[w] += 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    alphabet = sorted({c for w in count for c in w})
    form, out = {}, {}
    for w, n in count.items():
        by = {x for x in edits(w, alphabet) if x in count and x != w}
        best = min(by, key=lambda x: (-count[x], x)) if by else None
        form[w] = best if by and count[best] >= 5 * n else None
        out[w] = (n, len(by))
    res = set()
    for w, (n, k) in out.items():
        r = w
        while form[r]:
            r = form[r]
        res.add((w, form[w], r, n, k, count[form[w]] if form[w] else None))
    return res


def got(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def chains():
    """Words with variants of variants, ties, accents, shared halves."""
    base = [("garden", 900), ("gardens", 150), ("gardenz", 40), ("gardxnz", 7), ("gardeen", 30), ("harden", 900),
            ("éclairs", 200), ("èclairs", 30), ("éclair", 30), ("ÿ×÷abcd", 60), ("ÿ×÷abce", 6), ("gardan", 5),
            ("abcabcabcabc", 50), ("abcabcabcab", 50), ("zz" * 60, 40), ("zz" * 59 + "z", 8)]
    text = [w for w, n in base for _ in range(n)]
    return [(i, ", ".join(text[i::40])) for i in range(40)]


def test_against_brute_force(spark):
    docs = chains() + [(100 + i, prose(i, 60)) for i in range(30)]
    want = brute(docs)
    assert any(f and r != f for _, f, r, *_ in want) and any(k > 1 for *_, k, _ in want)
    assert got(spelling_variants(messy(spark, docs))) == want
    # blocks cut into tiles of a few words give the same
    assert got(spelling_variants(messy(spark, docs), tile=3)) == want


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(op13_spelling(spark, "/root/testdata/sf0.001")) == brute(docs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=2, max_size=6, unique=True))
def test_near_is_one_edit(ws):
    m, n = matrix(ws, 7), np.array([len(w) for w in ws])
    hit, _ = near(m, n, m, n)
    for i, a in enumerate(ws):
        assert {ws[j] for j in np.flatnonzero(hit[i])} == {x for x in ws if x in set(edits(a, "abé")) and x != a}


@pytest.mark.parametrize("copies", [1, 9])
def test_awkward_rows(spark, copies):
    docs = rows() * copies
    assert got(spelling_variants(messy(spark, docs))) == brute(docs)


def test_many_slips(spark):
    """Frequent words meet their own slips."""
    docs = [(i, " ".join(["Lighthouse", "harbour", "MOUNTAIN"] * 40)) for i in range(1500)]
    res = got(spelling_variants(messy(spark, docs)))
    assert res == brute(docs) and any(f == "lighthouse" for _, f, *_ in res)


def test_empty(spark):
    assert spelling_variants(empty(spark)).count() == 0
    assert spelling_variants(messy(spark, [(1, None), (2, ""), (None, "a b c")])).count() == 0
