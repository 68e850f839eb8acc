import collections
import hashlib

import numpy as np
from fixtures_llm import empty, messy, prose, rows

from feedloom.llm import cws
from feedloom.llm.cws import edited_text, fingerprint_documents, fingerprints, likeness, sample_keys


def bag(text):
    w = text.encode().lower().split()
    return collections.Counter(zip(w, w[1:], strict=False)) if len(w) > 1 else collections.Counter(w)


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def test_collision_rate_is_generalised_jaccard(monkeypatch):
    """Over many term pairs with weights the rate of equal samples."""
    rng = np.random.default_rng(4)
    hits, want = [], []
    for _ in range(60):
        terms = rng.integers(1, 2**63, 6, dtype=np.uint64)
        x, y = rng.integers(0, 6, 6), rng.integers(0, 6, 6)
        x[0] = y[1] = 3
        a, b = (sample_keys(terms[w > 0], w[w > 0]).min(0) & np.uint64(0xFFFFFFFF) for w in (x, y))
        hits.append((a == b).mean())
        want.append(np.minimum(x, y).sum() / np.maximum(x, y).sum())
    # 60 * 64 samples: the mean's standard error is below 0.008
    assert abs(np.mean(hits) - np.mean(want)) < 0.03
    assert np.corrcoef(hits, want)[0, 1] > 0.9


def test_likeness_of_texts():
    got, want = [], []
    for i in range(40):
        a, b = prose(i, 120), prose(i + 500, 120)
        e = edited_text(a, b)
        f = fingerprints([a, e, b, a])
        assert (f[0] == f[3]).all()
        got += [likeness(f[0], f[1]), likeness(f[0], f[2])]
        want += [jaccard(bag(a), bag(e)), jaccard(bag(a), bag(b))]
    assert abs(np.mean(got) - np.mean(want)) < 0.02 and np.corrcoef(got, want)[0, 1] > 0.9


def test_long_texts_in_term_blocks(monkeypatch):
    t = prose(3, 6000)
    one = fingerprints([t])
    monkeypatch.setattr(cws, "TERM_BLOCK", 100)
    assert (fingerprints([t]) == one).all()


def expected(data):
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (d, t) in enumerate(order):
        n = order[(i + 1) % len(order)][1] or ""
        t = t or ""
        f = fingerprints([t, edited_text(t, n), n])
        out[d] = (len(t), hashlib.sha256(edited_text(t, n).encode()).hexdigest(), f[0].tobytes().hex(), f[1].tobytes().hex(),
                  float(likeness(f[0], f[1])), float(likeness(f[0], f[2])))
    return out


def check(spark, data):
    want = expected(data)
    got = fingerprint_documents(messy(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        assert tuple(r)[1:] == want[r["doc_id"]]


def test_awkward_rows(spark):
    seen, data = set(), []
    for d, t in rows():
        if d not in seen:  # one row an id
            data.append((d, t))
        seen.add(d)
    check(spark, data)


def test_many_ranges(spark):
    check(spark, [(i * 7 - 50, prose(i, 1 + i % 9)) for i in range(150)])


def test_one_row_is_its_own_next(spark):
    check(spark, [(5, "a b c d")])
    (r,) = fingerprint_documents(messy(spark, [(5, "")])).collect()
    assert (r["n_chars"], r["near_edited"], r["near_next"]) == (0, 1.0, 1.0)


def test_repeated_rows(spark):
    got = fingerprint_documents(messy(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, None), (None, "x")])).collect()
    assert len(got) == 5 and len({r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}) == 1


def test_empty(spark):
    assert fingerprint_documents(empty(spark)).count() == 0
