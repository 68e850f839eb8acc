import hashlib
import random

import numpy as np
import pytest
from fixtures_llm import empty, messy, prose, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import suffix
from feedloom.llm.suffix import LENGTH, anchors, front_code, merge_runs, read_run, remove_repeats, shared


def brute(rows_):
    seen, out = set(), {}
    for d, t in sorted(set(rows_), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        cover = np.zeros(len(b), bool)
        for s in range(len(b) - LENGTH + 1):
            w = b[s:s + LENGTH]
            if w in seen:
                cover[s:s + LENGTH] = True
            seen.add(w)
        runs = int((np.diff(np.r_[0, cover.astype(int), 0]) == 1).sum())
        left = bytes(np.frombuffer(b, np.uint8)[~cover])
        out[d, hashlib.sha256(left).hexdigest()] = (len(b), int(cover.sum()), runs)
    return out


def check(spark, data):
    want = brute(data)
    got = remove_repeats(messy(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert want[r["doc_id"], r["kept_sha256"]] == (r["n_bytes"], r["n_removed"], r["n_spans"])


def test_awkward_rows(spark):
    check(spark, [r for r in rows() if r[0] is not None or r[1] is not None])


def planted():
    rng = random.Random(3)
    line = "Terms of use apply to all of the pages of this site, and to all who read them." + "!" * 30
    passage = prose(900, 60)
    out = []
    for i in range(60):
        parts = [prose(2000 + i, rng.randrange(5, 40)), line, prose(3000 + i, 20)]
        if i % 3 == 0:
            parts.insert(1, passage)
        if i % 7 == 0:
            parts.append(parts[0])
        rng.shuffle(parts)
        out.append((i, "\n".join(parts)))
    return [*out, (100, "ab" * 400), (101, "ab" * 400 + "c"), (102, "z" * 99), (103, "z" * 99), (104, "z" * 100), (105, "z" * 101)]


def test_planted_lines_and_passages(spark):
    check(spark, planted())


def test_frequent_anchors_string_by_string(spark, monkeypatch):
    monkeypatch.setattr(suffix, "FREQUENT", 5)
    check(spark, planted())


def test_segments_of_a_long_text(monkeypatch):
    texts = [t.encode() for t in (prose(5, 900), prose(6, 300) + prose(5, 700), "q" * 3000, "", "ab" * 60)]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def strings():
        return sorted((x["doc"], x["pos"] - o, x["pos"]) for x in anchors(data, off).tolist() and
                      [dict(zip(suffix._ENTRY.names, r)) for r in anchors(data, off).tolist()] for o in range(x["lo"], x["hi"] + 1))
    whole = strings()
    monkeypatch.setattr(suffix, "_SEGMENT", 700)
    assert strings() == whole


def test_every_string_has_one_anchor():
    texts = [prose(i, 60).encode() for i in range(5)] + [b"a" * 300]
    off = np.cumsum([0, *map(len, texts)])
    e = anchors(np.frombuffer(b"".join(texts), np.uint8), off)
    for d, t in enumerate(texts):
        mine = e[e["doc"] == d]
        starts = sorted(p - o for p, lo, hi in zip(mine["pos"].tolist(), mine["lo"].tolist(), mine["hi"].tolist()) for o in range(lo, hi + 1))
        assert starts == list(range(len(t) - LENGTH + 1))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=6).map(str.encode), max_size=8), max_size=9))
def test_loser_tree(lists):
    runs = [sorted(x) for x in lists]
    lcps = [[shared(r, runs[k][i - 1], 0) if i else 0 for i, r in enumerate(runs[k])] for k in range(len(runs))]
    if not runs:
        return
    source, lcp = merge_runs(runs, lcps)
    place = [0] * len(runs)
    out = []
    for k in source:
        out.append(runs[k][place[k]])
        place[k] += 1
    assert out == sorted(x for r in runs for x in r)
    assert lcp == [shared(x, out[i - 1], 0) if i else 0 for i, x in enumerate(out)]


def test_front_coding():
    right = [b"", b"abc", b"abcd", b"abd", b"b"]
    left = [b"xy", b"xyz", b"", b"x", b"x"]
    rec = np.array([(i, 0, 0, 0, 0, len(r), len(x), 0, 0) for i, (r, x) in enumerate(zip(right, left))], suffix._RUN)
    got, r, x = read_run(front_code(rec, right, left))
    assert (r, x, got["did"].tolist()) == (right, left, [0, 1, 2, 3, 4])


def test_empty(spark):
    assert remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("texts", [[(1, None), (2, ""), (3, "short")]])
def test_nothing_to_search(spark, texts):
    check(spark, texts)
