import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import empty, messy, prose, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import chaining
from feedloom.llm.chaining import _MATCH, GAP_COST, K, MIN_WORDS, align, chains, dense_stretches, fuzzy_passages, minimizers


def brute_best(m):
    """Best chain score by the quadratic recurrence."""
    m = sorted(set(map(tuple, m)))
    best = {}
    for b, a in m:
        best[b, a] = K + max([0.0, *(s - GAP_COST * ((a - x) + (b - y)) / 2 for (y, x), s in best.items() if x < a and y < b)])
    return max(best.values())


def score(c):
    return K * len(c) - GAP_COST / 2 * float((c["a"][-1] - c["a"][0]) + (c["b"][-1] - c["b"][0]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=40))
def test_chains_against_brute_force(pairs):
    got = chains(np.array(pairs, _MATCH))
    for c in got:
        assert (np.diff(c["a"].astype(int)) > 0).all() and (np.diff(c["b"].astype(int)) > 0).all()
    used = [tuple(x) for c in got for x in c.tolist()]
    assert len(used) == len(set(used))
    best = brute_best(pairs)
    if got and best > K:
        assert abs(score(got[0]) - best) < 1e-9


def test_dense_stretches():
    same = np.array([False] * 30 + [True] * 60 + [False] * 40 + [True, True, True, True, False] * 20 + [False] * 9)
    got = dense_stretches(same)
    assert [(x, y) for x, y in got][0] == (30, 90)
    assert all(same[x:y].mean() >= 0.8 and y - x >= MIN_WORDS for x, y in got)
    assert dense_stretches(np.ones(MIN_WORDS - 1, bool)) == [] and dense_stretches(np.zeros(200, bool)) == []


def dense(same):
    """All stretches long and equal enough, by brute force."""
    n = np.concatenate([[0], np.cumsum(same)])
    return [(x, y) for x in range(len(same)) for y in range(x + MIN_WORDS, len(same) + 1) if 5 * (n[y] - n[x]) >= 4 * (y - x)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(40, 170), st.sampled_from([0.7, 0.78, 0.82, 0.86, 0.9, 0.95]))
def test_dense_stretches_against_brute_force(seed, n, share):
    r = np.random.default_rng(seed)
    same = np.concatenate([r.random(20) < 0.05, r.random(n) < share, r.random(20) < 0.05])
    got, all_ = dense_stretches(same), dense(same)
    assert set(got) <= set(all_) and all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    assert all(any(x < e and s < y for s, e in got) for x, y in all_)


def test_dense_stretches_around_a_short_best_one():
    assert dense_stretches(np.array([True] * 45 + [False] * 2 + [True] * 5)) == [(0, 52)]
    (got,) = dense_stretches(np.array([True, True, True, True, False] * 20))
    assert got[1] - got[0] >= 99
    assert dense_stretches(np.array([True] * 50 + [False] * 13 + [True] * 38)) == [(0, 101)]
    assert dense_stretches(np.array([True] * 38 + [False] * 13 + [True] * 50)) == [(0, 101)]


def test_alignment_over_insertions_and_substitutions():
    x = np.arange(1000, 1200, dtype=np.uint32)
    y = np.concatenate([x[20:60], [1, 2, 3], x[60:90], [9], x[91:150]]).astype(np.uint32)
    m = np.array([(0, 20), (30, 50), (50, 67), (110, 127)], _MATCH)
    ca, cb, same = align(x, y, m)
    assert same.sum() == 40 + 30 + 59
    assert (np.diff(ca[ca >= 0]) == 1).all() and (np.diff(cb[cb >= 0]) == 1).all()


def test_minimizers_are_local():
    w = np.random.default_rng(1).integers(0, 2**63, 200, dtype=np.uint64)
    h, at = minimizers(w)
    h2, at2 = minimizers(np.concatenate([w[100:], w[:100]]))
    assert set(h[(at > 110) & (at < 185)]) <= set(h2) and len(minimizers(w[:10])[0]) == 0


def edit(text, rng, every):
    w = text.split(" ")
    for i in range(rng.randrange(every), len(w), every):
        w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_planted_passages(spark):
    rng = random.Random(8)
    passage, common = prose(50, 80), prose(51, 60)
    data = [(i, prose(100 + i, 150)) for i in range(12)]
    data += [(20, f"{prose(200, 40)} {passage} {prose(201, 40)}"), (21, f"{prose(202, 70)} {passage} {prose(203, 10)}"),
             (22, f"{prose(204, 20)} {edit(passage, rng, 12)} {prose(205, 30)}"),
             (23, f"{prose(206, 20)} {' '.join(passage.split(' ')[:35])} {prose(207, 60)}")]
    data += [(30 + i, f"{prose(300 + i, 20 + i)}\n{common}\n{prose(400 + i, 30)}") for i in range(15)]
    got = {}
    for r in fuzzy_passages(messy(spark, data)).collect():
        assert r["other_doc_id"] < r["doc_id"] and r["similarity"] >= 0.8 and r["n_words"] >= 45
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == {21, 22, *range(31, 45)}
    (r,) = got[21]
    assert abs(r["first_word"] - 70) <= 2 and abs(r["n_words"] - 80) <= 4 and r["other_doc_id"] == 20
    for i in range(1, 15):
        (r,) = got[30 + i]
        assert abs(r["first_word"] - (20 + i)) <= 2 and abs(r["n_words"] - 60) <= 4


def test_parts_seen_earlier_in_other_documents(spark):
    data, want = [], set()
    for i in range(24):
        n = 2 + i % 2
        lines = [prose(5000 + 10 * i + k, 60 // n) for k in range(n)]
        data += [(1000 * i + k, f"{prose(6000 + 10 * i + k, 30)} {line} {prose(7000 + 10 * i + k, 30)}") for k, line in enumerate(lines)]
        data += [(1000 * i + k, f"{prose(8000 + 10 * i + k, 25)} {' '.join(lines)} {prose(9000 + 10 * i + k, 25)}") for k in (50, 51)]
        want.add((1000 * i + 51, 1000 * i + 50))
    got = fuzzy_passages(messy(spark, data)).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in got} == want
    assert all(abs(r["first_word"] - 25) <= 2 and abs(r["n_words"] - 60) <= 4 for r in got)


def test_awkward_rows(spark):
    got = fuzzy_passages(messy(spark)).collect()
    links = {(r["doc_id"], r["other_doc_id"]) for r in got}
    assert {(2, 1), (8, 1), (10, 7)} <= links and any(d == 12 for d, _ in links)
    assert all(d in (2, 8, 10, 12) for d, _ in links)
    null = fuzzy_passages(messy(spark, [(1, prose(1, 90)), (None, prose(1, 90))])).collect()
    assert [(r["doc_id"], r["other_doc_id"], r["n_words"]) for r in null] == [(None, 1, 90)]


def test_empty(spark):
    assert fuzzy_passages(empty(spark)).count() == 0


def test_firsts_and_matches_against_brute_force():
    rng = np.random.default_rng(5)
    for q in range(60):
        docs, n = int(rng.integers(1, 10)), int(rng.integers(0, 60))
        did, th = rng.integers(0, 6, docs), rng.integers(0, 3, docs)
        s = np.zeros(n, chaining._SEED)
        s["hash"], s["doc"], s["pos"] = rng.integers(0, 15, n), rng.integers(0, docs, n), rng.integers(0, 30, n)
        s["span"] = rng.integers(1, 5, n) if q % 2 else 0
        name = [(int(d), int(t)) for d, t in zip(did, th, strict=True)]
        seen = [(name[d], int(p), int(w), int(h)) for h, d, p, w in s.tolist()]
        least = {h: min(x for x in seen if x[3] == h) for h in {x[3] for x in seen}}
        want = []
        for doc, pos, span, h in seen:
            first, at, reach, _ = least[h]
            if first != doc:
                want += [(doc, first, pos, at)] + ([(doc, first, pos + span, at + reach)] if span else [])
        f, m, b, a = chaining.link_firsts(s, did, th)
        assert sorted((name[d], p, w, h) for h, d, p, w in f.tolist()) == sorted(least.values())
        assert sorted((name[x], name[y], pb, pa_) for x, y, (pb, pa_) in zip(b.tolist(), a.tolist(), m.tolist(), strict=True)) == sorted(want)


def test_gaps_are_aligned_with_fewest_edits():
    rng = np.random.default_rng(6)
    for _ in range(200):
        x, y = (rng.integers(0, 4, rng.integers(0, 12)).astype("<u4") for _ in range(2))
        cols = chaining._gap_columns(x, y)
        assert [i for i, _ in cols if i >= 0] == list(range(len(x))) and [j for _, j in cols if j >= 0] == list(range(len(y)))
        if len(x) == len(y):
            continue  # side by side
        row = list(range(len(y) + 1))
        for i, c in enumerate(x.tolist(), 1):
            up, row = row, [i]
            for j, d in enumerate(y.tolist(), 1):
                row.append(min(up[j - 1] + (c != d), up[j] + 1, row[j - 1] + 1))
        assert sum(i < 0 or j < 0 or x[i] != y[j] for i, j in cols) == row[-1]


def test_links_between_documents_whose_seeds_stand_elsewhere_first(spark):
    # every line, and every pair of neighbouring lines, stands first in a document of its own
    rng = random.Random(4)
    data, want = [], set()
    for i in range(6):
        lines = [prose(20_000 + 10 * i + k, 13) for k in range(5)]
        early = [lines[k:k + 2] for k in range(4)] + [[lines[x], lines[y]] for x in range(5) for y in range(x + 2, 5)]
        data += [(1000 * i + k, f"{prose(21_000 + 100 * i + k, 60)} {' '.join(two)} {prose(23_000 + 100 * i + k, 60)}") for k, two in enumerate(early)]
        data += [(1000 * i + k, f"{prose(25_000 + 100 * i + k, 70)} {' '.join(lines[:2])} {'odd ' * (k - 50)}{' '.join(lines[2:])} "
                                f"{prose(27_000 + 100 * i + k, 70)}") for k in (50, 51)]
        want.add((1000 * i + 51, 1000 * i + 50))
    rng.shuffle(data)
    got = fuzzy_passages(messy(spark, data)).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in got} == want
    assert all(r["class_id"] == r["other_doc_id"] and r["n_words"] >= 60 for r in got)


@pytest.mark.parametrize("block", [chaining.BLOCK, 8])
def test_contexts_of_a_seed_in_blocks_are_written_once(spark, monkeypatch, block):
    # a line of all documents; two and two share the words before it too, without five equal ones in a row
    line, data, want = prose(30_000, 30), [], set()
    for i in range(24):
        data.append((i, f"{prose(30_100 + i, 60)} {line} {prose(30_200 + i, 60)}"))
    for i in range(100, 112, 2):
        before = prose(30_300 + i, 40).split()
        edited = [f"odd{i}x{k}" if k % 5 == 4 else w for k, w in enumerate(before)]
        data += [(i, f"{prose(30_400 + i, 60)} {' '.join(before)} {line} {prose(30_500 + i, 60)}"),
                 (i + 1, f"{prose(30_600 + i, 60)} {' '.join(edited)} {line} {prose(30_700 + i, 60)}")]
        want.add((i + 1, i))
    kept, write = {}, chaining.materialize
    monkeypatch.setattr(chaining, "materialize", lambda df, name: kept.setdefault(name, write(df, name)) if name == "met" else write(df, name))
    monkeypatch.setattr(chaining, "BLOCK", block)
    got = fuzzy_passages(messy(spark, data)).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in got} == want and all(r["class_id"] == r["other_doc_id"] for r in got)
    parts = [pa.ipc.open_stream(bytes(r["payload"])).read_all() for r in kept["met"].where("kind = 6").collect()]
    contexts = [x for t in parts for x in zip(*(t.column(n).to_pylist() for n in ("hash", "did", "pos")), strict=True)]
    assert len(set(contexts)) == len(contexts)
    assert max(Counter(h for h, _, _ in contexts).values(), default=0) == (36 if block == 8 else 0)


def dense_diagonal(x, y):
    n, none = (np.r_[0, np.cumsum(z)] for z in (x == y, (x == 0) | (y == 0)))
    return any(((5 * (n[k:] - n[:-k]) >= 4 * k) & (none[k:] == none[:-k])).any() for k in range(MIN_WORDS, len(x) + 1))


def test_classes_of_contexts_against_brute_force():
    rng = np.random.default_rng(9)
    around, linked = chaining.AROUND, 0
    for _ in range(12):
        line = rng.integers(1, 2**32, 12)
        sources = rng.integers(1, 2**32, (3, chaining.SPAN))
        words = rng.integers(1, 2**32, (14, chaining.SPAN))
        for w in words:
            lo, hi = around - rng.integers(0, 60), around + 5 + rng.integers(0, 60)
            copy = sources[rng.integers(0, 3)].copy()
            odd = rng.random(len(copy)) < rng.choice([0, 0.1, 0.18])
            copy[odd] = rng.integers(1, 2**32, int(odd.sum()))
            w[lo:hi] = copy[lo:hi]
            w[around - 2:around + 10] = line
        words = words.astype("<u4")
        words[:, chaining.SPAN - around:] = 0
        many = rng.random(len(words)) < rng.choice([0, 0.3])
        near, far = [np.array([1, 2])] * len(words), [np.array([0, 5], "<i4")] * len(words)
        found = chaining.between_classes(np.zeros(len(words), int), None, words, np.arange(len(words)), near, far, many)
        up = np.arange(len(words))
        for i in range(len(words)):
            for j in range(i):
                if dense_diagonal(words[i], words[j]):
                    up[up == up[i]] = up[j]
        got = np.arange(len(words))
        for i, j, m in found:
            assert dense_diagonal(words[i], words[j]) and len(m)
            got[got == got[i]] = got[j]
        assert [[x == y for y in got] for x in got] == [[x == y for y in up] for x in up]
        linked += len(found)
    assert linked > 20


def test_contexts_of_one_line_are_not_confirmed_pair_by_pair(monkeypatch):
    # a line twice in every context, and the same words about it in another order
    rng = np.random.default_rng(11)
    around = chaining.AROUND
    line, some = rng.integers(1, 2**32, 8), rng.integers(1, 2**32, 120)
    words = np.array([rng.choice(some, chaining.SPAN) for _ in range(60)], "<u4")
    words[:, around:around + 8] = words[:, around + 30:around + 38] = line
    words[:, chaining.SPAN - around:] = 0
    words[59] = words[7]
    words[59, 100:290:20] = 5
    calls, confirm = [], chaining._confirm
    monkeypatch.setattr(chaining, "_confirm", lambda *a: calls.append(1) or confirm(*a))
    near, far = [np.array([1, 2, 1, 2])] * 60, [np.array([0, 3, 30, 33], "<i4")] * 60
    found = chaining.between_classes(np.zeros(60, int), None, words, np.arange(60), near, far, np.ones(60, bool))
    assert [{i, j} for i, j, _ in found] == [{7, 59}] and len(calls) < 10


def test_similar_contexts_against_brute_force():
    rng = np.random.default_rng(12)
    for q in range(20):
        n = int(rng.integers(2, 40))
        group, cls, odd = rng.integers(0, 3, n), rng.integers(0, 6, n), rng.random(n) < 0.4
        source = rng.integers(1, 2 + 10 * (q % 4) ** 4, 600)
        words = np.array([source[o:o + chaining.SPAN] for o in rng.integers(0, 600 - chaining.SPAN, n)]).astype("<u4")
        words[rng.random(words.shape) < rng.choice([0, 0.1, 0.4])] = 7
        words[rng.random(words.shape) < 0.01] = 0
        got = {(min(i, j), max(i, j)) for x, y in chaining._similar(group, words, cls, odd) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
        runs = [Counter(z for z in zip(w[:-2], w[1:-1], w[2:], strict=True) if all(z)) for w in words.tolist()]
        for i, j in combinations(range(n), 2):
            may = group[i] == group[j] and cls[i] != cls[j] and (odd[i] or odd[j])
            assert may or (i, j) not in got
            if may and (runs[i] & runs[j]).total() >= 18:
                assert (i, j) in got


def test_bounds_let_every_passage_through():
    rng = np.random.default_rng(13)
    for q in range(40):
        x, y = (rng.integers(1, 3 + 5 * q, chaining.SPAN).astype("<u4") for _ in range(2))
        copy = np.delete(x[60:130], rng.choice(70, int(rng.integers(0, 12)), replace=False))
        at = int(rng.integers(0, 200))
        y[at:at + len(copy)] = copy
        words, one, two = np.stack([x, y]), np.array([0]), np.array([1])
        m = np.array([(j, i) for i in range(len(x) - K + 1) for j in range(len(y) - K + 1) if (x[i:i + K] == y[j:j + K]).all()], _MATCH)
        bare = any(dense_stretches(align(x, y, c)[2]) for c in chains(m)) if len(m) else False
        (box,) = chaining._where_near(words[:1], words[1:])
        if bare:
            assert len(chaining._overlap(words, one, two)[0]) and box is not None and chaining._in_order(x.tolist(), y.tolist()) >= 40
        assert bare == (len(m) > 0 and box is not None and chaining._confirm(x, y, m, box))
