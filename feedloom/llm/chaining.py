"""Fuzzy passage dedup by collinear chaining.

1. Seeds: minimizers of word k-mers (K words; of each WINDOW consecutive
   k-mers the one with the smallest hash).
2. Join: every occurrence of a seed is matched with the seed's first
   occurrence, first within a partition of the documents, then between the
   partitions' firsts, so a seed that is everywhere costs one match an
   occurrence and is never gathered in one place.  Pairs of seeds that stand
   near each other and occur in several documents are matched in the same
   way: where the parts of a passage first occur in different documents, its
   pairs across parts first occur where the whole does.
3. Chain: per pair of documents the best chains of matches ascending in
   both, with a linear gap cost, found with a Fenwick tree over places in the
   earlier document.
4. Align: between matches the words are aligned, beyond them extended; the
   stretches in which at least SHARE of the columns agree and that are at
   least MIN_WORDS long are passages.  One that only pairs of seeds have led
   to is left out where another of the document holds all its words.
5. Rest: the passages so far give classes of documents.  All occurrences of a
   seed that stand in different classes meet with the words about them
   (``between_classes``), and what links two classes is chained and aligned
   like the rest, so that no link between classes is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (column, discard, documents, expand, groups, lean, materialize, merge_labels, mix, prepare, row_blocks, shingle_hashes, shuffle_width,
                     squeeze, text_rows, utf8_view, word_hashes)

K, WINDOW = 5, 8
MIN_WORDS, SHARE = 50, 0.8
#: Cost of a word skipped between two matches, against K for a match.
GAP_COST = 0.1
#: Matches that a chain needs, and words that an end is extended by.
MIN_SEEDS, EXTEND = 2, 64
#: Pairs of a document's shared seeds, by how many places they are apart in
#: their order; and the words that a pair spans at most.
REACH, PAIR_WORDS = (1, 2, 3, 5, 8), 64
#: Text whose seeds meet in one bucket, and text of one partition, on average.
BUCKET_BYTES, PART_BYTES = 8 << 20, 32 << 20
#: Words on either side of a seed by which classes are compared: a stretch of
#: twice MIN_WORDS or more has a shorter one in it.  What meets at once: the
#: occurrences of a block, and pairs of them.
AROUND, BLOCK, PAIRS = 2 * MIN_WORDS - 1, 4096, 1 << 14
SPAN = 3 * AROUND + K
#: Words left and right of a seed's first within which two contexts may agree
#: for no other reason than a line in common.
LINE = 10
#: Runs of three words of an odd context, of those it has in common with most,
#: by which others aren't looked up.
FREQUENT = 12
#: Pairs of contexts aligned at once, and what a word that agrees adds there
#: besides _WIN.
BATCH, EAGER = 64, 8
_NO_ID = np.iinfo(np.int64).max
#: What a column that agrees adds, and one that doesn't takes: 0 at SHARE.
_LOSE = Fraction(str(SHARE)).numerator
_WIN = Fraction(str(SHARE)).denominator - _LOSE
_SEED = np.dtype([("hash", "<u8"), ("doc", "<u4"), ("pos", "<u4"), ("span", "<u4")])
_MATCH = np.dtype([("b", "<u4"), ("a", "<u4")])
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_KINDS = "bucket int, kind int, payload binary"
_NAMES = ["bucket", "kind", "payload"]
_CONTEXT = ["hash", "block", "many", "did", "th", "cd", "ct", "pos", "words", "seeds", "far"]
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def minimizers(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the seeds of a word sequence; none below MIN_WORDS."""
    if len(w) < MIN_WORDS:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = shingle_hashes(w, K)
    view = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    at = np.unique(view.argmin(1) + np.arange(len(view)))
    return h[at], at


def _rows(bucket, kind: int, payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(bucket, np.int32)), pa.array(np.full(len(payload), kind, np.int32)),
                                       pa.array(payload, pa.binary())], names=_NAMES)


def _head(*n: int) -> bytes:
    return np.array(n, "<i8").tobytes()


def link_firsts(seeds: np.ndarray, did: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first occurrence of every seed; and the matches of all others with
    it: places, later document and earlier document.  A pair of seeds (span
    above 0) gives the matches of both."""
    order = np.lexsort((th, did))
    rank = np.empty(len(did), np.int64)
    # equal (id, text) is one document
    if len(did):
        new = np.r_[False, (did[order][1:] != did[order][:-1]) | (th[order][1:] != th[order][:-1])]
        rank[order] = np.cumsum(new)
    r = rank[seeds["doc"]]
    place, span = (r.astype(np.uint64) << np.uint64(32)) | seeds["pos"], np.ascontiguousarray(seeds["span"])
    order = np.lexsort((span, place)) if span.any() else np.argsort(place)
    s, r = seeds[order], r[order]
    # in this order the first occurrence of a hash has the least number
    h = np.ascontiguousarray(s["hash"])
    by = np.argsort(h)
    h = h[by]
    head = np.r_[True, h[1:] != h[:-1]] if len(s) else np.zeros(0, bool)
    first = np.minimum.reduceat(by, np.flatnonzero(head)) if len(s) else by
    at = first[np.cumsum(head) - 1] if len(s) else by
    pair = np.flatnonzero(r[by] != r[at])
    by, at = by[pair], at[pair]
    two = np.flatnonzero(s["span"][by])
    b, a = s[np.r_[by, by[two]]], s[np.r_[at, at[two]]]
    m = np.zeros(len(b), _MATCH)
    m["b"], m["a"] = b["pos"], a["pos"]
    m["b"][len(pair):] += b["span"][len(pair):]
    m["a"][len(pair):] += a["span"][len(pair):]
    return s[first], m, b["doc"].astype(np.int64), a["doc"].astype(np.int64)


def shared_seeds(seeds: np.ndarray, did: np.ndarray, th: np.ndarray) -> np.ndarray:
    """The occurrences of all seeds that several documents have."""
    _, doc = np.unique(np.stack([did, th], 1), axis=0, return_inverse=True)
    r = doc.ravel()[seeds["doc"]]
    by = np.argsort(seeds["hash"])
    s, r = seeds[by], r[by]
    head = np.flatnonzero(np.r_[True, s["hash"][1:] != s["hash"][:-1]])
    several = np.minimum.reduceat(r, head) != np.maximum.reduceat(r, head)
    return s[np.repeat(several, np.diff(np.r_[head, len(s)]))]


def pairs_near(seeds: np.ndarray) -> np.ndarray:
    """Pairs of the seeds of each document, REACH apart, as seeds with a span."""
    # a place of a document has one seed
    s = seeds[np.unique((seeds["doc"].astype(np.uint64) << np.uint64(32)) | seeds["pos"], return_index=True)[1]]
    out = []
    for far in REACH:
        x, y = s[:-far], s[far:]
        near = (x["doc"] == y["doc"]) & (y["pos"] - x["pos"] <= PAIR_WORDS) & (x["pos"] != y["pos"])
        x, y = x[near], y[near]
        p = np.zeros(len(x), _SEED)
        p["hash"], p["doc"], p["pos"], p["span"] = mix(x["hash"] * np.uint64(3) + mix(y["hash"])), x["doc"], x["pos"], y["pos"] - x["pos"]
        out.append(p)
    return np.concatenate(out)


def _pair_parcels(m: np.ndarray, b: np.ndarray, a: np.ndarray, did: np.ndarray, th: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """kind 1: matches packed by a hash of their pair of documents."""
    if not len(m):
        return
    with np.errstate(over="ignore"):
        names = mix(did.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th.astype(np.uint64))
        home = (mix(names[b] * np.uint64(3) + names[a]) % np.uint64(width)).astype(np.int64)
    homes, parts = groups(home, np.arange(len(m)))
    rows = []
    for p in parts:
        docs, at = np.unique(np.concatenate([b[p], a[p]]), return_inverse=True)
        rows.append(_head(len(docs), len(p)) + squeeze(did[docs].astype("<i8"), th[docs].astype("<i8"), at[:len(p)].astype("<u4"),
                                                       at[len(p):].astype("<u4"), m["b"][p], m["a"][p]))
    yield _rows(homes, 1, rows)


def _seed_parcels(s: np.ndarray, kind: int, home: np.ndarray, did: np.ndarray, th: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Seeds packed by their homes."""
    if not len(s):
        return
    homes, packets = groups(home.astype(np.int64), s)
    rows = []
    for p in packets:
        names, local = np.unique(p["doc"], return_inverse=True)
        rows.append(_head(len(names), len(p)) + squeeze(did[names].astype("<i8"), th[names].astype("<i8"), p["hash"],
                                                        local.astype("<u4"), p["pos"], p["span"]))
    yield _rows(homes, kind, rows)


def _open_seeds(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of all parcels, and the names of their documents."""
    dids, ths, parts, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, _SEED)], 0
    for p in payloads:
        names, n = np.frombuffer(p, "<i8", 2).tolist()
        did, th, h, doc, pos, span = expand(p[16:], ("<i8", names), ("<i8", names), ("<u8", n), ("<u4", n), ("<u4", n), ("<u4", n))
        s = np.zeros(n, _SEED)
        s["hash"], s["doc"], s["pos"], s["span"] = h, doc + docs, pos, span
        dids.append(did)
        ths.append(th)
        parts.append(s)
        docs += names
    return np.concatenate(parts), np.concatenate(dids), np.concatenate(ths)


def _shared_parcels(seeds: np.ndarray, did: np.ndarray, th: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """kind 2: shared seeds packed by a hash of their document."""
    s = shared_seeds(seeds, did, th)
    with np.errstate(over="ignore"):
        names = mix(did.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th.astype(np.uint64))
    yield from _seed_parcels(s, 2, names[s["doc"]] % np.uint64(width), did, th)


def _other_places(seeds: np.ndarray) -> np.ndarray:
    """Of each seed that one document alone has, the occurrences but the first."""
    s = seeds[np.lexsort((seeds["pos"], seeds["doc"], seeds["hash"]))]
    again = np.r_[False, s["hash"][1:] == s["hash"][:-1]] if len(s) else np.zeros(0, bool)
    head = np.flatnonzero(~again)
    if not len(head):
        return s
    one = np.minimum.reduceat(s["doc"], head) == np.maximum.reduceat(s["doc"], head)
    return s[np.repeat(one, np.diff(np.r_[head, len(s)])) & again]


def _seeds_of(width: int):
    """All seeds of a partition: matches among them (kind 1), those that are
    shared (kind 2) and their firsts, packed by a hash of the seed (kind 0);
    also the other places of a seed of one document (kind 4)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dids, ths, parts, docs = [], [], [], 0
        for b in batches:
            data, off = utf8_view(column(b, "text"))
            dids.append(column(b, "did").to_numpy())
            ths.append(column(b, "th").to_numpy())
            for lo, hi in row_blocks(off, 1 << 20):
                w, first = word_hashes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                for i in range(hi - lo):
                    h, at = minimizers(w[first[i]:first[i + 1]])
                    if len(h):
                        s = np.zeros(len(h), _SEED)
                        s["hash"], s["doc"], s["pos"] = h, docs + lo + i, at
                        parts.append(s)
            docs += b.num_rows
        if not parts:
            return
        did, th = np.concatenate(dids), np.concatenate(ths)
        seeds = np.concatenate(parts)
        firsts, m, later, earlier = link_firsts(seeds, did, th)
        yield from _pair_parcels(m, later, earlier, did, th, width)
        yield from _shared_parcels(seeds, did, th, width)
        yield from _seed_parcels(firsts, 0, firsts["hash"] % np.uint64(width), did, th)
        more = _other_places(seeds)
        yield from _seed_parcels(more, 4, more["hash"] % np.uint64(width), did, th)
    return run


def _link_bucket(width: int, shared: bool):
    """Matches between the partitions' firsts of a bucket; and the seeds that
    are shared (kind 2, other places kind 5), if asked for."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        out = [table.filter(pa.array((kind != 0) & (kind != 4))).select(_NAMES)]
        seeds, did, th = _open_seeds(table.filter(pa.array(kind == 0)).column("payload").to_pylist())
        if len(seeds):
            _, m, later, earlier = link_firsts(seeds, did, th)
            out += [pa.Table.from_batches([x]) for x in _pair_parcels(m, later, earlier, did, th, width)]
            if shared:
                out += [pa.Table.from_batches([x]) for x in _shared_parcels(seeds, did, th, width)]
                known = np.unique(shared_seeds(seeds, did, th)["hash"])
                more, did, th = _open_seeds(table.filter(pa.array(kind == 4)).column("payload").to_pylist())
                more = more[np.isin(more["hash"], known)]
                out += [pa.Table.from_batches([x]) for x in _seed_parcels(more, 5, more["hash"] % np.uint64(width), did, th)]
        return pa.concat_tables(out)
    return run


def _pairs_of(width: int):
    """Pairs of the shared seeds of a home's documents: matches among them
    (kind 1) and their firsts (kind 0)."""
    def run(table: pa.Table) -> pa.Table:
        seeds, did, th = _open_seeds(table.column("payload").to_pylist())
        # the parcels of a document name it anew each
        names, doc = np.unique(np.stack([did, th], 1), axis=0, return_inverse=True)
        seeds["doc"] = doc.ravel()[seeds["doc"]]
        did, th = names[:, 0], names[:, 1]
        firsts, m, later, earlier = link_firsts(pairs_near(seeds), did, th)
        m, later, earlier = _distinct(m, later, earlier)
        out = [*_pair_parcels(m, later, earlier, did, th, width), *_seed_parcels(firsts, 0, firsts["hash"] % np.uint64(width), did, th)]
        return pa.Table.from_batches(out, _SCHEMA)
    return run


def _distinct(m: np.ndarray, b: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each match of two documents once."""
    by = np.lexsort((m["a"], m["b"], a, b))
    m, b, a = m[by], b[by], a[by]
    keep = np.r_[True, (m[1:] != m[:-1]) | (b[1:] != b[:-1]) | (a[1:] != a[:-1])] if len(m) else np.zeros(0, bool)
    return m[keep], b[keep], a[keep]


def _open_pairs(table: pa.Table) -> pa.Table:
    """The matches of each pair of documents of a home with MIN_SEEDS or more;
    ``extra``: fewer without those of pairs of seeds (kind 3)."""
    cols: list[list] = [[] for _ in range(7)]
    for kind, p in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
        names, n = np.frombuffer(p, "<i8", 2).tolist()
        did, th, b, a, pb, pa_ = expand(p[16:], ("<i8", names), ("<i8", names), ("<u4", n), ("<u4", n), ("<u4", n), ("<u4", n))
        for c, x in zip(cols, (did[b], th[b], did[a], th[a], pb, pa_, np.full(n, kind == 1)), strict=True):
            c.append(x)
    bd, bt, ad, at, pb, pa_, single = (np.concatenate(c) for c in cols)
    _, first, pair = np.unique(np.stack([bd, bt, ad, at], 1), axis=0, return_index=True, return_inverse=True)
    m = np.zeros(len(pb), _MATCH)
    m["b"], m["a"] = pb, pa_
    pairs, parts = groups(pair.ravel(), m)
    extra = np.bincount(pair.ravel(), single) < MIN_SEEDS
    keep = [i for i, x in enumerate(parts) if len(x) >= MIN_SEEDS]
    f = first[pairs[keep]] if keep else np.zeros(0, np.int64)
    return pa.table({"bd": pa.array(bd[f]), "bt": pa.array(bt[f]), "ad": pa.array(ad[f]), "at": pa.array(at[f]),
                     "extra": pa.array(extra[pairs[keep]] if keep else np.zeros(0, bool)),
                     "matches": pa.array([parts[i].tobytes() for i in keep], pa.binary())})


# ------------------------------------------------------------ chains
def chains(m: np.ndarray) -> list[np.ndarray]:
    """Disjoint chains of matches, best first; each ascends in both places.

    score(j) = K + max over i before j of score(i) - GAP_COST * (skipped
    words), which splits into a term of i alone: a Fenwick tree over ``a``
    holds the prefix maxima."""
    key = np.unique((m["b"].astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - m["a"]))
    m = np.empty(len(key), _MATCH)
    m["b"], m["a"] = key >> np.uint64(32), np.uint64(0xFFFFFFFF) - (key & np.uint64(0xFFFFFFFF))
    step = np.diff(m["a"].astype(np.int64)), np.diff(m["b"].astype(np.int64))
    if (step[0] > 0).all() and (step[1] > 0).all() and ((step[0] + step[1]) * (GAP_COST / 2) < K - 1e-6).all():
        # each match extends the one before it at a gain: one chain of all
        return [m] if len(m) >= MIN_SEEDS else []
    values = np.unique(m["a"])
    rank = (np.searchsorted(values, m["a"]) + 1).tolist()
    size = len(values)
    tree_v, tree_i = [-1e18] * (size + 1), [-1] * (size + 1)
    place = ((m["a"].astype(np.int64) + m["b"].astype(np.int64)) * (GAP_COST / 2)).tolist()
    score, back = [0.0] * len(m), [-1] * len(m)
    for j, r in enumerate(rank):
        best, who = -1e18, -1
        i = r - 1
        while i > 0:
            if tree_v[i] > best:
                best, who = tree_v[i], tree_i[i]
            i -= i & -i
        got = best - place[j]
        score[j], back[j] = (K + got, who) if got > 0 else (float(K), -1)
        v = score[j] + place[j]
        i = r
        while i <= size:
            if v > tree_v[i]:
                tree_v[i], tree_i[i] = v, j
            i += i & -i
    used = [False] * len(m)
    out = []
    for j in sorted(range(len(m)), key=lambda x: (-score[x], x)):
        c = []
        while j >= 0 and not used[j]:
            used[j] = True
            c.append(j)
            j = back[j]
        if len(c) >= MIN_SEEDS:
            out.append(m[c[::-1]])
    return out


def _chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        names = list(zip(*(column(b, n).to_pylist() for n in ("bd", "bt", "ad", "at", "extra")), strict=True))
        for name, m in zip(names, column(b, "matches").to_pylist(), strict=True):
            rows += [(*name, c.tobytes()) for c in chains(np.frombuffer(m, _MATCH))]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.bool_()),
                                              pa.array(cols[5], pa.binary())], names=["bd", "bt", "ad", "at", "extra", "chain"])


# ------------------------------------------------------------ classes
def _open_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds of parcels, a row each."""
    for b in batches:
        for p in column(b, "payload").to_pylist():
            s, did, th = _open_seeds([p])
            yield pa.RecordBatch.from_arrays([pa.array(s["hash"].view(np.int64)), pa.array(did[s["doc"]]), pa.array(th[s["doc"]]),
                                              pa.array(s["pos"].astype(np.int32))], names=["hash", "did", "th", "pos"])


def contexts(words: np.ndarray, pos: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], np.ndarray]:
    """The contexts of a document's seeds (places ascending), those that repeat
    once.  A context begins AROUND words before a place and holds all places of
    its seed up to AROUND words on, with AROUND words behind each.  Given back:
    the first place; the words (0: none); the seeds in it; and whether its own
    has several places."""
    room = np.zeros(len(words) + SPAN, "<u4")
    room[AROUND:AROUND + len(words)] = words
    seen, to, keep, near, several = set(), {}, [], [], {}
    first, last = np.searchsorted(pos, pos - AROUND), np.searchsorted(pos, pos + 2 * AROUND, "right")
    for i, (at, h, lo, hi) in enumerate(zip(pos.tolist(), seed.tolist(), first.tolist(), last.tolist(), strict=True)):
        if h in to and at <= to[h][0] + AROUND:
            several[to[h][1]] = True
            continue
        to[h] = at, i
        name = (h, room[at:at + SPAN].tobytes(), (pos[lo:hi] - at).tobytes(), seed[lo:hi].tobytes())
        if name not in seen:
            seen.add(name)
            keep.append(i)
            near.append((lo, hi))
    return np.array(keep, np.int64), np.lib.stride_tricks.sliding_window_view(room, SPAN)[pos[keep]], near, \
        np.array([i in several for i in keep], bool)


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of a shared seed: the words about it, and the seeds near it."""
    for b in batches:
        for places, w, *name in zip(*(column(b, n) for n in ("places", "words", "did", "th", "cd", "ct")), strict=True):
            flat = places.values
            pos, seed, n = (flat.field(k).to_numpy() for k in range(3))
            # parcels may name a place twice
            pos, by = np.unique(pos.astype(np.int64), return_index=True)
            seed, n = seed[by], n[by]
            keep, words, near, many = contexts(np.frombuffer(w.as_py(), "<u4"), pos, seed)
            for lo in range(0, len(keep), BLOCK):
                k = keep[lo:lo + BLOCK]
                seeds = [seed[x:y].tobytes() for x, y in near[lo:lo + BLOCK]]
                far = [(pos[x:y] - p).astype("<i4").tobytes() for (x, y), p in zip(near[lo:lo + BLOCK], pos[k], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[k]), pa.array(n[k]), pa.array(many[lo:lo + BLOCK]), *[pa.array(np.full(len(k), x.as_py())) for x in name], pa.array(pos[k]),
                     pa.array([x.tobytes() for x in words[lo:lo + BLOCK]], pa.binary()), pa.array(seeds, pa.binary()), pa.array(far, pa.binary())],
                    names=["hash", "n", "many", "did", "th", "cd", "ct", "pos", "words", "seeds", "far"])


def _alike(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs of contexts that have a stretch of SHARE, laid side by side."""
    x, y = (words[k, :2 * AROUND + K] for k in (i, j))
    score = np.where(x == y, np.int32(_WIN), np.int32(-_LOSE))
    score[(x == 0) | (y == 0)] = -_LOSE * SPAN
    run = np.zeros((len(x), x.shape[1] + 1), np.int32)
    np.cumsum(score, axis=1, out=run[:, 1:])
    good = (run[:, MIN_WORDS:] >= np.minimum.accumulate(run[:, :-MIN_WORDS], axis=1)).any(1)
    return i[good], j[good]


def _numbered(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each context's runs of ``size`` words, ascending; the k-th of
    equal ones has a hash of its own, and one that isn't whole 0."""
    n = words.shape[1] - size + 1
    z = np.zeros((len(words), n), np.uint64)
    whole = np.ones(z.shape, bool)
    for j in range(size):
        z = z * np.uint64(0x9E3779B97F4A7C15) + words[:, j:j + n]
        whole &= words[:, j:j + n] != 0
    z = np.where(whole, mix(z + np.uint64(size)), np.uint64(0))
    z.sort(axis=1)
    new = np.ones(z.shape, bool)
    new[:, 1:] = z[:, 1:] != z[:, :-1]
    at = np.arange(n)
    k = at - np.maximum.accumulate(np.where(new, at, 0), axis=1)
    z = np.where(z == 0, np.uint64(0), mix(z + k.astype(np.uint64)))
    z.sort(axis=1)
    return z


def _least(size: int) -> int:
    """Runs of ``size`` words that two texts with a passage have in common: the
    words that agree in it, in one run more than there are others."""
    odd = MIN_WORDS * _WIN // (_WIN + _LOSE)
    return MIN_WORDS - odd - (size - 1) * (odd + 1)


def _overlap(words: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs of contexts with as many words and pairs of words in common as a passage has."""
    for size in (1, 2):
        some, at = np.unique(np.r_[i, j], return_inverse=True)
        numbers = _numbered(words[some], size)
        z = np.sort(np.concatenate([numbers[at[:len(i)]], numbers[at[len(i):]]], axis=1), axis=1)
        good = ((z[:, 1:] == z[:, :-1]) & (z[:, 1:] > 0)).sum(1) >= _least(size)
        i, j = i[good], j[good]
    return i, j


def _in_order(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence, a bit a word of ``x``."""
    at: dict[int, int] = {}
    for i, w in enumerate(x):
        at[w] = at.get(w, 0) | 1 << i
    full = rest = (1 << len(x)) - 1
    for w in y:
        if m := at.get(w):
            u = rest & m
            rest = ((rest + u) | (rest - u)) & full
    return len(x) - rest.bit_count()


def _where_near(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int] | None]:
    """For each pair of contexts, where passages of any alignment may end: first
    and last word of either; None if nowhere.  The words of a passage that
    agree, at a gain of _WIN + EAGER, and the others come to EAGER for each word
    that has to agree, or more, and so does the best local alignment there."""
    win, lose, need = np.int16(_WIN + EAGER), np.int16(_LOSE), EAGER * _least(1)
    drop = np.arange(y.shape[1] + 1, dtype=np.int16) * lose
    score = np.zeros((len(x), len(drop)), np.int16)
    here = np.zeros(x.shape, bool), np.zeros(y.shape, bool)
    for i, w in enumerate(x.T):
        got = np.maximum(score - lose, np.int16(0))
        step = score[:, :-1] + np.where((y == w[:, None]) & (y != 0), win, -lose)
        np.maximum(got[:, 1:], step, out=got[:, 1:])
        got += drop
        np.maximum.accumulate(got, axis=1, out=got)
        score = got - drop
        hot = score[:, 1:] >= need
        here[0][:, i] = hot.any(1)
        here[1][:] |= hot
    out: list[tuple[int, int, int, int] | None] = []
    for a, b in zip(*here, strict=True):
        a, b = np.flatnonzero(a), np.flatnonzero(b)
        out.append((int(a[0]), int(a[-1]), int(b[0]), int(b[-1])) if len(a) else None)
    return out


def _on_one_line(x: np.ndarray, y: np.ndarray, c: list[np.ndarray]) -> bool:
    """Does a chain of matches of one distance have a passage about it?  Like
    ``dense_stretches`` of its alignment, of all such chains at once."""
    if not c:
        return False
    a, b, end = (np.array(v, np.int64)[:, None] for v in zip(*((m["a"][0], m["b"][0], m["a"][-1]) for m in c), strict=True))
    at = np.arange(-EXTEND, int((end - a).max()) + K + EXTEND)[None, :]
    i, j = a + at, b + at
    inside = (i >= 0) & (j >= 0) & (i < len(x)) & (j < len(y)) & (i < end + K + EXTEND)
    same = x[np.where(inside, i, 0)] == y[np.where(inside, j, 0)]
    score = np.where(inside, np.where(same, _WIN, -_LOSE), -_LOSE * at.shape[1])
    run = np.zeros((len(c), at.shape[1] + 1), np.int64)
    np.cumsum(score, axis=1, out=run[:, 1:])
    return bool((run[:, MIN_WORDS:] >= np.minimum.accumulate(run[:, :-MIN_WORDS], axis=1)).any())


def _confirm(x: np.ndarray, y: np.ndarray, m: np.ndarray, box: tuple[int, int, int, int]) -> bool:
    """Do matches (places in two contexts) lead to a passage?  One can only end
    in ``box`` (``_where_near``)."""
    lo_x, lo_y = int(np.argmax(x != 0)), int(np.argmax(y != 0))
    x, y = x[x != 0], y[y != 0]
    m = m.copy()
    m["a"] -= lo_x
    m["b"] -= lo_y
    straight, bent = [], []
    for c in chains(m[(m["a"] + K <= len(x)) & (m["b"] + K <= len(y))]):
        a, b = c["a"].astype(np.int64), c["b"].astype(np.int64)
        # what its alignment can reach
        if a[0] - EXTEND <= box[1] - lo_x and a[-1] + K + EXTEND > box[0] - lo_x and b[0] - EXTEND <= box[3] - lo_y and b[-1] + K + EXTEND > box[2] - lo_y:
            (straight if (a - b == a[0] - b[0]).all() else bent).append(c)
    return _on_one_line(x, y, straight) or any(dense_stretches(align(x, y, c)[2]) for c in bent)


class _Classes:
    """Numbered classes that are merged."""
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return int(x)

    def flat(self) -> np.ndarray:
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]
        return self.up


def _spread(start: np.ndarray, end: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ranges start..end, about ``limit`` entries at a time: number of the
    range and entry."""
    n = end - start
    to = np.cumsum(n)
    for lo in range(0, int(to[-1]) if len(to) else 0, limit):
        t = np.arange(lo, min(lo + limit, int(to[-1])))
        k = np.searchsorted(to, t, "right")
        yield k, start[k] + t - (to - n)[k]


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal entries begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _ends(head: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` entries the end of its run."""
    end = np.r_[head[1:], n]
    return np.repeat(end, end - head)


def _candidates(key: np.ndarray, item: np.ndarray, classes: _Classes, cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of one key in different classes: first those with a
    key's first entry, then all that the classes found by then leave."""
    by = np.argsort(key, kind="stable")
    for leaders in (True, False):
        c = classes.flat()[cls[item[by]]]
        order = np.lexsort((c, key[by]))
        by, c = by[order], c[order]
        k = key[by]
        head, n = _heads(k), len(by)
        if not n:
            return
        last = _ends(head, n)
        own = _ends(_heads(k, c), n)
        here = np.flatnonzero(own < last)
        if leaders:
            here = here[np.isin(here, head)]
        for x, y in _spread(own[here], last[here], 16 * PAIRS):
            yield by[here[x]], by[y]


def _odd(group: np.ndarray, rows: np.ndarray, key: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Contexts in which a seed has several places, or another seed (entries
    ``rows``, ``key``, ``at``) is not as far away as in most of the group."""
    odd = many.copy()
    k = mix(mix(key) + group[rows])
    by = np.lexsort((at, k))
    k, at, rows = k[by], at[by], rows[by]
    head = _heads(k, at)
    size = np.diff(np.r_[head, len(k)])
    # the most frequent distance of each seed
    order = np.lexsort((-size, k[head]))
    usual = np.zeros(len(head), bool)
    usual[order[_heads(k[head][order])]] = True
    odd[rows[~np.repeat(usual, size)]] = True
    return odd


def _similar(group: np.ndarray, words: np.ndarray, cls: np.ndarray, odd: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of contexts of a group, of different classes and one of them odd,
    with as many runs of three words in common as a passage has.  The FREQUENT
    ones of an odd context that most others have aren't looked up."""
    c, g = (np.unique(x, return_inverse=True)[1].ravel() for x in (cls, group))
    head = np.lexsort((c, g))
    several = np.zeros(int(g.max()) + 1, bool)
    several[g[head][1:][(g[head][1:] == g[head][:-1]) & (c[head][1:] != c[head][:-1])]] = True
    rare = np.zeros(len(several), bool)
    rare[g[odd]] = True
    here = np.flatnonzero((several & rare)[g])
    if not len(here):
        return
    here = here[np.argsort(g[here], kind="stable")]
    # whole groups, as many as two blocks have contexts
    head = _heads(g[here])
    part = head // (2 * BLOCK)
    for lo, hi in zip((p := head[_heads(part)]), np.r_[p[1:], len(here)], strict=True):
        some = here[lo:hi]
        for i, j in _in_common(np.unique(g[some], return_inverse=True)[1].ravel(), words[some], c[some], odd[some]):
            yield some[i], some[j]


def _in_common(g: np.ndarray, words: np.ndarray, c: np.ndarray, odd: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_similar`` pairs of contexts in order of their group."""
    z = _numbered(words, 3)
    row, col = np.nonzero(z)
    key = mix(z[row, col] + mix(g[row].astype(np.uint64) + np.uint64(1)))
    # contexts by run of words and class
    by = np.lexsort((c[row], key))
    key, row = key[by], row[by]
    heads, own = _heads(key), _heads(key, c[row])
    first = np.repeat(heads, np.diff(np.r_[heads, len(key)]))
    last, start, end = _ends(heads, len(key)), np.repeat(own, np.diff(np.r_[own, len(key)])), _ends(own, len(key))
    ask = np.flatnonzero(odd[row] & (last - first > end - start))
    ask = ask[np.lexsort((first[ask] - last[ask], row[ask]))]
    # those of an odd context, the most frequent first
    mine = _heads(row[ask])
    ask = ask[np.arange(len(ask)) - np.repeat(mine, np.diff(np.r_[mine, len(ask)])) >= FREQUENT]
    if not len(ask):
        return
    size = np.bincount(g)
    base = np.r_[0, np.cumsum(size)][:-1]
    asks = row[ask]
    cost = np.cumsum(last[ask] - first[ask] + size[g[asks]])
    mine = _heads(asks)
    # odd contexts at a time
    part = cost[mine] // (128 * PAIRS)
    for lo, hi in zip((p := _heads(part)), np.r_[p[1:], len(mine)], strict=True):
        a, b = mine[lo], mine[hi] if hi < len(mine) else len(ask)
        some = ask[a:b]
        who = np.unique(asks[a:b])
        room = np.cumsum(np.r_[0, size[g[who]]])
        slot = np.searchsorted(who, row[some])
        count = np.zeros(int(room[-1]), np.int32)
        for s, e in ((first, start), (end, last)):
            for x, y in _spread(s[some], e[some], 64 * PAIRS):
                to = room[slot[x]] + row[y] - base[g[row[y]]]
                count += np.bincount(to, minlength=len(count)).astype(np.int32)
        hit = np.flatnonzero(count >= _least(3) - FREQUENT)
        x = np.searchsorted(room, hit, "right") - 1
        i, j = who[x], base[g[who[x]]] + hit - room[x]
        # of two odd ones either or both may have asked
        pair = np.unique(np.minimum(i, j) * len(g) + np.maximum(i, j))
        yield pair // len(g), pair % len(g)


def between_classes(group: np.ndarray, block: np.ndarray | None, words: np.ndarray, cls: np.ndarray, near: list[np.ndarray], far: list[np.ndarray],
                    many: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Links between classes among the contexts of each group (seed): pairs
    (i, j) of contexts and the matches in them, j's in "b"; enough of them to
    join all classes that any pair of contexts with a passage joins.

    A passage has a stretch of MIN_WORDS to twice as many words.  With all its
    matches at one distance, two words beside each other agree there outside
    the LINE about the seed (at MIN_WORDS 50 and SHARE 0.8 at least 15 words
    agree there, in 12 runs at most), so contexts meet by such words and their
    place.  With several distances, two contexts share another seed at
    different places, so that one of them is ``_odd``; so is one in which its seed has
    several places (``many``).  Odd contexts meet those that have the runs of
    words of a passage in common with them (``_similar``)."""
    classes = _Classes(int(cls.max()) + 1)
    n, out = len(group), []

    def settle(i: np.ndarray, j: np.ndarray, test) -> None:
        for lo in range(0, len(i), PAIRS):
            x, y = i[lo:lo + PAIRS], j[lo:lo + PAIRS]
            c = classes.flat()
            other = c[cls[x]] != c[cls[y]]
            if block is not None:
                other &= block[x] != block[y]
            x, y = test(words, x[other], y[other]) if other.any() else (x[:0], y[:0])
            for at in range(0, len(x), BATCH):
                some = []
                for p, q in zip(x[at:at + BATCH].tolist(), y[at:at + BATCH].tolist(), strict=True):
                    if classes.root(cls[p]) == classes.root(cls[q]):
                        continue
                    # every place of a seed near one with every place of it near the other
                    u, v = np.nonzero(near[p][:, None] == near[q][None, :])
                    # no alignment has more equal columns
                    if len(u) >= MIN_SEEDS and _in_order(words[p][words[p] != 0].tolist(), words[q][words[q] != 0].tolist()) >= _least(1):
                        some.append((p, q, u, v))
                for (p, q, u, v), box in zip(some, _where_near(words[[z[0] for z in some]], words[[z[1] for z in some]]), strict=True):
                    if box is None or classes.root(cls[p]) == classes.root(cls[q]):
                        continue
                    m = np.zeros(len(u), _MATCH)
                    m["a"], m["b"] = far[p][u] + AROUND, far[q][v] + AROUND
                    if _confirm(words[p], words[q], m, box):
                        classes.up[classes.root(cls[p])] = classes.root(cls[q])
                        out.append((p, q, m))

    def once(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = np.unique(np.minimum(i, j) * n + np.maximum(i, j))
        return pair // n, pair % n

    g = mix(group.astype(np.uint64) + np.uint64(1))
    alone = np.flatnonzero(~many)
    places = np.r_[0:AROUND - LINE, AROUND + K + LINE:2 * AROUND + K - 1]
    one, two = words[alone][:, places], words[alone][:, places + 1]
    rows, col = np.nonzero((one != 0) & (two != 0))
    key = mix(mix(one[rows, col].astype(np.uint64) << np.uint64(32) | two[rows, col]) + g[alone[rows]] * np.uint64(2 * SPAN + 1) + col.astype(np.uint64))
    rows = alone[rows]
    for x, y in _candidates(key, rows, classes, cls):
        settle(*once(rows[x], rows[y]), _alike)
    rows, at = np.repeat(np.arange(n), [len(x) for x in near]), np.concatenate(far)
    key, ahead = np.concatenate(near).view(np.uint64), (at > 0) & ~many[rows]
    odd = _odd(g, rows[ahead], key[ahead], at[ahead], many)
    for x, y in _similar(group, words, classes.flat()[cls], odd):
        settle(x, y, _overlap)
    return out


def _rank(*names: np.ndarray) -> np.ndarray:
    return np.unique(np.stack(names, 1), axis=0, return_inverse=True)[1].ravel()


def _link_classes(table: pa.Table, width: int, apart: bool) -> pa.Table:
    """Matches (kind 1) between classes, of the contexts of each block of a
    seed; ``apart``: of those of different blocks, of one seed."""
    hash_, block, did, th, cd, ct, pos = (table.column(n).to_numpy() for n in ("hash", "block", "did", "th", "cd", "ct", "pos"))
    words = np.frombuffer(b"".join(table.column("words").to_pylist()), "<u4").reshape(-1, SPAN)
    near = [np.frombuffer(x, "<i8") for x in table.column("seeds").to_pylist()]
    far = [np.frombuffer(x, "<i4") for x in table.column("far").to_pylist()]
    group = _rank(hash_) if apart else _rank(hash_, block)
    found = between_classes(group, block if apart else None, words, _rank(cd, ct), near, far, table.column("many").to_numpy())
    if not found:
        return _SCHEMA.empty_table()
    m, b, a = [], [], []
    for i, j, x in found:
        x = x.copy()
        x["a"] += np.uint32(pos[i])
        x["b"] += np.uint32(pos[j])
        x["a"] -= np.uint32(AROUND)
        x["b"] -= np.uint32(AROUND)
        if (did[i], th[i]) > (did[j], th[j]):
            i, j = j, i
            x["a"], x["b"] = x["b"].copy(), x["a"].copy()
        m.append(x)
        b.append(np.full(len(x), j))
        a.append(np.full(len(x), i))
    m, b, a = _distinct(np.concatenate(m), np.concatenate(b), np.concatenate(a))
    return pa.Table.from_batches(list(_pair_parcels(m, b, a, did, th, width)), _SCHEMA)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _meet_at_home(width: int):
    """Matches (kind 1) within the blocks of a home; and each block of a seed
    that has several, as one row (kind 6)."""
    def run(table: pa.Table) -> pa.Table:
        matches = _link_classes(table, width, False)
        hot = np.flatnonzero(table.column("blocks").to_numpy() > 1)
        hash_, block = (table.column(n).to_numpy()[hot] for n in ("hash", "block"))
        parts = groups(_rank(hash_, block), np.arange(len(hot)))[1] if len(hot) else []
        rows = [_packed(table.select(_CONTEXT).take(pa.array(hot[x]))) for x in parts]
        out = _SCHEMA.empty_table() if not rows else pa.Table.from_batches([_rows(np.zeros(len(rows)), 6, rows)])
        first = [x[0] for x in parts]
        n = len(matches)
        return pa.concat_tables([matches, out]).append_column("hash", pa.array(np.r_[np.zeros(n, np.int64), hash_[first]])) \
            .append_column("block", pa.array(np.r_[np.zeros(n, np.int64), block[first]]))
    return run


def _meet_blocks(width: int):
    """Matches (kind 1) between two blocks of a seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for two in zip(column(b, "part"), column(b, "other"), strict=True):
                table = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in two])
                yield from _link_classes(table, width, True).to_batches()
    return run


def _class_matches(links: DataFrame, words: DataFrame, labels: DataFrame, width: int) -> DataFrame:
    """Matches of documents of different classes (``labels``: document, class).

    A context is shuffled once.  The blocks of a seed that has several are
    written once too, and pairs of them are read side by side."""
    spark = links.sparkSession
    here = links.where("kind in (2, 5)").mapInArrow(lean(_open_places), "hash long, did long, th long, pos int") \
        .join(labels.select("node.*", F.col("comp.did").alias("cd"), F.col("comp.th").alias("ct")), ["did", "th"], "left") \
        .select("hash", "did", "th", "pos", F.coalesce("cd", "did").alias("cd"), F.coalesce("ct", "th").alias("ct"))
    here = materialize(here, "places")
    discard(links)
    name = F.struct("cd", "ct")
    several = materialize(here.groupBy("hash").agg(F.min(name).alias("lo"), F.max(name).alias("hi"), F.count("*").alias("n"))
                          .where("lo <> hi").select("hash", "n"), "several")
    homes = (several.agg(F.sum("n").alias("n")).head()["n"] or 0) * 4 * SPAN // BUCKET_BYTES + 1
    block = F.pmod(F.xxhash64("did", "th", "pos"), F.col("blocks"))
    met = here.join(several, "hash").groupBy("did", "th", "cd", "ct").agg(F.collect_list(F.struct("pos", "hash", "n")).alias("places")) \
        .join(words, ["did", "th"]) \
        .mapInArrow(lean(_cut_contexts), "hash long, n long, many boolean, did long, th long, cd long, ct long, pos long, words binary, seeds binary, far binary") \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("block", block).drop("n") \
        .groupBy(F.pmod(F.xxhash64("hash", "block", "block"), F.lit(homes))).applyInArrow(_meet_at_home(width), f"{_KINDS}, hash long, block long")
    met = materialize(met, "met")
    discard(here)
    discard(several)
    out, packed = met.where("kind = 1").select(_NAMES), met.where("kind = 6")
    parts = min(packed.count(), math.isqrt(32 * shuffle_width(spark)) + 1)
    if not parts:
        return out
    # every part of one side is read beside every part of the other; no pair is written
    one, two = (packed.select("hash", F.col("block").alias(x), F.col("payload").alias(y)).repartition(parts) for x, y in (("lo", "part"), ("hi", "other")))
    pairs = one.hint("shuffle_replicate_nl").join(two, (one["hash"] == two["hash"]) & (one["lo"] < two["hi"])).select("part", "other")
    return out.union(pairs.mapInArrow(lean(_meet_blocks(width)), _KINDS))


# ------------------------------------------------------------ alignment
def _word_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of each text, 32 bits a word."""
    for b in batches:
        data, off = utf8_view(column(b, "text"))
        out = []
        for lo, hi in row_blocks(off, 1 << 20):
            w, first = word_hashes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            small = (w >> np.uint64(32)).astype("<u4")
            out += [small[first[i]:first[i + 1]].tobytes() for i in range(hi - lo)]
        yield pa.RecordBatch.from_arrays([column(b, "did"), column(b, "th"), pa.array(out, pa.binary())], names=["did", "th", "words"])


def _cut_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chain's words of the later document, with room to extend."""
    for b in batches:
        lows, regions = [], []
        for c, w in zip(column(b, "chain").to_pylist(), column(b, "words").to_pylist(), strict=True):
            m = np.frombuffer(c, _MATCH)
            lo, hi = max(0, int(m["b"][0]) - EXTEND), int(m["b"][-1]) + K + EXTEND
            lows.append(lo)
            regions.append(w[4 * lo:4 * hi])
        keep = [column(b, n) for n in ("bd", "bt", "ad", "at", "extra", "chain")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(lows, pa.int64()), pa.array(regions, pa.binary())],
                                         names=["bd", "bt", "ad", "at", "extra", "chain", "low", "region"])


def _gap_columns(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Columns (i, j) of an alignment of two short gaps, -1 for none."""
    n, m = len(x), len(y)
    if n == m:
        return [(i, i) for i in range(n)]
    if not n or not m or n * m > 10_000:  # nothing to align, or far apart: side by side, then the rest
        k = min(n, m)
        return [(i, i) for i in range(k)] + [(i, -1) for i in range(k, n)] + [(-1, j) for j in range(k, m)]
    # equal last words stand in one column in any alignment of fewest edits that is read from the end
    tail = 0
    while tail < min(n, m) and x[n - 1 - tail] == y[m - 1 - tail]:
        tail += 1
    end = [(n - 1 - t, m - 1 - t) for t in range(tail)]
    n, m = n - tail, m - tail
    differ = (x[:n, None] != y[None, :m]).tolist()
    # fewest edits; a substitution is one column
    cost = [list(range(m + 1))]
    for i, odd in enumerate(differ, 1):
        up, row, left = cost[-1], [i], i
        for j in range(m):
            left = min(up[j] + odd[j], up[j + 1] + 1, left + 1)
            row.append(left)
        cost.append(row)
    out, i, j = end, n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + differ[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append((i, -1))
        else:
            j -= 1
            out.append((-1, j))
    return out[::-1]


def align(x: np.ndarray, y: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns of the alignment of ``x`` (places ``a``) and ``y`` (``b``) along
    a chain: place in x, place in y (-1: none), and whether they agree."""
    ca, cb = [], []
    a, b = m["a"].astype(np.int64), m["b"].astype(np.int64)
    room = min(a[0], b[0], EXTEND)
    ca.append(np.arange(a[0] - room, a[0]))
    cb.append(np.arange(b[0] - room, b[0]))
    ea, eb = a[0], b[0]  # aligned so far
    # matches of one distance between the places form a run: what lies between
    # them is as long in both and stands side by side
    turn = np.flatnonzero(np.r_[True, np.diff(a - b) != 0, True]).tolist()
    for lo, hi in zip(turn[:-1], turn[1:], strict=True):
        # the first that the matches before don't cover; it may overlap them
        while lo < hi and max(ea - int(a[lo]), eb - int(b[lo])) >= K:
            lo += 1
        if lo == hi:
            continue
        i, j = int(a[lo]), int(b[lo])
        skip = max(ea - i, eb - j, 0)
        i, j = i + skip, j + skip
        if i - ea == j - eb:
            i, j = ea, eb  # the gap too
        elif cols := _gap_columns(x[ea:i], y[eb:j]):
            c = np.array(cols)
            ca.append(np.where(c[:, 0] < 0, -1, c[:, 0] + ea))
            cb.append(np.where(c[:, 1] < 0, -1, c[:, 1] + eb))
        ea, eb = int(a[hi - 1]) + K, int(b[hi - 1]) + K
        ca.append(np.arange(i, ea))
        cb.append(np.arange(j, eb))
    room = min(len(x) - ea, len(y) - eb, EXTEND)
    ca.append(np.arange(ea, ea + room))
    cb.append(np.arange(eb, eb + room))
    ca, cb = np.concatenate(ca), np.concatenate(cb)
    return ca, cb, (ca >= 0) & (cb >= 0) & (x[ca] == y[cb])


def dense_stretches(same: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint stretches of columns of which at least SHARE agree, MIN_WORDS
    long at least; every such stretch overlaps one of them.

    Of all that are long enough the best-scoring one (1 for a column that
    agrees, -4 for one that doesn't; the longest of equals), then those before
    and after it.  Then each grows over what is left beside it while SHARE
    holds for the whole, a piece that scores K or more at a time."""
    win, lose = _WIN, _LOSE
    if int(same.sum()) * (win + lose) < MIN_WORDS * lose:
        return []
    run = np.concatenate([[0], np.cumsum(np.where(same, win, -lose))])
    out, todo = [], [(0, len(same))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < MIN_WORDS:
            continue
        # for each end the farthest start of the least prefix sum
        start, end = run[lo:hi - MIN_WORDS + 1], run[lo + MIN_WORDS:hi + 1]
        low = np.minimum.accumulate(start)
        first = np.maximum.accumulate(np.where(np.r_[True, low[1:] < low[:-1]], np.arange(len(low)), 0))
        gain = end - low
        if gain.max() < 0:
            continue
        ends = np.flatnonzero(gain == gain.max())
        y = int(ends[np.argmax(ends - first[ends])])
        x, y = lo + int(first[y]), lo + y + MIN_WORDS
        out.append((x, y))
        todo += [(lo, x), (y, hi)]
    out.sort()
    for i, (x, y) in enumerate(out):
        y = _grow(run, x, y, out[i + 1][0] if i + 1 < len(out) else len(same), win)
        n, room = len(same), out[i - 1][1] if i else 0
        # backwards, prefix sums count from the other end
        out[i] = (n - _grow(-run[::-1], n - y, n - x, n - room, win), y)
    return out


def _grow(run: np.ndarray, x: int, y: int, limit: int, win: int) -> int:
    """The end of the stretch x..y after taking in pieces up to ``limit``."""
    while y < limit:
        gain = run[y:limit + 1] - np.minimum.accumulate(run[y:limit + 1])
        gain[run[y:limit + 1] < run[x]] = 0
        at = int(np.argmax(gain))
        if gain[at] < K * win:
            break
        y += at
    return y


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for bd, bt, ad, at, extra, c, low, region, w in zip(*(column(b, n).to_pylist() for n in ("bd", "bt", "ad", "at", "extra", "chain", "low",
                                                                                                 "region", "words")), strict=True):
            m = np.frombuffer(c, _MATCH).copy()
            m["b"] -= low
            x, y = np.frombuffer(w, "<u4"), np.frombuffer(region, "<u4")
            ca, cb, same = align(x, y, m)
            for s, e in dense_stretches(same):
                pa_, pb = ca[s:e][ca[s:e] >= 0], cb[s:e][cb[s:e] >= 0]
                equal = int(same[s:e].sum())
                rows.append((bd, ad, low + int(pb[0]), len(pb), int(pa_[0]), len(pa_), equal, equal / (e - s), bt, at, extra))
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:7]], pa.array(cols[7], pa.float64()),
                                              pa.array(cols[8], pa.int64()), pa.array(cols[9], pa.int64()), pa.array(cols[10], pa.bool_())],
                                             names=[*_OUT_NAMES, "bt", "at", "extra"])


def _drop_covered(table: pa.Table) -> pa.Table:
    """Passages of a home's documents without those ``extra`` ones all of
    whose words lie in another that is kept; ``late`` ones displace none."""
    doc, bt, other, first, n, extra, late = (table.column(c).to_numpy() for c in ("doc_id", "bt", "other_doc_id", "first_word", "n_words", "extra", "late"))
    kept, spans = [], {}
    for i in np.lexsort((table.column("other_first_word").to_numpy(), first, other, -n, extra, late)).tolist():
        lo, hi = int(first[i]), int(first[i] + n[i])
        have = spans.setdefault((doc[i], bt[i]), [])
        if extra[i] and any(x <= lo and hi <= y for x, y in have):
            continue
        have.append((lo, hi))
        kept.append(i)
    out = table.select([*_OUT_NAMES, "class_id"]).take(pa.array(kept, pa.int64()))
    for k in (0, 1, len(_OUT_NAMES)):
        ids = out.column(k).to_numpy()
        out = out.set_column(k, out.column_names[k], pa.array(ids, pa.int64(), mask=ids == _NO_ID))
    return out


def _widest(table: pa.Table) -> pa.Table:
    """Passages without those whose words, in the later document, lie in
    another of the same two documents: seeds that repeat give many chains."""
    names = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "bt", "other_doc_id", "at")), strict=True))
    first, n = (table.column(c).to_numpy() for c in ("first_word", "n_words"))
    kept, spans = [], {}
    for i in np.lexsort((table.column("other_first_word").to_numpy(), first, -table.column("n_equal").to_numpy(), -n)).tolist():
        have = spans.setdefault(names[i], [])
        if not any(x <= first[i] and first[i] + n[i] <= y for x, y in have):
            have.append((first[i], first[i] + n[i]))
            kept.append(i)
    return table.take(pa.array(kept, pa.int64())).select([*_OUT_NAMES, "bt", "at", "extra"])


_OUT_NAMES = ["doc_id", "other_doc_id", "first_word", "n_words", "other_first_word", "other_n_words", "n_equal", "similarity"]
_OUT = ", ".join(f"{n} long" for n in _OUT_NAMES[:7]) + ", similarity double"


def _passages(matches: DataFrame, words: DataFrame) -> DataFrame:
    """The passages that parcels of matches lead to."""
    kinds = "bd long, bt long, ad long, at long, extra boolean"
    pairs = matches.groupBy("bucket").applyInArrow(_open_pairs, f"{kinds}, matches binary")
    found = materialize(pairs.mapInArrow(lean(_chain_rows), f"{kinds}, chain binary"), "chains")
    region = found.join(words, (found["bd"] == words["did"]) & (found["bt"] == words["th"])).select("bd", "bt", "ad", "at", "extra", "chain", "words") \
        .mapInArrow(lean(_cut_region), f"{kinds}, chain binary, low long, region binary")
    both = region.join(words, (region["ad"] == words["did"]) & (region["at"] == words["th"])) \
        .select("bd", "bt", "ad", "at", "extra", "chain", "low", "region", "words")
    out = materialize(both.mapInArrow(lean(_align_rows), f"{_OUT}, bt long, at long, extra boolean"), "passages")
    discard(found)
    return out


def _classes(passages: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Documents and the least of those that passages link them with."""
    a = F.struct(F.col("doc_id").alias("did"), F.col("bt").alias("th"))
    b = F.struct(F.col("other_doc_id").alias("did"), F.col("at").alias("th"))
    return merge_labels(labels, passages.select(a.alias("a"), b.alias("b")).distinct())


def fuzzy_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of MIN_WORDS words or more that a document shares with an
    earlier one (smaller id), up to 1 - SHARE of edited words.

    One row a passage: doc_id, other_doc_id, place and length in words in
    either, equal words, similarity (equal columns of the alignment), and
    class_id: the least id that passages lead to from either document.  A
    passage in many documents is linked to an early one, not to each; two
    documents whose seeds lead to one are in one class.  Null,
    empty and short texts have none; rows repeated in id and text are one
    document; a null id counts after all others and is given back as null; an
    empty table gives no rows; other columns aren't read."""
    spark = docs.sparkSession
    was = spark.conf.get(_SWEEP)
    # the shuffles of a job go when it has ended
    spark.conf.set(_SWEEP, "true")
    try:
        return _all_passages(text_rows(docs, id_col, text_col))
    finally:
        spark.conf.set(_SWEEP, was)


def _all_passages(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("th"), "text") \
        .where("text is not null")
    # buckets by the size of the texts: their number, and so that of the
    # parcels, doesn't grow with the shuffle's width
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).head()["n"] or 0
    width = size // BUCKET_BYTES + 1
    dealt = rows.repartition(max(shuffle_width(spark), size // PART_BYTES + 1), "did", "th")
    links = materialize(dealt.mapInArrow(lean(_seeds_of(width)), _KINDS).groupBy("bucket").applyInArrow(_link_bucket(width, True), _KINDS), "links")
    near = links.where("kind = 2").groupBy("bucket").applyInArrow(_pairs_of(width), _KINDS) \
        .groupBy("bucket").applyInArrow(_link_bucket(width, False), _KINDS) \
        .select("bucket", F.lit(3).alias("kind"), "payload")
    words = rows.mapInArrow(lean(_word_table), "did long, th long, words binary").where(F.octet_length("words") >= 4 * MIN_WORDS)
    words = materialize(words.dropDuplicates(["did", "th"]), "words")
    found = _passages(links.where("kind = 1").union(near), words)
    labels = _classes(found)
    homes = max(width, 4 * shuffle_width(spark))
    more = _passages(_class_matches(links, words, labels, width), words)
    discard(words)
    more = materialize(more.groupBy(F.pmod(F.xxhash64("doc_id", "bt", "other_doc_id", "at"), F.lit(homes))).applyInArrow(_widest, more.schema), "more")
    if not more.isEmpty():
        labels = _classes(more, labels)
    names = labels.select(F.col("node.did").alias("doc_id"), F.col("node.th").alias("bt"), F.col("comp.did").alias("class_id"))
    return found.withColumn("late", F.lit(False)).union(more.withColumn("late", F.lit(True))).join(names, ["doc_id", "bt"]) \
        .groupBy(F.pmod(F.xxhash64("doc_id", "bt"), F.lit(homes))).applyInArrow(_drop_covered, f"{_OUT}, class_id long")


def op7_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of every whole text of ``documents``.  Nulls, empty and
    long texts, repeats, null ids and empty tables: as stated by
    ``fuzzy_passages``; of equally good alignments the first one counts."""
    prepare(spark)
    return fuzzy_passages(documents(spark, sf_dir))
