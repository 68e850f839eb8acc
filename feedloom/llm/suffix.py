"""Suffix-array dedup: a distributed merge sort of suffixes that never
compares a known prefix twice.

Every LENGTH-byte string has one anchor: the position of the smallest hash
among its GRAM-byte substrings (leftmost if equal).  Equal strings have equal
anchors at equal places, so sorting the suffixes at anchors finds all
repeats of LENGTH bytes:

1. Anchors whose GRAM bytes occur once are dropped (packed hashes meet by
   range of hash; those repeated within one batch are resolved there).
2. The suffixes at the rest are sorted within each task, front-coded into
   runs (length shared with the suffix before, then the new bytes), and
   exchanged by a hash of their first GRAM bytes.
3. Loser trees merge the runs.  Each suffix carries the length of the prefix
   it shares with the last one put out; a match with different lengths is
   decided by them alone, one with equal lengths reads on from there.
4. Along the merged order, runs of shared prefix give the classes of equal
   right parts for every length; with the bytes left of the anchor they
   tell which strings have an earlier occurrence.

Within a task equal contexts are merged before the exchange.  Anchors that
are frequent everywhere are exchanged string by string instead, so that no
group grows with the number of documents that hold a common line.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODE, RADIX, column, documents, expand, groups, materialize, mix, prefix_hash, prepare, shuffle_width, span_hash, squeeze, text_rows, utf8_view

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # largest distance of an anchor from its string's start
#: Anchors occurring more often than this, and than a share of 1e-5 of all
#: (so at most 100,000 are), are exchanged string by string.
FREQUENT, FREQUENT_SHARE = 2000, 1e-5
_SEGMENT = 1 << 20
_NO_ID = np.iinfo(np.int64).max
_ENTRY = np.dtype([("hash", "<u8"), ("pos", "<u4"), ("doc", "<u2"), ("lo", "u1"), ("hi", "u1")])
_PLACE = np.dtype([("pos", "<u4"), ("lo", "u1"), ("hi", "u1")])
_SPAN = np.dtype([("a", "<u4"), ("b", "<u4")])
_RUN = np.dtype([("did", "<i8"), ("th", "<i8"), ("pos", "<u4"), ("lo", "u1"), ("hi", "u1"), ("right", "u1"), ("left", "u1"),
                 ("lcp", "u1"), ("lcs", "u1")])


# ------------------------------------------------------------ anchors
def anchors(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Entries of all anchors of consecutive documents: hash of their GRAM
    bytes, document, position in it, and the range ``lo..hi`` of distances
    from the starts of the strings they stand for."""
    out = []
    n = len(data)
    for a in range(0, max(0, n - LENGTH + 1), _SEGMENT):
        b = min(a + _SEGMENT, n - LENGTH + 1)  # string starts a..b-1
        seg = data[a:b + LENGTH - 1]
        d0, d1 = np.searchsorted(off, a, "right") - 1, np.searchsorted(off, b - 1, "right")
        whole = np.ones(b - a, bool)
        for e in off[d0 + 1:d1 + 1]:
            if e < n:  # strings starting in the last LENGTH - 1 bytes of a document leave it
                whole[max(0, e - LENGTH + 1 - a):max(0, e - a)] = False
        if not whole.any():
            continue
        at = np.arange(len(seg) - GRAM + 1)
        h = span_hash(prefix_hash(seg), at, at + GRAM)
        low = (h & ~np.uint64((1 << 21) - 1)) | at.astype(np.uint64)
        size = 1
        while size * 2 <= REACH + 1:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        rest = REACH + 1 - size
        low = np.minimum(low[:len(low) - rest], low[rest:])[:b - a]
        s = np.flatnonzero(whole)
        pick = (low[s] & np.uint64((1 << 21) - 1)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (s[1:] != s[:-1] + 1)])
        last = np.r_[new[1:], len(s)] - 1
        e = np.zeros(len(new), _ENTRY)
        p = pick[new]
        doc = np.searchsorted(off, p + a, "right") - 1
        e["hash"], e["pos"], e["doc"] = h[p], p + a - off[doc], doc
        e["hi"], e["lo"] = p - s[new], p - s[last]
        out.append(e)
    return np.concatenate(out) if out else np.zeros(0, _ENTRY)


_KINDS = "bucket int, kind int, payload binary"
_NAMES = ["bucket", "kind", "payload"]


def _rows(bucket, kind: int, payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(bucket, np.int32)), pa.array(np.full(len(payload), kind, np.int32)),
                                       pa.array(payload, pa.binary())], names=_NAMES)


# Parcels: items (places or intervals) of many documents, by a hash of the
# document, so that their number doesn't grow with documents times buckets.
def _parcels(did: np.ndarray, th: np.ndarray, doc: np.ndarray, items: np.ndarray, width: int, kind: int) -> Iterator[pa.RecordBatch]:
    """``items[i]`` belongs to document ``did[doc[i]], th[doc[i]]``."""
    if not len(doc):
        return
    with np.errstate(over="ignore"):
        home = (mix(did.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th.astype(np.uint64)) % np.uint64(width)).astype(np.int64)
    names, at = np.unique(doc, return_inverse=True)
    homes, parts = groups(home[names][at], np.arange(len(doc)))
    rows = []
    for p in parts:
        which, local = np.unique(at[p], return_inverse=True)
        order = np.argsort(local, kind="stable")
        n = np.bincount(local).astype("<u4")
        d = names[which]
        rows.append(np.array([len(d), len(p)], "<i8").tobytes()
                    + squeeze(did[d].astype("<i8"), th[d].astype("<i8"), n, items[p][order]))
    yield _rows(homes, kind, rows)


def _open_parcels(item: np.dtype):
    """(did, th, payload) of the documents of a home's parcels."""
    def run(table: pa.Table) -> pa.Table:
        dids, ths, ns, items = [], [], [], []
        for p in table.column("payload").to_pylist():
            docs, n = np.frombuffer(p, "<i8", 2).tolist()
            d, t, c, x = expand(p[16:], ("<i8", docs), ("<i8", docs), ("<u4", docs), (item, n))
            dids.append(d)
            ths.append(t)
            ns.append(c)
            items.append(x)
        did, th, n, x = (np.concatenate(v) for v in (dids, ths, ns, items))
        _, first, doc = np.unique(np.stack([did, th], 1), axis=0, return_index=True, return_inverse=True)
        docs, parts = groups(np.repeat(doc.ravel(), n), x)
        return pa.table({"did": pa.array(did[first[docs]]), "th": pa.array(th[first[docs]]),
                         "payload": pa.array([v.tobytes() for v in parts], pa.binary())})
    return run


def _places(e: np.ndarray) -> np.ndarray:
    p = np.zeros(len(e), _PLACE)
    for f in ("pos", "lo", "hi"):
        p[f] = e[f]
    return p


def _post_anchors(width: int):
    """kind 0: packed entries by hash; kind 1: parcels of places that are known
    to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dids, ths = column(b, "did").to_numpy(), column(b, "th").to_numpy()
            for lo in range(0, b.num_rows, 60_000):
                did, th = dids[lo:lo + 60_000], ths[lo:lo + 60_000]
                e = anchors(*utf8_view(column(b, "text").slice(lo, 60_000)))
                e = e[np.argsort(e["hash"], kind="stable")]
                _, first, count = np.unique(e["hash"], return_index=True, return_counts=True)
                many = np.repeat(count > 1, count)
                yield from _parcels(did, th, e["doc"][many].astype(np.int64), _places(e[many]), width, 1)
                # the rest, and one marker (lo > hi, its count in pos) for each repeated hash
                mark = e[first[count > 1]].copy()
                mark["pos"], mark["lo"], mark["hi"] = np.minimum(count[count > 1], 2**32 - 1), 1, 0
                e = np.concatenate([e[~many], mark])
                buckets, parts = groups((e["hash"] % np.uint64(width)).astype(np.int64), e)
                if len(buckets):
                    yield _rows(buckets, 0, [_pack(p[np.argsort(p["hash"])], did, th) for p in parts])
    return run


def _pack(e: np.ndarray, did: np.ndarray, th: np.ndarray) -> bytes:
    """Entries and the names of the documents that they mention."""
    docs, local = np.unique(e["doc"], return_inverse=True)
    return np.array([len(docs), len(e)], "<i8").tobytes() + squeeze(
        did[docs].astype("<i8"), th[docs].astype("<i8"), e["hash"], local.astype("<u2"), e["pos"], e["lo"], e["hi"])


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, n = np.frombuffer(payload, "<i8", 2).tolist()
    did, th, h, doc, pos, lo, hi = expand(payload[16:], ("<i8", docs), ("<i8", docs), ("<u8", n), ("<u2", n), ("<u4", n), ("u1", n), ("u1", n))
    e = np.zeros(n, _ENTRY)
    e["hash"], e["doc"], e["pos"], e["lo"], e["hi"] = h, doc, pos, lo, hi
    return did, th, e


def _repeated(frequent: int, width: int):
    """Of one bucket, parcels of the places of hashes that occur twice (kind
    1) and the hashes that are frequent (kind 2)."""
    def run(table: pa.Table) -> pa.Table:
        kind = column_np(table, "kind")
        out = [table.filter(pa.array(kind == 1)).select(_NAMES)]
        dids, ths, es, docs, at = [], [], [], [], 0
        for p in table.filter(pa.array(kind == 0)).column("payload").to_pylist():
            did, th, e = _unpack(p)
            dids.append(did)
            ths.append(th)
            es.append(e)
            docs.append(e["doc"].astype(np.int64) + at)
            at += len(did)
        if es:
            e, doc = np.concatenate(es), np.concatenate(docs)
            weight = np.where(e["lo"] > e["hi"], e["pos"], 1)
            _, inv = np.unique(e["hash"], return_inverse=True)
            total = np.bincount(inv, weights=weight)
            keep = (total[inv] > 1) & (e["lo"] <= e["hi"])
            out += [pa.Table.from_batches([x]) for x in
                    _parcels(np.concatenate(dids), np.concatenate(ths), doc[keep], _places(e[keep]), width, 1)]
            hot = np.unique(e["hash"][total[inv] > frequent]).astype("<u8")
            if len(hot):
                out.append(pa.Table.from_batches([_rows([0], 2, [hot.tobytes()])]))
        return pa.concat_tables(out)
    return run


def column_np(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


# ------------------------------------------------------------ runs
def front_code(rec: np.ndarray, right: list[bytes], left: list[bytes]) -> bytes:
    """A sorted run: shared lengths in ``rec``, then the bytes that differ
    from the suffix before; left contexts likewise, from their ends."""
    body = []
    was_r = was_l = b""
    for i, (r, x) in enumerate(zip(right, left, strict=True)):
        n = shared(r, was_r, 0)
        m = shared(x, was_l, 0)
        rec["lcp"][i], rec["lcs"][i] = n, m
        body.append(r[n:])
        body.append(x[m:])
        was_r, was_l = r, x
    return zstandard.ZstdCompressor(level=3).compress(np.array([len(rec)], "<i8").tobytes() + rec.tobytes() + b"".join(body))


def read_run(payload: bytes) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    payload = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(payload, "<i8", 1)[0])
    rec = np.frombuffer(payload, _RUN, n, 8)
    at = 8 + rec.nbytes
    right, left = [], []
    r = x = b""
    for lcp, lcs, nr, nl in zip(rec["lcp"].tolist(), rec["lcs"].tolist(), rec["right"].tolist(), rec["left"].tolist(), strict=True):
        r = r[:lcp] + payload[at:at + nr - lcp]
        at += nr - lcp
        x = x[:lcs] + payload[at:at + nl - lcs]
        at += nl - lcs
        right.append(r)
        left.append(x)
    return rec, right, left


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are not read again."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while n - known > 8:
        mid = (known + n) // 2
        if a[known:mid] == b[known:mid]:
            known = mid
        else:
            n = mid
    while a[known] == b[known]:
        known += 1
    return known


def merge_runs(runs: list[list[bytes]], lcps: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs with a loser tree: the run that each next suffix comes
    from, and the length it shares with the one before."""
    k = 1
    while k < len(runs):
        k *= 2
    head: list[bytes | None] = [r[0] if r else None for r in runs] + [None] * (k - len(runs))
    known = [0] * k  # shared with the last suffix put out
    place = [0] * k
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = shared(x, y, known[a])
        if x[n:n + 1] <= y[n:n + 1]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    level = list(range(k))
    nodes = k
    while len(level) > 1:
        nodes //= 2
        up = []
        for j in range(nodes):
            w, losers[nodes + j] = play(level[2 * j], level[2 * j + 1])
            up.append(w)
        level = up
    w = level[0]
    source, lcp = [], []
    while head[w] is not None:
        source.append(w)
        lcp.append(known[w])
        place[w] += 1
        if place[w] < len(runs[w]):
            head[w], known[w] = runs[w][place[w]], lcps[w][place[w]]
        else:
            head[w] = None
        j = (k + w) // 2
        while j:
            w, losers[j] = play(w, losers[j])
            j //= 2
    return source, lcp


def repeated_strings(rec: np.ndarray, lcp: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For sorted suffixes a matrix: does the string that starts ``o`` bytes
    before the anchor (within ``lo..hi``) occur earlier?"""
    n = len(rec)
    dup = np.zeros((n, REACH + 1), bool)
    order = np.lexsort((rec["pos"], rec["th"], rec["did"]))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    side = np.zeros(n, np.uint64)
    for o in range(REACH + 1):
        if o:
            side = side * np.uint64(RADIX) + BYTE_CODE[left[:, o - 1]]
        r = LENGTH - o
        joined = lcp >= r
        joined[0] = False
        near = joined.copy()
        near[:-1] |= joined[1:]
        at = np.flatnonzero(near & (rec["lo"] <= o) & (rec["hi"] >= o))
        if len(at) < 2:
            continue
        group = np.cumsum(~joined)[at].astype(np.uint64)
        key = mix(mix(side[at]) + group)
        by = np.lexsort((rank[at], key))
        key = key[by]
        dup[at[by[1:][key[1:] == key[:-1]]], o] = True
    return dup


def intervals(dup: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, (start, end)) of the bytes covered by each run of repeated strings."""
    edge = np.diff(np.pad(dup.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    r0, o0 = np.nonzero(edge == 1)
    _, o1 = np.nonzero(edge == -1)
    p = pos[r0].astype(np.int64)
    return r0, np.stack([p - (o1 - 1), p - o0 + LENGTH], 1)


def _make_runs(width: int, hot: np.ndarray):
    """kind 0: front-coded runs; kind 1: intervals already known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, th = column(b, "did").to_pylist(), column(b, "th").to_pylist()
            recs = []  # (suffix, left context from the anchor on, lo, did, th, pos, hi, place of exchange)
            for d, h, t, ps in zip(did, th, column(b, "text"), column(b, "places").to_pylist(), strict=True):
                text = t.as_buffer().to_pybytes()
                e = np.frombuffer(ps, _PLACE)
                pos = e["pos"].astype(np.int64)
                gram = span_hash(prefix_hash(np.frombuffer(text, np.uint8)), pos, pos + GRAM)
                often = np.isin(gram.view(np.int64), hot).tolist()
                for p, lo, hi, g, f in zip(pos.tolist(), e["lo"].tolist(), e["hi"].tolist(), gram.tolist(), often, strict=True):
                    if f:  # each string by itself
                        for q in range(p - hi, p - lo + 1):
                            r = text[q:q + LENGTH]
                            recs.append((r, b"", 0, d, h, q, 0, zlib.crc32(r)))
                    else:
                        recs.append((text[p:p + LENGTH - lo], text[p - hi:p][::-1], lo, d, h, p, hi, g))
            if not recs:
                continue
            recs.sort()
            # of equal contexts the earliest stays; all strings of the others repeat
            keep, again, was = [], [], None
            for r in recs:
                (again if r[:3] == was else keep).append(r)
                was = r[:3]
            if again:
                rec = _records(again)
                yield from _emit(rec, np.stack([rec["pos"].astype(np.int64) - rec["hi"],
                                                rec["pos"].astype(np.int64) - rec["lo"] + LENGTH], 1), width)
            by_bucket: dict[int, list] = {}
            for r in keep:
                by_bucket.setdefault(r[7] % width, []).append(r)
            yield _rows(list(by_bucket), 0, [front_code(_records(rs), [r[0] for r in rs], [r[1] for r in rs]) for rs in by_bucket.values()])
    return run


def _records(recs: list[tuple]) -> np.ndarray:
    return np.array([(d, h, p, lo, hi, len(r), len(x), 0, 0) for r, x, lo, d, h, p, hi, _ in recs], _RUN)


def _emit(rec: np.ndarray, span: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Parcels (kind 1) of intervals."""
    s = np.zeros(len(span), _SPAN)
    s["a"], s["b"] = span[:, 0], span[:, 1]
    yield from _parcels(rec["did"], rec["th"], np.arange(len(rec)), s, width, 1)


def _merge_bucket(width: int):
    return lambda table: _merged(table, width)


def _merged(table: pa.Table, width: int) -> pa.Table:
    kind = column_np(table, "kind")
    out = [table.filter(pa.array(kind == 1)).select(_NAMES)]
    runs = [read_run(p) for p in table.filter(pa.array(kind == 0)).column("payload").to_pylist()]
    if runs:
        source, lcp = merge_runs([r[1] for r in runs], [r[0]["lcp"].tolist() for r in runs])
        src = np.array(source)
        place = np.zeros(len(src), np.int64)
        for k, r in enumerate(runs):
            place[src == k] = np.arange(len(r[0]))
        base = np.cumsum([0, *[len(r[0]) for r in runs]])
        rec = np.concatenate([r[0] for r in runs])[base[src] + place]
        left = np.zeros((len(src), REACH), np.uint8)
        for i, (k, j) in enumerate(zip(source, place.tolist(), strict=True)):
            x = runs[k][2][j]
            left[i, :len(x)] = np.frombuffer(x, np.uint8)
        dup = repeated_strings(rec, np.array(lcp), left)
        row, span = intervals(dup, rec["pos"])
        out += [pa.Table.from_batches([x]) for x in _emit(rec[row], span, width)]
    return pa.concat_tables(out)


# ------------------------------------------------------------ operator
_DOC = "did long, th long, payload binary"
_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def covered(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals, in order."""
    if not len(spans):
        return []
    s = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(s[:, 1])
    new = np.r_[True, s[1:, 0] > reach[:-1]]
    return list(zip(s[new, 0].tolist(), reach[np.r_[new[1:], True]].tolist(), strict=True))


def _finish(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, spans, first in zip(column(b, "text"), column(b, "spans").to_pylist(), column(b, "first").to_pylist(), strict=True):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                if first:
                    runs = covered(np.frombuffer(spans or b"", "<u4").astype(np.int64).reshape(-1, 2))
                else:
                    runs = [(0, len(text))] if len(text) >= LENGTH else []
                kept, at = [], 0
                for x, y in runs:
                    kept.append(text[at:x])
                    at = y
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left if with_bytes else None))
            n, removed, n_spans, sha, left = zip(*out, strict=True) if out else ((), (), (), (), ())
            arrays = [column(b, "doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                      pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                arrays.append(pa.array(left, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True) -> DataFrame:
    """Remove every byte covered by a LENGTH-byte string that also starts
    earlier (smaller doc_id, or the same document at a smaller start), judged
    on the texts as given.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, with ``with_bytes``, kept (the bytes left).  Strings
    never cross documents; texts shorter than LENGTH, empty and null ones (no
    bytes) lose nothing.  Null ids come after all others and different texts
    of one id in the order of their hash; rows repeated in id and text are
    one document and get the same result.  An empty table gives no rows;
    other columns aren't read."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    rows = text_rows(docs, id_col, text_col).select(
        "doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("th"), "text")
    info = materialize(rows.select("did", "th", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("sha"),
                                   F.octet_length("text").alias("n")), "texts")
    total = info.agg(F.sum("n").alias("n")).head()["n"] or 0
    frequent = max(FREQUENT, int(total * 2 / (REACH + 2) * FREQUENT_SHARE))

    posted = rows.select("did", "th", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(_post_anchors(width), _KINDS)
    found = materialize(posted.groupBy("bucket").applyInArrow(_repeated(frequent, width), _KINDS), "anchors")
    hot = np.frombuffer(b"".join(r["payload"] for r in found.where("kind = 2").select("payload").collect()), "<i8")

    # exact copies of an earlier text need no search
    first = info.groupBy("sha").agg(F.min("did").alias("did0"))
    firsts = info.join(first, (info["sha"] == first["sha"]) & (info["did"] == first["did0"])).select("did", "th").distinct()
    places = found.where("kind = 1").groupBy("bucket").applyInArrow(_open_parcels(_PLACE), _DOC) \
        .withColumnRenamed("payload", "places").join(firsts, ["did", "th"])

    dealt = rows.repartition(width, "did", "th")
    searched = dealt.join(places.hint("shuffle_hash"), ["did", "th"]).select("did", "th", "text", "places")
    if not info.groupBy("did", "th").count().where("count > 1").isEmpty():
        searched = searched.dropDuplicates(["did", "th"])
    spans = searched.mapInArrow(_make_runs(width, hot), _KINDS).groupBy("bucket").applyInArrow(_merge_bucket(width), _KINDS) \
        .groupBy("bucket").applyInArrow(_open_parcels(_SPAN), _DOC).withColumnRenamed("payload", "spans")
    out = dealt.join(firsts.withColumn("first", F.lit(True)).hint("shuffle_hash"), ["did", "th"], "left") \
        .join(spans.hint("shuffle_hash"), ["did", "th"], "left") \
        .select("doc_id", "text", "spans", F.coalesce("first", F.lit(False)).alias("first"))
    return out.mapInArrow(_finish(with_bytes), _OUT + (", kept binary" if with_bytes else ""))


#: The same by hashing every string, for DuckDB.
ORACLE_SQL = r"""
with t as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, s, md5(substr(h, 2 * s + 1, 200)) as k
      from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as s from t where length(h) >= 200)),
d as (select doc_id, s from (select doc_id, s, row_number() over (partition by k order by doc_id, s) as r from w) where r > 1),
g as (select doc_id, s, case when s > lag(s) over (partition by doc_id order by s) + 100 then 1 else 0 end as new from d),
i as (select doc_id, s, sum(new) over (partition by doc_id order by s) as run from g),
r as (select doc_id, min(s) as a, max(s) + 100 as b from i group by doc_id, run),
p as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as was from r),
c as (select doc_id, sum(b - a) as removed, count(*) as spans, max(b) as last,
             string_agg(substr(h, 2 * was + 1, 2 * (a - was)), '' order by a) as front
      from p join t using (doc_id) group by doc_id)
select t.doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
       cast(coalesce(spans, 0) as bigint) as n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from t left join c using (doc_id)
"""


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeat removal leaves of every whole text of ``documents``.
    Nulls, empty and long texts, repeats, ties and empty tables: as stated by
    ``remove_repeats``."""
    prepare(spark)
    return remove_repeats(documents(spark, sf_dir), with_bytes=False)
