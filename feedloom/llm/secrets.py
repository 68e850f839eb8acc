"""Secrets by a linear-chain conditional random field.

1. Base rules (an assignment to a secret's name, access keys, long hex runs)
   find spans of known form.
2. A CRF tags every token of a text as begin, inside or outside of a secret,
   from its shape, the neighbouring words and gaps, the unbroken run it is in
   and features of the whole file; Viterbi decodes the best tagging.  It is
   trained on a bounded sample of documents: what the base rules mark there,
   the same places with values and names of other forms, and drawn secrets
   put between the words of other documents.
3. Spans that the CRF finds where no base span lies are added.

Tokens are runs of letters and digits, or of the signs ``+/_.=-``; all else
is a gap.  A secret goes on only where no gap lies between.  Every text is
read whole; Viterbi runs over blocks of tokens whose transfer matrices are
combined, so its steps are few and its result is that of the plain recursion.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, column, documents, materialize, mix, prefix_hash, prepare, row_blocks, span_hash, text_rows, utf8_view

# Fixed values (given by the task): the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "crf")
#: Where no rule can match: a wider pattern that is quick to test.
ANY_BASE = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]|[0-9a-f]{24}"

#: Bound of the sample that the CRF is fitted on: documents with and without
#: base spans (those with the smallest hash of id and text), and windows of
#: each.  Everything else covers all rows.
FIT_DOCS, FIT_WINDOWS = 3000, 4
#: Tokens on either side of a window's centre, steps of the fit.
REACH, STEPS = 15, 40
#: Weight of the squared parameters.
PENALTY = 1.0
#: Bytes of text whose features are held at a time.
PIECE = 1 << 20
#: Bytes of context of a piece.
CONTEXT = 1 << 12
O, B, I = 0, 1, 2
NEVER = np.float32(-1e4)

# ------------------------------------------------------------ base rules


def base_matches(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the match) in code points, by start, then
    kind as listed.  An assignment's secret is its value (group 2), which its
    match ends with; the match starts at the name."""
    out = [("assign", *m.span(2), m.start()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", *m.span(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets of ``base_matches``."""
    return [s[:3] for s in base_matches(text)]


# ------------------------------------------------------------ tokens
_LOWER, _UPPER, _DIGIT, _OTHER, _SIGN = 1, 2, 3, 4, 5
CLASS = np.zeros(256, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = _LOWER, _UPPER, _DIGIT, _OTHER
for _c in b"+/_.=-":
    CLASS[_c] = _SIGN
#: 1: letters and digits, 2: signs, 0: gap
_PART = np.array([0, 1, 1, 1, 1, 2], np.uint8)[CLASS]
_FIELD = 12


def _packed(*sets: bytes, bits: int = _FIELD) -> np.ndarray:
    """Counts of several sets of bytes in the bits of one sum."""
    t = np.zeros(256, np.int64)
    for i, s in enumerate(sets):
        for c in s:
            t[c] += 1 << (bits * i)
    return t


_ABC = b"abcdefghijklmnopqrstuvwxyz"
_COUNTED = _packed(_ABC, _ABC.upper(), b"0123456789", b"aeiouAEIOU", b"0123456789abcdef")
_GAPS = _packed(b"\n\r", b"\"'`", b":", bytes(c for c in range(33, 127) if not CLASS[c] and c not in b"\"'`:"), bits=15)
#: Length classes: from 1, 2, 3, 4, 6, 10, 16, 24 and 40 bytes.
_STEPS = np.array([2, 3, 4, 6, 10, 16, 24, 40])

#: Features of a token: name and number of values.
TEMPLATES = (("bias", 1), ("shape", 32 * 9), ("changes", 6 * 9), ("hex", 2 * 9), ("vowels", 6 * 9), ("bits", 32), ("length", 9), ("start", 1024),
             ("previous", 2048), ("second", 2048), ("third", 1024), ("next", 1024), ("gap", 64), ("gap_after", 64),
             ("run", 32 * 9), ("run_changes", 6 * 9), ("file", 32 * 3))
OFFSETS = np.cumsum([0, *[n for _, n in TEMPLATES]])
N_FEATURES = int(OFFSETS[-1])


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    #: no gap lies before it
    joined: np.ndarray
    #: a row for each template
    features: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def file_class(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """0..31 for each document: signs of assignment and code, share of digits."""
    def per(chars: bytes) -> np.ndarray:
        t = np.zeros(256, np.uint8)
        t[list(chars)] = 1
        c = np.r_[0, np.cumsum(t[data], dtype=np.int64)]
        return c[off[1:]] - c[off[:-1]]

    size = np.maximum(np.diff(off), 1)
    marks, code, digits = per(b"=:"), per(b"{};()"), per(b"0123456789")
    return (np.digitize(marks / size, [0.001, 0.005, 0.02]) * 8 + np.digitize(digits / size, [0.005, 0.02, 0.1]) * 2 + (code / size > 0.005)).astype(np.int64)


def _changes(n: np.ndarray) -> np.ndarray:
    return np.digitize(n, [1, 2, 3, 5, 9])


def _tokens(data: np.ndarray, off: np.ndarray, files: np.ndarray) -> Tokens:
    """Tokens of consecutive documents with their features."""
    n = len(data)
    part = _PART[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    new = np.ones(n + 1, bool)
    new[1:-1] = part[1:] != part[:-1]
    new |= cut
    start = np.flatnonzero(new[:-1] & (part > 0))
    end = np.flatnonzero(new[1:] & (part > 0)) + 1
    m = len(start)
    doc = np.searchsorted(off, start, "right") - 1
    size = end - start
    joined = np.zeros(m, bool)
    joined[1:] = (start[1:] == end[:-1]) & (doc[1:] == doc[:-1])
    if not m:
        return Tokens(start, end, doc, joined, np.zeros((len(TEMPLATES), 0), np.int32))

    def sums(table: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        c = np.zeros(n + 1, np.int64)
        np.cumsum(table[data], out=c[1:])
        return c[hi] - c[lo]

    packed, mask = sums(_COUNTED, start, end), (1 << _FIELD) - 1
    lower, upper, digit, vowel, hexa = (packed >> (_FIELD * i) & mask for i in range(5))
    for i in np.flatnonzero(size > mask):
        t = np.bincount(data[start[i]:end[i]], minlength=256)
        lower[i], upper[i], digit[i], vowel[i], hexa[i] = (int(t[list(s)].sum()) for s in (
            _ABC, _ABC.upper(), b"0123456789", b"aeiouAEIOU", b"0123456789abcdef"))
    kind = CLASS[data]
    turn = np.zeros(n + 1, np.int32)
    np.cumsum(kind[1:] != kind[:-1], out=turn[2:])
    sign = part[start] == 2
    other = size - lower - upper - digit
    bits = (lower > 0) * 1 + (upper > 0) * 2 + (digit > 0) * 4 + ((other > 0) & ~sign) * 8 + sign * 16
    length = np.digitize(size, _STEPS)
    low = LOWER[data]
    word = span_hash(prefix_hash(low), start, end)
    # only words have a name; anything with digits goes by its shape
    name = np.where(digit > 0, mix((bits * 16 + length + 7).astype(np.uint64)), word)
    first = data[start].astype(np.int64) << 16 | np.where(size > 1, data[np.minimum(start + 1, n - 1)], 0).astype(np.int64) << 8 \
        | np.where(size > 2, data[np.minimum(start + 2, n - 1)], 0)

    def hashed(h: np.ndarray, values: int) -> np.ndarray:
        # 0 is kept for "none"
        return (1 + h % np.uint64(values - 1)).astype(np.int64)

    def at(distance: int, h: np.ndarray) -> np.ndarray:
        """Value of the token before (or after) in the same document, or 0."""
        out = np.zeros(m, np.int64)
        if distance < 0 and m > -distance:
            same = doc[-distance:] == doc[:distance]
            out[-distance:][same] = h[:distance][same]
        elif distance > 0 and m > distance:
            same = doc[distance:] == doc[:-distance]
            out[:-distance][same] = h[distance:][same]
        return out

    # gaps: before a token, back to the one before it (or the document's start)
    back = np.maximum(off[doc], np.r_[0, end[:-1]])
    packed = sums(_GAPS, back, start)
    gap = (start > back) * 1 + ((start - back > 32767) | (packed & 32767 > 0)) * 2
    for i, bit in ((1, 4), (2, 8), (3, 16)):
        gap += ((packed >> (15 * i)) & 32767 > 0) * bit
    gap += (back == off[doc]) * 32
    after = np.full(m, 32)
    after[:-1][doc[1:] == doc[:-1]] = gap[1:][doc[1:] == doc[:-1]]
    # the unbroken run of tokens that each is in
    heads = np.flatnonzero(~joined)
    run = np.cumsum(~joined) - 1
    tails = np.r_[heads[1:], m] - 1
    run_size = np.digitize(end[tails] - start[heads], _STEPS)
    run_bits = np.bitwise_or.reduceat(bits, heads)
    run_turns = _changes(turn[end[tails]] - turn[start[heads] + 1])
    short = (size >= 12) * 1 + ((size >= 12) & (digit > 0)) * 1
    values = (
        np.zeros(m, np.int64), bits * 9 + length, _changes(turn[end] - turn[start + 1]) * 9 + length, (hexa == size) * 9 + length,
        np.where(lower + upper == 0, 5, np.digitize(vowel / np.maximum(lower + upper, 1), [0.1, 0.2, 0.35, 0.5])) * 9 + length,
        bits, length, np.where((run_bits[run] & 20 > 0) & (run_bits[run] & 8 == 0), hashed(mix(first.astype(np.uint64)), 1024), 0),
        at(-1, hashed(name, 2048)), at(-2, hashed(name, 2048)), at(-3, hashed(name, 1024)), at(1, hashed(name, 1024)),
        gap, after, run_bits[run] * 9 + run_size[run], run_turns[run] * 9 + run_size[run], files[doc] * 3 + short)
    feats = np.empty((len(TEMPLATES), m), np.int32)
    for i, v in enumerate(values):
        feats[i] = v + OFFSETS[i]
    return Tokens(start, end, doc, joined, feats)


# ------------------------------------------------------------ CRF
@dataclass
class Crf:
    """``emit`` (features x 3), ``move`` (3 x 3, from x to) and ``first`` (3)."""
    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    def scores(self, t: Tokens) -> np.ndarray:
        e = np.zeros((len(t), 3), np.float32)
        for j in range(3):
            weight = np.ascontiguousarray(self.emit[:, j], np.float32)
            e[:, j] = sum(weight[f] for f in t.features)
        # a secret goes on only without a gap
        e[~t.joined, I] += NEVER
        return e

    def rules(self) -> tuple[np.ndarray, np.ndarray]:
        move, first = self.move.astype(np.float32).copy(), self.first.astype(np.float32).copy()
        move[O, I] = first[I] = NEVER
        return move, first


def viterbi(e: np.ndarray, heads: np.ndarray, move: np.ndarray, first: np.ndarray, length: int = 256) -> np.ndarray:
    """Best labels of chains laid end to end; ``heads`` marks first tokens.

    Blocks of ``length`` tokens run side by side: their transfer matrices
    (best score from each label before the block to each at its end) are
    chained, then every block is decoded from its known start."""
    n = len(e)
    if not n:
        return np.zeros(0, np.int64)
    blocks = -(-n // length)
    pad = blocks * length - n
    # a step's scores of all blocks lie side by side, label by label
    e = np.ascontiguousarray(np.concatenate([e, np.zeros((pad, 3), e.dtype)]).reshape(blocks, length, 3).transpose(1, 2, 0), np.float64)
    # padding starts a chain, so that it says nothing of the last label
    h = np.ascontiguousarray(np.r_[heads, np.ones(pad, bool)].reshape(blocks, length).T)
    fresh = h.any(1)

    def ahead(v: list[np.ndarray], t: int, back: np.ndarray | None = None) -> list[np.ndarray]:
        """Best scores after token ``t`` from those before it."""
        new = []
        for j in range(3):
            from_o, from_b, from_i = (v[i] + move[i, j] for i in range(3))
            best = np.maximum(from_o, from_b)
            if back is not None:
                back[j] = from_b > from_o
                back[j][from_i > best] = I
            best = np.maximum(best, from_i)
            new.append(best)
        if fresh[t]:
            top = np.maximum(np.maximum(v[0], v[1]), v[2])
            if back is not None:
                was = np.where(v[2] >= top, I, np.where(v[1] >= top, B, O))
            for j in range(3):
                new[j] = np.where(h[t], top + first[j], new[j])
                if back is not None:
                    back[j][h[t]] = was[h[t]]
        return [new[j] + e[t, j] for j in range(3)]

    # p[j][i]: best score of a block that ends in j after i
    p = [np.where(np.arange(3) == j, 0.0, -1e9)[:, None].repeat(blocks, 1) for j in range(3)]
    for t in range(length):
        p = ahead(p, t)
    p = np.stack(p)
    start = np.zeros((blocks, 3))
    for b in range(1, blocks):
        start[b] = (start[b - 1] + p[:, :, b - 1]).max(1)
        start[b] -= start[b].max()
    v = list(np.ascontiguousarray(start.T))
    back = np.empty((length, 3, blocks), np.int8)
    for t in range(length):
        v = ahead(v, t, back[t])
    # label before each block, for every label at its end
    at = np.arange(blocks)
    to = [np.full(blocks, j, np.int8) for j in range(3)]
    for t in range(length - 1, -1, -1):
        to = [back[t][x, at] for x in to]
    last = np.empty(blocks, np.int8)
    last[-1] = np.argmax([x[-1] for x in v])
    for b in range(blocks - 1, 0, -1):
        last[b - 1] = to[last[b]][b]
    out = np.empty((length, blocks), np.int8)
    for t in range(length - 1, -1, -1):
        out[t] = last
        last = back[t][last, at]
    return out.T.reshape(-1)[:n].astype(np.int64)


def _pieces(data: np.ndarray) -> list[int]:
    """Ends of pieces of a text of about ``PIECE`` bytes, cut in white space."""
    ends, lo = [], 0
    while len(data) - lo > PIECE:
        at = lo + PIECE
        while at < len(data):
            gap = np.flatnonzero((data[at:at + 4096] == 32) | (data[at:at + 4096] == 10))
            if len(gap):
                at += int(gap[0])
                break
            at += 4096
        if at >= len(data):
            break
        ends.append(at)
        lo = at
    return [*ends, len(data)]


def chain_scores(model: Crf, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, joined, scores) of the tokens of consecutive
    documents.  A text beyond ``PIECE`` bytes is done in pieces, each read
    with the words around it."""
    files = file_class(data, off)
    if len(off) > 2 or len(data) <= 2 * PIECE:
        t = _tokens(data, off, files)
        return t.start, t.end, t.doc, t.joined, model.scores(t)
    out, lo = [], 0
    for hi in _pieces(data):
        a, b = max(0, lo - CONTEXT), min(len(data), hi + CONTEXT)
        t = _tokens(data[a:b], np.array([0, b - a]), files)
        keep = (t.start + a >= lo) & (t.start + a < hi)
        out.append((t.start[keep] + a, t.end[keep] + a, t.doc[keep], t.joined[keep], model.scores(t)[keep]))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*out))


def crf_spans(model: Crf, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, start, end), bytes from the document's start."""
    start, end, doc, joined, e = chain_scores(model, data, off)
    head = np.ones(len(start), bool)
    head[1:] = doc[1:] != doc[:-1]
    y = viterbi(e, head, *model.rules())
    begins = np.flatnonzero(y == B)
    if not len(begins):
        return []
    goes_on = np.r_[y[1:] == I, False]
    # last token of each: the first from it on that isn't followed by I
    stops = np.flatnonzero(~goes_on)
    lasts = stops[np.searchsorted(stops, begins)]
    return [(int(d), int(s), int(t)) for d, s, t in zip(doc[begins], start[begins] - off[doc[begins]], end[lasts] - off[doc[begins]])]


# ------------------------------------------------------------ training
_BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_NAMES = ("auth", "credential", "bearer", "access_key", "private_key", "signature", "session", "client_id_secret", "pwd", "webhook")


def draw_secret(rng: random.Random) -> str:
    """A value of one of the common forms of keys and tokens."""
    def some(alphabet: str, n: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(n))

    form = rng.randrange(8)
    if form == 0:
        return some(_BASE62, rng.randrange(20, 48))
    if form == 1:
        return some(_BASE62 + "+/", rng.randrange(24, 64)) + "=" * rng.randrange(3)
    if form == 2:
        return some("0123456789ABCDEF", rng.randrange(24, 48))
    if form == 3:
        return rng.choice(["ghp_", "gho_", "sk_live_", "sk-", "pk_test_", "glpat-"]) + some(_BASE62, rng.randrange(20, 40))
    if form == 4:
        return "xoxb-" + some("0123456789", 11) + "-" + some("0123456789", 11) + "-" + some(_BASE62, 24)
    if form == 5:
        return "eyJ" + some(_BASE62, 30) + ".eyJ" + some(_BASE62, 40) + "." + some(_BASE62 + "-_", 43)
    if form == 6:
        return some("0123456789abcdef", rng.randrange(16, 24))
    return "AIza" + some(_BASE62 + "-_", 35)


def _windows(text: str, key: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """Training texts from one document with the secrets in them (code points)."""
    rng = random.Random(key)
    words = [m.span() for m in re.finditer(r"\S+", text)]
    if not words:
        return []
    spans: list[tuple[int, int]] = []
    for _, s, e in base_spans(text):
        if not spans or s >= spans[-1][1]:
            spans.append((s, e))
        else:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
    starts = [w[0] for w in words]
    out = []

    def around(lo: int, hi: int) -> tuple[int, int]:
        """The text from REACH words before ``lo`` to REACH after ``hi``, 2,000 characters a side at most."""
        i, j = int(np.searchsorted(starts, lo, "right")), int(np.searchsorted(starts, hi))
        a, b = max(words[max(i - REACH - 1, 0)][0], lo - 2000), min(words[min(j + REACH, len(words)) - 1][1], hi + 2000)
        return min(a, lo), max(b, hi)

    for s, e in rng.sample(spans, min(len(spans), FIT_WINDOWS)):
        a, b = around(s, e)
        inside = [(max(x, a) - a, min(y, b) - a) for x, y in spans if x < b and y > a]
        out.append((text[a:b], inside))
        # the same place with another value, and under another name
        for name in (None, rng.choice(_NAMES)):
            before, after, value = text[a:s], text[e:b], draw_secret(rng)
            if name:
                before = re.sub(r"(?i)(password|passwd|secret|token|api_?key)(?=[\"']?\x20*[:=]\x20*[\"']?$)", name, before)
            gain = len(value) - (e - s)
            moved = [(x - a, y - a) for x, y in spans if a <= x and y <= s] + [(len(before), len(before) + len(value))] + \
                [(x - a + gain + len(before) - (s - a), y - a + gain + len(before) - (s - a)) for x, y in spans if x >= e and y <= b]
            if len(moved) == len(inside):
                if name and len(before) != s - a:
                    moved = moved if len(moved) == 1 else None
                if moved:
                    out.append((before + value + after, moved))
    for turn in range(FIT_WINDOWS):
        at = rng.randrange(len(words))
        a, b = around(*words[at])
        inside = [(max(x, a) - a, min(y, b) - a) for x, y in spans if x < b and y > a]
        out.append((text[a:b], inside))
        if inside or turn:
            continue
        # a drawn secret between two words, under a name or bare
        cut, value = words[at][1] - a, draw_secret(rng)
        head = rng.choice(["", "", rng.choice(_NAMES) + rng.choice(["=", ": ", " = \"", "=\"", " "])])
        tail = '"' if head.endswith('"') else ""
        before = text[a:a + cut] + rng.choice([" ", "\n"]) + head
        out.append((before + value + tail + " " + text[a + cut:b], [(len(before), len(before) + len(value))]))
    return out


def _gold(t: Tokens, off: np.ndarray, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """Labels of tokens from secrets given in bytes of each document."""
    y = np.zeros(len(t), np.int8)
    first = np.searchsorted(t.doc, np.arange(len(off)))
    for d, ss in enumerate(spans):
        lo, hi = first[d], first[d + 1]
        for s, e in ss:
            i = lo + int(np.searchsorted(t.start[lo:hi], s + off[d]))
            j = lo + int(np.searchsorted(t.start[lo:hi], e + off[d]))
            for k in range(i, j):
                y[k] = B if k == i or not t.joined[k] else I
    return y


def training_rows(docs: DataFrame, bound: int = FIT_DOCS) -> DataFrame:
    """``(text, key)`` of at most ``bound`` documents with and ``bound``
    without base spans."""
    rows = docs.where("text is not null").select("text", F.xxhash64("doc_id", "text").alias("key"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The smallest keys of either kind in a task."""
        best = {True: np.zeros(0, np.int64), False: np.zeros(0, np.int64)}
        for b in batches:
            keys, has = column(b, "key").to_numpy(), pc.match_substring_regex(column(b, "text"), ANY_BASE).to_numpy(zero_copy_only=False)
            for kind in best:
                best[kind] = np.unique(np.r_[best[kind], keys[has == kind]])[:bound]
        for kind, keys in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.full(len(keys), kind))], names=["key", "has"])

    few = materialize(rows.mapInArrow(some, "key long, has boolean"), "crf-keys")
    # two bounded lists of numbers, broadcast whatever the table's size
    pick = few.where("has").select("key").distinct().orderBy("key").limit(bound) \
        .union(few.where("not has").select("key").distinct().orderBy("key").limit(bound))
    return rows.join(F.broadcast(pick), "key").groupBy("key").agg(F.first("text").alias("text"))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window as features and labels, packed."""
    for b in batches:
        for text, key in zip(column(b, "text").to_pylist(), column(b, "key").to_pylist()):
            made = _windows(text, key)
            if not made:
                continue
            raw = [t.encode() for t, _ in made]
            off = np.r_[0, np.cumsum([len(r) for r in raw])]
            data = np.frombuffer(b"".join(raw), np.uint8)
            whole = text.encode()
            files = np.repeat(file_class(np.frombuffer(whole, np.uint8), np.array([0, len(whole)])), len(made))
            t = _tokens(data, off, files)
            y = _gold(t, off, [[(len(x[:s].encode()), len(x[:e].encode())) for s, e in ss] for x, ss in made])
            first = np.searchsorted(t.doc, np.arange(len(off)))
            for lo, hi in zip(first[:-1], first[1:]):
                if hi > lo:
                    yield pa.RecordBatch.from_arrays([pa.array([hi - lo], pa.int32()), pa.array([t.features[:, lo:hi].T.tobytes()], pa.binary()),
                                                      pa.array([t.joined[lo:hi].tobytes()], pa.binary()), pa.array([y[lo:hi].tobytes()], pa.binary())],
                                                     names=["n", "x", "joined", "y"])


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


def gradient(model: Crf, sizes: np.ndarray, x: np.ndarray, joined: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of chains laid end to end and its gradient, by forward
    and backward sums over all chains side by side."""
    order = np.argsort(-sizes, kind="stable")
    begin = np.r_[0, np.cumsum(sizes)][:-1][order]
    sizes = sizes[order]
    e = np.zeros((len(x), 3))
    for k in range(x.shape[1]):
        e += model.emit[x[:, k]]
    e[~joined, I] += float(NEVER)
    move, first = (r.astype(float) for r in model.rules())
    steps = int(sizes[0])
    live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(steps)]
    fwd, bwd = np.zeros((len(x), 3)), np.zeros((len(x), 3))
    fwd[begin] = first + e[begin]
    for t in range(1, steps):
        at = begin[:live[t]] + t
        fwd[at] = _log_sum(fwd[at - 1][:, :, None] + move, 1) + e[at]
    for t in range(steps - 2, -1, -1):
        at = begin[:live[t + 1]] + t
        bwd[at] = _log_sum(move + (e[at + 1] + bwd[at + 1])[:, None, :], 2)
    z = _log_sum(fwd[begin + sizes - 1], 1)
    total = np.empty(len(x))
    for t in range(steps):
        total[begin[:live[t]] + t] = z[:live[t]]
    node = np.exp(fwd + bwd - total[:, None])
    inner = np.ones(len(x), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    edge = np.exp(fwd[at - 1][:, :, None] + move + (e[at] + bwd[at])[:, None, :] - total[at, None, None])
    hit = np.zeros((len(x), 3))
    hit[np.arange(len(x)), y] = 1
    d = hit - node
    g = np.zeros_like(model.emit, dtype=float)
    for j in range(3):
        for k in range(x.shape[1]):
            g[:, j] += np.bincount(x[:, k], weights=d[:, j], minlength=len(g))
    seen = np.zeros((3, 3))
    np.add.at(seen, (y[at - 1], y[at]), 1)
    path = e[np.arange(len(x)), y].sum() + move[y[at - 1], y[at]].sum() + first[y[begin]].sum()
    return float(path - z.sum()), g, seen - edge.sum(0), d[begin].sum(0)


def fit(docs: DataFrame, bound: int = FIT_DOCS, steps: int = STEPS) -> Crf:
    """The CRF of ``docs (doc_id, text)``, by gradient steps over the sample.

    Each step is a Spark pass over the packed examples in which every task
    adds up its gradient; one row a task comes back, of a bounded sample.
    Without any text the model tags nothing."""
    few = materialize(training_rows(docs, bound).mapInArrow(_examples, "n int, x binary, joined binary, y binary").coalesce(8), "crf-examples")
    model = Crf(np.zeros((N_FEATURES, 3)), np.zeros((3, 3)), np.zeros(3))
    model.emit[0, O] = 4.0
    size = N_FEATURES * 3

    def pack(ll: float, n: int, *parts: np.ndarray) -> bytes:
        return np.concatenate([[ll, n], *[p.ravel() for p in parts]]).astype(np.float64).tobytes()

    def one(now: Crf):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ll, n, g, m, f = 0.0, 0, np.zeros((N_FEATURES, 3)), np.zeros((3, 3)), np.zeros(3)
            for b in batches:
                sizes = column(b, "n").to_numpy().astype(np.int64)
                if not len(sizes):
                    continue
                joint = {c: b"".join(column(b, c).to_pylist()) for c in ("x", "joined", "y")}
                got = gradient(now, sizes, np.frombuffer(joint["x"], np.int32).reshape(-1, len(TEMPLATES)), np.frombuffer(joint["joined"], bool),
                               np.frombuffer(joint["y"], np.int8).astype(np.int64))
                ll, n, g, m, f = ll + got[0], n + int(sizes.sum()), g + got[1], m + got[2], f + got[3]
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([pack(ll, n, g, m, f)], pa.binary())], names=["g"])
        return run

    first = second = None
    for step in range(1, steps + 1):
        rows = few.mapInArrow(one(model), "g binary").collect()
        if not rows:
            return model
        total = np.sum([np.frombuffer(r["g"], np.float64) for r in rows], axis=0)
        w = np.concatenate([model.emit.ravel(), model.move.ravel(), model.first.ravel()])
        g = total[2:] - PENALTY * w
        # Adam, upwards
        first = 0.1 * g if first is None else 0.9 * first + 0.1 * g
        second = 0.01 * g * g if second is None else 0.99 * second + 0.01 * g * g
        rate = 0.4 / (1 + step / 20)
        w = w + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        model = Crf(w[:size].reshape(-1, 3), w[size:size + 9].reshape(3, 3), w[size + 9:])
    return Crf(model.emit.astype(np.float32), model.move, model.first)


# ------------------------------------------------------------ documents
_SPANS = "array<struct<kind:string,start:int,end:int,match_start:int>>"


def find_secrets(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` of every row: base spans and what the CRF adds, by
    start, then kind as listed; code points, end exclusive.  ``match_start``
    is where a base rule's match starts: at an assignment's name, else (and
    for the CRF's) at ``start``.

    Null and empty texts have no spans; repeated rows get equal spans; texts
    of any length are read whole; spans of several kinds may be equal; an
    empty table gives no rows; other columns are not read.  A CRF span that
    touches a base span adds nothing and is left out."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("match_start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column(b, "text")
            known = pc.fill_null(pc.match_substring_regex(texts, ANY_BASE), False)
            spans = [base_matches(texts[i].as_py()) if k else [] for i, k in enumerate(known.to_pylist())]
            data, off = utf8_view(texts)
            for lo, hi in row_blocks(off, PIECE):
                at = off[lo]
                block = data[at:off[hi]]
                own = off[lo:hi + 1] - at
                for d, s, e in crf_spans(model, block, own):
                    raw = block[own[d]:own[d] + e]
                    more = (raw & 0xC0) == 0x80
                    cs, ce = s - int(more[:s].sum()), e - int(more.sum())
                    row = spans[lo + d]
                    if not any(x < ce and cs < y for k, x, y, _ in row if k != "crf"):
                        row.append(("crf", cs, ce, cs))
            out = [[{"kind": k, "start": s, "end": e, "match_start": m} for k, s, e, m in sorted(r, key=lambda v: (v[1], KINDS.index(v[0])))] for r in spans]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(out, pa.list_(kind))], names=["doc_id", "spans"])
    return text_rows(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {_SPANS}")


def _listed(spans: Column) -> Column:
    """kind:start:end of the whole matches, by start, then kind as listed."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    by = F.array_sort(F.transform(spans, lambda s: F.struct(s["match_start"].alias("start"), F.array_position(kinds, s["kind"]).alias("order"),
                                                            s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(by, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``.  The spans listed are
    whole matches: an assignment's goes from its name to its value's end.
    Nulls, empty and long texts, ties, repeats and empty tables: as stated by
    ``find_secrets``."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    found = find_secrets(docs, fit(text_rows(docs)))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"), number("crf").alias("n_crf"))
