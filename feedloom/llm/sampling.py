"""SentencePiece segmentations by Gumbel top-k without replacement.

A text's lattice holds every split of it into pieces of the vocabulary, each
piece weighted by a Zipf law of its merge rank (a BPE model stores ranks, no
probabilities).  Pieces begin a word or stay inside one, so the lattice is a
chain of word lattices, a word being a run of blanks and the letters after
it; each distinct word of a group of blocks is built once.

The k best segmentations by log-probability plus Gumbel noise are distinct
samples without replacement.  They are found by A* over regions of the
lattice: a region fixes the first decisions of a path and excludes some
edges at the next; its bound is its largest perturbed score, drawn as a
Gumbel at the region's log-mass truncated at that of the region it was cut
from.  Taking the best region gives its best path (drawn edge by edge), and
the rest of it is cut anew along that path.

All noise is a hash of the row's key, the sample and the place of the
decision, so a row's samples don't depend on partitions or retries.

The inclusion score of a sample with log-probability f is the probability
1 - exp(-exp(f - t)) of exceeding the threshold t, the best bound left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RADIX, RADIX_INV, column, documents, lean, mix, powers, prepare, row_blocks, text_rows, utf8_view

SPACE_MARK = 0x2581
#: Inverse temperature of the piece weights.
ALPHA = 0.5
#: Texts are taken in blocks of about this many bytes; blocks share the
#: lattices of their words up to this many code points of distinct ones and
#: this many bytes of text.
BLOCK_BYTES, WORD_CODES, GROUP_BYTES = 1 << 19, 3 << 18, 1 << 22
#: Bits of a piece's hash below those that it is looked up by.
_TOP = 49
#: Code points whose lattices are built at once.
CACHE_CODES = 1 << 15
_SAMPLE, _STEP, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_MASK = (1 << 64) - 1


def _uniform(*parts: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the parts' sum."""
    h = parts[0]
    for p in parts[1:]:
        h = h + p
    return ((mix(h) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _code(cp: np.ndarray) -> np.ndarray:
    return mix(cp.astype(np.uint64) + np.uint64(0x51ED270B)) | np.uint64(1)


def _prefix(cp: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(_code(cp) * powers(RADIX, len(cp)), out=out[1:])
    return out


class Vocabulary:
    """Pieces of a SentencePiece model by length, with their log-weights."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id = {}
        pieces: list[tuple[int, str, float]] = []
        table = [b""] * n
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                table[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                table[i] = p.replace("▁", " ").encode()
                # a piece out of reach of the merges (blanks) carries a score far
                # below any rank, and gets the weight of the last
                pieces.append((i, p, min(-sp.get_score(i), float(n))))
        self.size = np.array([len(t) for t in table], np.int64)
        self.place = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        rank = np.array([r for _, _, r in pieces])
        weight = -alpha * (np.log1p(rank) + np.log((1 / (1 + rank)).sum()))
        self.fallback = float(weight.min() - alpha * np.log(256))
        self.longest = max(len(p) for _, p, _ in pieces)
        # by length: sorted hashes of the pieces, their ids and weights, and a
        # bit for each hash prefix of a piece's beginning of that length
        self.by_length = []
        for m in range(1, self.longest + 1):
            long = [k for k, (_, p, _) in enumerate(pieces) if len(p) >= m]
            cp = np.array([[ord(c) for c in pieces[k][1][:m]] for k in long], np.uint32).reshape(len(long), m)
            h = (_code(cp) * powers(RADIX, m)).sum(1, dtype=np.uint64)
            begins = np.zeros(1 << 18, bool)
            begins[(h >> np.uint64(46)).astype(np.int64)] = True
            mine = np.array([len(pieces[k][1]) == m for k in long], bool)
            at = np.array(long, np.int64)[mine]
            order = np.argsort(h[mine])
            h = h[mine][order]
            # of each value of the top bits the first such hash, and how many of one value there are at most
            top = (h >> np.uint64(_TOP)).astype(np.int64)
            slot = np.searchsorted(top, np.arange(1 << (64 - _TOP))).astype(np.int32)
            most = int(np.bincount(top).max()) if len(top) else 0
            # a place beyond the last for slots after it: its hash is the last's
            self.by_length.append((np.r_[h, np.repeat(h[-1:], most)], np.array([pieces[k][0] for k in at], np.int64)[order], weight[at][order],
                                   begins, slot, most))

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of consecutive id sequences that end at ``cuts``."""
        n = self.size[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ids) else 0
        at = np.repeat(self.place[ids] - (ends - n), n) + np.arange(total)
        data = self.bytes[at].tobytes()
        out, was = [], 0
        for c in cuts.tolist():
            end = int(ends[c - 1]) if c else 0
            out.append(data[was:end][1:])  # without the blank set before every text
            was = end
        return out


_VOCABULARIES: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _VOCABULARIES:
        _VOCABULARIES[path, alpha] = Vocabulary(path, alpha)
    return _VOCABULARIES[path, alpha]


class WordLattices:
    """Lattices of distinct words, given as code points and word offsets.

    Nodes are places between code points; edges are sorted by their end node,
    and ``logp`` is an edge's log-probability among those that end there
    (segmentations are drawn from the end of a word to its start)."""

    def __init__(self, v: Vocabulary, cp: np.ndarray, off: np.ndarray):
        self.extra: dict[int, list[int]] = {}
        kinds: dict[int, int] = {}
        parts, nodes, edges, ends = [], 0, 0, 0
        # a few words at a time: their arrays stay in the processor's cache
        for lo, hi in row_blocks(off, CACHE_CODES):
            first, last, start, stop, piece, logp, cum, degree, rank, group = self._built(v, cp[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], kinds)
            rank[rank >= 0] += ends
            parts.append([first + nodes, last + nodes, (start + nodes).astype(np.int32), (stop + nodes).astype(np.int32), piece.astype(np.int32),
                          logp, cum, degree.astype(np.int32), rank.astype(np.int32), (group + edges).astype(np.int32)])
            nodes, edges, ends = nodes + len(rank), edges + len(piece), ends + len(group)
        self.first, self.last, self.start, self.stop, self.piece, self.logp, self.cum, self.degree, self.rank, self.group = (
            np.concatenate([p.pop(0) for p in parts]) for _ in range(10))

    def _built(self, v: Vocabulary, cp: np.ndarray, off: np.ndarray, kinds: dict[int, int]) -> tuple[np.ndarray, ...]:
        n, words = len(cp), len(off) - 1
        size = np.diff(off)
        word = np.repeat(np.arange(words), size)
        left = np.repeat(off[1:], size) - np.arange(n)  # code points to the word's end
        code_of, radix = _code(cp), powers(RADIX, len(v.by_length))
        at, end, ids, w = [], [], [], []
        single = np.zeros(n, bool)
        i, x = np.arange(n), np.zeros(n, np.uint64)
        for m, (h, piece, weight, begins, slot, most) in enumerate(v.by_length, 1):
            if m > 1:
                on = left[i] >= m
                i, x = i[on], x[on]
            # the hash of one code point more
            x = x + code_of[i + (m - 1)] * radix[m - 1]
            may = begins[(x >> np.uint64(46)).astype(np.int64)]
            i, x = i[may], x[may]
            if not len(i):
                break
            if not len(h):
                continue
            k = slot[(x >> np.uint64(_TOP)).astype(np.int64)]
            for _ in range(most - 1):
                k += h[k] < x
            ok = np.flatnonzero(h[k] == x)
            j, k = i[ok], np.minimum(k[ok], len(piece) - 1)
            if m == 1:
                single[j] = True
            at.append(j)
            end.append(j + m)
            ids.append(piece[k])
            w.append(weight[k])
        # a code point without a piece goes as its bytes, on one edge
        lone = np.flatnonzero(~single)
        cost = []
        code: list[int] = []
        for c in cp[lone].tolist():
            if c not in kinds:
                kinds[c] = -1 - len(kinds)
                self.extra[kinds[c]] = [v.byte_id[b] for b in chr(c).encode("utf-8", "surrogatepass")]
            code.append(kinds[c])
            cost.append(v.fallback * len(self.extra[kinds[c]]))
        at.append(lone)
        end.append(lone + 1)
        ids.append(np.array(code, np.int64))
        w.append(np.array(cost, np.float64))
        at, end, ids, w = (np.concatenate(x) for x in (at, end, ids, w))
        # node of a place: one more than code points for each word before
        first = off[:-1] + np.arange(words)
        owner = word[at]
        start, stop, depth = at + owner, end + owner, end - off[owner]
        order = np.argsort(stop, kind="stable")
        order = order[np.argsort(depth[order].astype(np.int16 if size.max() < 2**15 else np.int64), kind="stable")]
        start, stop, piece, w, depth = start[order], stop[order], ids[order], w[order], depth[order]
        alpha = np.zeros(n + words)
        group = np.flatnonzero(np.r_[True, stop[1:] != stop[:-1]])  # first edge of each node
        level = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1]])
        bounds = np.r_[level, len(depth)]
        gb = np.searchsorted(group, bounds)
        for a, b, g0, g1 in zip(bounds[:-1], bounds[1:], gb[:-1], gb[1:], strict=True):
            g = group[g0:g1] - a
            x = alpha[start[a:b]] + w[a:b]
            top = np.maximum.reduceat(x, g)
            rep = np.repeat(top, np.diff(np.r_[g, b - a]))
            alpha[stop[a:b][g]] = top + np.log(np.add.reduceat(np.exp(x - rep), g))
        logp = np.minimum(alpha[start] + w - alpha[stop], 0.0)
        degree = np.diff(np.r_[group, len(stop)])
        rank = np.full(n + words, -1)
        rank[stop[group]] = np.arange(len(group))
        # a node's likely edges first, so that few are looked at in a draw
        order = np.argsort(np.repeat(np.arange(len(group)) * 64.0, degree) + np.minimum(-logp, 63.0), kind="stable")
        start, piece, logp = start[order], piece[order], logp[order]
        p = np.exp(logp)
        run = np.cumsum(p)
        cum = run - np.repeat(run[group] - p[group], degree)
        cum[np.r_[group[1:], len(p)] - 1] = 1.0
        return first, first + size, start, stop, piece, logp, cum, degree, rank, group

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge into each node."""
        e = self.group[self.rank[node]]
        todo = np.flatnonzero(u > self.cum[e])
        while len(todo):
            e[todo] += 1
            todo = todo[u[todo] > self.cum[e[todo]]]
        return e

    def draw_one(self, node: int, u: float) -> int:
        e = int(self.group[self.rank[node]])
        while u > self.cum[e]:
            e += 1
        return e


class _Paths:
    """One path a document: its edges, word by word and from each word's end."""

    def __init__(self, edge: np.ndarray, word_end: np.ndarray):
        self.edge, self.word_end = edge, word_end


def _free_paths(lat: WordLattices, uid: np.ndarray, key: np.ndarray, sample: int) -> _Paths:
    """Paths through every word, decisions seeded by (key of the word's place, sample, step)."""
    first = lat.first[uid]
    node = lat.last[uid].copy()
    active = np.arange(len(uid))
    steps = np.zeros(len(uid), np.int64)
    who, what, t = [], [], 0
    with np.errstate(over="ignore"):
        seed = key + np.uint64(sample) * _SAMPLE
        while len(active):
            e = lat.draw(node[active], _uniform(seed[active], np.full(1, np.uint64(t) * _STEP)))
            who.append(active)
            what.append(e)
            steps[active] += 1
            node[active] = lat.start[e]
            active = active[node[active] != first[active]]
            t += 1
    end = np.cumsum(steps)
    edge = np.empty(int(end[-1]) if len(end) else 0, np.int64)
    begin = end - steps
    for t, (a, e) in enumerate(zip(who, what, strict=True)):
        edge[begin[a] + t] = e
    return _Paths(edge, end)


def _take(x: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``x`` of these starts and sizes, one after the other."""
    end = np.cumsum(size)
    return x[np.repeat(begin - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)]


def _first_max(x: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each segment (none empty) and its place."""
    top = np.maximum.reduceat(x, cuts[:-1])
    hit = np.flatnonzero(x == np.repeat(top, np.diff(cuts)))
    seg = np.searchsorted(cuts, hit, "right") - 1
    _, one = np.unique(seg, return_index=True)
    return top, hit[one]


class Sampler:
    """Top-k samples of a block of texts (each with a 64-bit key)."""

    def __init__(self, v: Vocabulary, texts: list[str], keys: np.ndarray):
        self.v, self.keys, self.lat = v, keys, None
        self.hash, self.cp, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.full = np.array([i for i, t in enumerate(texts) if t], np.int64)
        cps = [np.frombuffer(("▁" + texts[i].replace(" ", "▁")).encode("utf-32-le", "surrogatepass"), "<u4") for i in self.full]
        if not cps:
            return
        cp = np.concatenate(cps)
        doc_off = np.cumsum([0, *map(len, cps)])
        start = cp == SPACE_MARK
        start[1:] &= cp[:-1] != SPACE_MARK
        start[doc_off[:-1]] = True
        begin = np.flatnonzero(start)
        end = np.r_[begin[1:], len(cp)]
        pre = _prefix(cp)
        h = mix((pre[end] - pre[begin]) * powers(RADIX_INV, len(cp))[begin] + (end - begin).astype(np.uint64))
        # the distinct words, and each word's number among them
        self.hash, pick, self.uid = np.unique(h, return_index=True, return_inverse=True)
        self.size = (end - begin)[pick]
        self.cp = _take(cp, begin[pick], self.size)
        self.words = np.searchsorted(begin, doc_off)  # first word of each document
        place = np.arange(len(begin)) - np.repeat(self.words[:-1], np.diff(self.words))
        with np.errstate(over="ignore"):
            self.word_key = mix(np.repeat(keys[self.full], np.diff(self.words)) + place.astype(np.uint64) * _WORD)

    @staticmethod
    def share(blocks: list["Sampler"]) -> None:
        """Lattices of the distinct words of all blocks, each built once."""
        full = [x for x in blocks if len(x.full)]
        if not full:
            return
        cp, size = np.concatenate([x.cp for x in full]), np.concatenate([x.size for x in full])
        _, pick, uid = np.unique(np.concatenate([x.hash for x in full]), return_index=True, return_inverse=True)
        # words of one length beside each other: the build goes by depth
        by = np.argsort(size[pick], kind="stable")
        turn = np.empty(len(by), np.int64)
        turn[by] = np.arange(len(by))
        pick, uid = pick[by], turn[uid]
        lat = WordLattices(full[0].v, _take(cp, (np.cumsum(size) - size)[pick], size[pick]), np.r_[0, np.cumsum(size[pick])])
        at = 0
        for x in full:
            x.lat, x.uid, x.cp = lat, uid[at:at + len(x.hash)][x.uid], None
            at += len(x.hash)

    def _cuts(self, p: _Paths) -> np.ndarray:
        return np.r_[0, p.word_end[self.words[1:] - 1]]

    def _bounds(self, p: _Paths, sample: int, t0: np.ndarray, value: np.ndarray, excluded: list[set[int]]) -> np.ndarray:
        """Perturbed bound of the region cut off at each decision of each path,
        from the document's decision ``t0`` on, truncated at the path's value."""
        lat, cuts = self.lat, self._cuts(p)
        n = np.diff(cuts)
        lp = lat.logp[p.edge]
        run = np.cumsum(lp)
        before = run - lp - np.repeat(run[cuts[:-1]] - lp[cuts[:-1]], n)
        node = lat.rank[lat.stop[p.edge]]
        with np.errstate(divide="ignore"):
            rest = np.log1p(-np.exp(lp))
            rest[lat.degree[node] == 1] = -np.inf
            for d, ex in enumerate(excluded):
                if len(ex) > 1:
                    at = cuts[d] + t0[d]
                    own = list(ex)
                    mass = 1 - np.exp(lat.logp[own]).sum()
                    rest[at] = np.log(mass) if mass > 0 and len(ex) < lat.degree[node[at]] else -np.inf
        mass = before + rest
        t = np.arange(len(lp)) - np.repeat(cuts[:-1], n)
        with np.errstate(over="ignore"):
            u = _uniform(np.repeat(self.keys[self.full], n), np.full(1, np.uint64(sample + 1000) * _SAMPLE), t.astype(np.uint64) * _STEP)
        g = -np.logaddexp(-np.repeat(value, n), -(mass + _gumbel(u)))
        g[(t < np.repeat(t0, n)) | np.isneginf(mass)] = -np.inf
        return g

    def _other_edge(self, node: int, excluded: set[int], u: float) -> int:
        """An edge into ``node`` outside ``excluded``."""
        lat = self.lat
        r = lat.rank[node]
        e = np.array([x for x in range(lat.group[r], lat.group[r] + lat.degree[r]) if x not in excluded])
        p = np.cumsum(np.exp(lat.logp[e] - lat.logp[e].max()))
        return int(e[min(np.searchsorted(p, u * p[-1], "right"), len(e) - 1)])

    def run(self, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text its samples: (ids, log-probability, perturbed score,
        inclusion score), best first; an empty text has one of no ids, a text
        with fewer than ``k`` segmentations has all of them."""
        out: list[list] = [[] for _ in self.keys]
        for i in set(range(len(self.keys))) - set(self.full.tolist()):
            out[i] = [(np.zeros(0, np.uint16), 0.0, 0.0, 1.0)]
        if not len(self.full):
            return out
        if self.lat is None:
            Sampler.share([self])
        lat, docs = self.lat, len(self.full)
        with np.errstate(over="ignore"):
            value = _gumbel(_uniform(self.keys[self.full], np.full(1, _SAMPLE)))
        path = _free_paths(lat, self.uid, self.word_key, 0)
        t0 = np.zeros(docs, np.int64)
        excluded: list[set[int]] = [set() for _ in range(docs)]
        alive = np.ones(docs, bool)
        found = []  # (path, its value, which documents it counts for)
        queue = []  # (bounds, cuts, excluded at t0, t0)
        for s in range(k + 1):
            if s:
                # the best region of each document over all paths so far
                best, where, at = np.full(docs, -np.inf), np.zeros(docs, np.int64), np.zeros(docs, np.int64)
                for q, (g, cuts, _, _) in enumerate(queue):
                    top, pos = _first_max(g, cuts)
                    better = top > best
                    best[better], where[better], at[better] = top[better], q, (pos - cuts[:-1])[better]
                threshold = best
                if s == k:
                    break
                alive = ~np.isneginf(best)
                value = best
                path, t0, excluded = self._next_paths(found, queue, where, at, alive, s)
            found.append((path, value, alive.copy()))
            value = np.where(alive, value, 0.0)
            g = self._bounds(path, s, t0, value, excluded)
            cuts = self._cuts(path)
            g[np.repeat(~alive, np.diff(cuts))] = -np.inf
            queue.append((g, cuts, excluded, t0))
        for p, val, live in found:
            cuts = self._cuts(p)
            lp = np.add.reduceat(lat.logp[p.edge], cuts[:-1])
            ids, ends = self._ids(p)
            for d in np.flatnonzero(live).tolist():
                a, b = ends[d], ends[d + 1]
                inc = 1.0 if np.isneginf(threshold[d]) else float(-np.expm1(-np.exp(min(lp[d] - threshold[d], 700.0))))
                out[int(self.full[d])].append((ids[a:b], float(lp[d]), float(val[d]), inc))
        return out

    def _next_paths(self, found, queue, where, at, alive, s) -> tuple[_Paths, np.ndarray, list[set[int]]]:
        """The best path of each document's chosen region: its parent's
        decisions before ``at``, another edge there, free ones after."""
        lat = self.lat
        fresh = _free_paths(lat, self.uid, self.word_key, s)
        parts, ends, total = [], [], 0
        excluded: list[set[int]] = []
        t0 = np.zeros(len(alive), np.int64)
        for d in range(len(alive)):
            w0, w1 = self.words[d], self.words[d + 1]
            f0 = fresh.word_end[w0 - 1] if w0 else 0
            if not alive[d]:
                excluded.append(set())
                parts.append(fresh.edge[f0:fresh.word_end[w1 - 1]])
                ends.append(fresh.word_end[w0:w1] - f0 + total)
                total += len(parts[-1])
                continue
            parent = found[where[d]][0]
            g, cuts, ex, start = queue[where[d]]
            t = int(at[d])
            a = cuts[d]
            g[a + t] = -np.inf  # this region is cut up now
            e = int(parent.edge[a + t])
            out = (ex[d] if t == start[d] and ex[d] else set()) | {e}
            w = int(np.searchsorted(parent.word_end[w0:w1], a + t, "right")) + w0
            key = int(self.word_key[w])
            node = int(lat.stop[e])
            new = [self._other_edge(node, out, self._u(key, s, 0))]
            node = int(lat.start[new[-1]])
            while node != lat.first[self.uid[w]]:
                new.append(lat.draw_one(node, self._u(key, s, len(new))))
                node = int(lat.start[new[-1]])
            tail0 = fresh.word_end[w]
            tail = fresh.edge[tail0:fresh.word_end[w1 - 1]]
            mine = np.concatenate([parent.edge[a:a + t], np.array(new, np.int64), tail])
            here = t + len(new)
            parts.append(mine)
            ends.append(total + np.concatenate([parent.word_end[w0:w] - a, [here], here + fresh.word_end[w + 1:w1] - tail0]))
            total += len(mine)
            t0[d] = t
            excluded.append(out | {new[0]})
        return _Paths(np.concatenate(parts), np.concatenate(ends)), t0, excluded

    @staticmethod
    def _u(key: int, sample: int, step: int) -> float:
        # ``_uniform`` of one number, without arrays
        h = (key + (sample + 500) * int(_SAMPLE) + step * int(_STEP)) & _MASK
        h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        return float(((h ^ (h >> 32)) >> 11) + 0.5) * 2.0**-53

    def _ids(self, p: _Paths) -> tuple[np.ndarray, np.ndarray]:
        """Token ids in reading order and the documents' offsets in them."""
        begin = np.r_[0, p.word_end[:-1]]
        size = p.word_end - begin
        # each word's edges were drawn from its end
        turn = np.repeat(begin + p.word_end - 1, size) - np.arange(len(p.edge))
        piece = self.lat.piece[p.edge[turn]]
        cuts = self._cuts(p)
        odd = np.flatnonzero(piece < 0)
        if not len(odd):
            return piece.astype(np.uint16), cuts
        n = np.ones(len(piece), np.int64)
        n[odd] = [len(self.lat.extra[x]) for x in piece[odd].tolist()]
        end = np.cumsum(n)
        ids = np.repeat(piece, n)
        for i in odd.tolist():
            ids[end[i] - n[i]:end[i]] = self.lat.extra[int(piece[i])]
        return ids.astype(np.uint16), np.r_[0, end][cuts]


OUT = ("doc_id long, sample int, n_tokens long, ids binary, log_prob double, perturbed double, inclusion double, "
       "ids_crc32 long, decoded_crc32 long")


def sample_segmentations(docs: DataFrame, model_path: str, k: int = 2, alpha: float = ALPHA, with_ids: bool = True,
                         seed: str = "segment-1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k`` distinct segmentations of every whole text, one row each.

    doc_id, sample (0 is the best perturbed score), n_tokens, ids (16-bit
    little-endian, with ``with_ids``), log_prob, perturbed, inclusion,
    ids_crc32, and the crc32 of the decoded UTF-8 text, which equals the
    text's own (a U+2581 in a text decodes to a blank).

    A null or empty text has one sample without ids; a text with fewer
    segmentations has them all, with inclusion 1.  Noise depends on
    ``seed``, doc_id and text, so repeated rows get equal samples.  An empty
    table gives no rows; other columns aren't read."""
    rows = text_rows(docs, id_col, text_col).select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"))
    names = [f.split()[0] for f in OUT.split(", ")]
    if not with_ids:
        names.remove("ids")
    schema = ", ".join(f for f in OUT.split(", ") if f.split()[0] in names)

    def sampled(ids: list, got: Sampler, v: Vocabulary) -> pa.RecordBatch:
        flat = [(ids[i], j, *x) for i, xs in enumerate(got.run(k)) for j, x in enumerate(xs)]
        every = np.concatenate([x[2] for x in flat])
        n = np.array([len(x[2]) for x in flat])
        cols = {
            "doc_id": pa.array([x[0] for x in flat], pa.int64()), "sample": pa.array([x[1] for x in flat], pa.int32()),
            "n_tokens": pa.array(n, pa.int64()), "log_prob": pa.array([x[3] for x in flat]),
            "perturbed": pa.array([x[4] for x in flat]), "inclusion": pa.array([x[5] for x in flat]),
            "ids_crc32": pa.array([zlib.crc32(x[2].astype("<u4").tobytes()) for x in flat], pa.int64()),
            "decoded_crc32": pa.array([zlib.crc32(t) for t in v.decode(every, np.cumsum(n))], pa.int64()),
        }
        if with_ids:
            cols["ids"] = pa.array([x[2].astype("<u2").tobytes() for x in flat], pa.binary())
        return pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    def grouped(b: pa.RecordBatch, v: Vocabulary) -> Iterator[list[tuple[list, Sampler]]]:
        """Blocks of a batch, in groups that share their words' lattices."""
        group, codes, size = [], 0, 0
        _, off = utf8_view(column(b, "text"))
        for lo, hi in row_blocks(off, BLOCK_BYTES):
            part = b.slice(lo, hi - lo)
            texts = [t or "" for t in column(part, "text").to_pylist()]
            s = Sampler(v, texts, column(part, "key").to_numpy().view(np.uint64))
            if group and (codes + len(s.cp) > WORD_CODES or size + off[hi] - off[lo] > GROUP_BYTES):
                yield group
                group, codes, size = [], 0, 0
            group.append((column(part, "doc_id").to_pylist(), s))
            codes, size = codes + len(s.cp), size + off[hi] - off[lo]
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path, alpha)
        for b in batches:
            for group in grouped(b, v):
                Sampler.share([s for _, s in group])
                group.reverse()
                while group:
                    # nothing of a block is held while the next one is worked out
                    yield sampled(*group.pop(), v)
                    pa.default_memory_pool().release_unused()
    return rows.mapInArrow(lean(run), schema)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every whole text of ``documents``, with
    their ids, decoded again.  Nulls, empty and long texts, repeats and empty tables: as
    stated by ``sample_segmentations``; ties of scores don't arise, as the
    noise is continuous."""
    prepare(spark)
    import public_tokenizers

    return sample_segmentations(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
