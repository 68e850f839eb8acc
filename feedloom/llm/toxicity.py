"""Toxicity by weak supervision.

1. Voters: a fixed lexicon, text patterns, and a lexicon of words, word
   stems and stems in two different words induced from labelled training
   rows.  A voter fires or is silent.
2. Label model: a generative model of the voters' firing given the hidden
   label, fitted by EM from their agreement alone.  It estimates each
   voter's accuracy (firing rates under either label) and the correlations
   of voters within a label; correlated voters share their weight.
3. A linear classifier is trained on the posterior labels and set to
   probabilities with the training labels.  Patterns lend weight to terms, but
   can't make a text toxic without one.

Scores read the text only.  Held-out rows (crc32 of doc_id as text mod 5 = 0)
are never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (column, documents, lean, materialize, plus, prefix_hash, prepare, row_blocks, span_hash, spread,
                     utf8_view, words)

#: Bound of the labelled rows that the models are fitted on (the rows with
#: the smallest hash of their doc_id).  Everything else covers all rows.
FIT_ROWS = 20_000
#: Induced voters at most, and what a term needs: this many toxic documents
#: (or this share of them) and this ratio of its rates in either class, two
#: standard errors away.
MAX_VOTERS, MIN_SUPPORT, MIN_SHARE, MIN_RATIO = 192, 3, 0.004, 8.0
#: Bytes of a word's start that make a stem.
STEMS = (4, 5, 6)
EM_STEPS = 8
#: Residual correlation from which voters share weight: below it lie voters
#: that merely occur in the same kind of text.
STRONG = 0.6
#: Score that patterns alone reach at most.
PATTERN_LIMIT = 0.4
#: Fixed lexicon of the first voters.
LEXICON = ("idiot", "moron", "stupid", "loser", "pathetic", "worthless", "scum", "trash", "disgusting", "clown",
           "imbecile", "garbage", "filthy", "vermin", "hateful", "ugly")
PATTERNS = ("shouting", "exclaiming", "stretched", "masked")

_TWICE = np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[:128] = True
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    _SEPARATOR[_c] = False


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text mod 5 is 0 (a null id counts as held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def term_stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, hash of its whole word) of every word and stem of
    lower-cased texts.  The last bit of a term's hash is 0; with 1 it stands
    for the term ``stem in two different words``."""
    starts, ends, first = words(data, off, _SEPARATOR)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    pre = prefix_hash(data)
    whole = span_hash(pre, starts, ends) & ~_TWICE
    rows, hashes, of = [row], [whole], [whole]
    for n in STEMS:
        long = ends - starts > n
        rows.append(row[long])
        hashes.append((span_hash(pre, starts[long], starts[long] + n) ^ np.uint64(2 * n)) & ~_TWICE)
        of.append(whole[long])
    return np.concatenate(rows), np.concatenate(hashes), np.concatenate(of)


def twice(row: np.ndarray, h: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the stems that two different words of a row share."""
    stem = h != word
    row, h, word = row[stem], h[stem], word[stem]
    order = np.lexsort((word, h, row))
    row, h, word = row[order], h[order], word[order]
    if not len(row):
        return row, h
    same = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
    # a second word begins within the run of a row's stem
    at = np.flatnonzero(same & (word[1:] != word[:-1])) + 1
    pair = np.unique(np.stack([row[at].astype(np.uint64), h[at] | _TWICE], 1), axis=0) if len(at) else np.zeros((0, 2), np.uint64)
    return pair[:, 0].astype(np.int64), pair[:, 1]


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0] & ~_TWICE)


def pattern_hits(text: bytes) -> list[bool]:
    """The patterns of one text: mostly capitals, runs of exclamation marks,
    a letter stretched over five places, letters masked by signs."""
    a = np.frombuffer(text, np.uint8)
    up, low = int(((a >= 65) & (a <= 90)).sum()), int(((a >= 97) & (a <= 122)).sum())
    same = np.ones(max(0, len(a) - 4), bool)
    for j in range(1, 5):
        same &= a[:len(same)] == a[j:j + len(same)]
    letter = (a[:len(same)] >= 97) & (a[:len(same)] <= 122)
    return [up > 20 and up > low, b"!!!" in text, bool((same & letter).any()), b"@$$" in text or b"f**" in text]


@dataclass
class Features:
    """Sorted term hashes; a row's features are their presence, then the patterns."""
    terms: np.ndarray

    def __post_init__(self):
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.terms >> np.uint64(44)).astype(np.int64)] = True

    @property
    def size(self) -> int:
        return len(self.terms) + len(PATTERNS)

    def rows(self, col: pa.Array) -> np.ndarray:
        """Boolean matrix, a row for each text."""
        raw, raw_off = utf8_view(col)
        data, off = utf8_view(pc.utf8_lower(col))
        out = np.zeros((len(off) - 1, self.size), bool)
        for lo, hi in row_blocks(off, 1 << 20):
            row, h, word = term_stream(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            at = np.flatnonzero(self.bits[(h >> np.uint64(44)).astype(np.int64)])
            for r, x in ((row[at], h[at]), twice(row[at], h[at], word[at])):
                k = np.minimum(np.searchsorted(self.terms, x), len(self.terms) - 1)
                hit = self.terms[k] == x
                out[lo + r[hit], k[hit]] = True
        for i in range(len(off) - 1):
            if raw_off[i + 1] > raw_off[i]:
                out[i, len(self.terms):] = pattern_hits(raw[raw_off[i]:raw_off[i + 1]].tobytes())
        return out


# ------------------------------------------------------------ training rows
def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled rows outside the held-out fold."""
    pick = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("y")) \
        .where(~held_out(F.col("doc_id")) & F.col("y").isNotNull()) \
        .groupBy("doc_id").agg(F.max("y").alias("y")) \
        .orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(bound)
    # at most ``bound`` rows of two numbers: bounded whatever the tables' size
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")) \
        .join(F.broadcast(pick), "doc_id").where("text is not null")


def induce_terms(train: DataFrame) -> np.ndarray:
    """Hashes of the fixed lexicon and of the terms that tell toxic rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8_view(pc.utf8_lower(column(b, "text")))
            y = np.array(column(b, "y").to_pylist(), np.int64)
            for lo, hi in row_blocks(off, 2 << 20):
                row, h, word = term_stream(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                row2, h2 = twice(row, h, word)
                row, h = np.r_[row, row2], np.r_[h, h2]
                pair = np.unique(np.stack([h, row.astype(np.uint64)], 1), axis=0) if len(h) else np.zeros((0, 2), np.uint64)
                term, inv, n = np.unique(pair[:, 0], return_inverse=True, return_counts=True)
                tox = np.bincount(inv.ravel(), weights=y[lo:hi][pair[:, 1].astype(np.int64)], minlength=len(term))
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n), pa.array(tox.astype(np.int64))],
                                                 names=["h", "n", "t"])

    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).head()
    n, t = total["n"], total["t"] or 0
    fixed = [word_hash(w) for w in LEXICON]
    if not t or t == n:
        return np.unique(np.array(fixed, np.uint64))
    terms = train.mapInArrow(lean(count), "h long, n long, t long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    rate1, rate0 = (F.col("t") + 0.5) / (t + 1.0), (F.col("n") - F.col("t") + 0.5) / (n - t + 1.0)
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") - F.col("t") + 0.5))
    best = terms.where((F.col("t") >= max(MIN_SUPPORT, MIN_SHARE * t)) & (F.log(rate1 / rate0) - 2 * error >= F.log(F.lit(MIN_RATIO)))) \
        .orderBy((F.col("t") * F.log(rate1 / rate0)).desc(), "h").limit(MAX_VOTERS)
    found = [r["h"] & (2**64 - 1) for r in best.collect()]
    return np.unique(np.array(fixed + found, np.uint64))


# ------------------------------------------------------------ label model
@dataclass
class LabelModel:
    prior: float
    fire1: np.ndarray
    fire0: np.ndarray
    share: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """P(toxic | votes); each voter's evidence counts by its share."""
        on, off = np.log(self.fire1 / self.fire0), np.log((1 - self.fire1) / (1 - self.fire0))
        z = np.log(self.prior / (1 - self.prior)) + np.where(x, on * self.share, off * self.share).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(b: pa.RecordBatch, v: int) -> np.ndarray:
    return np.array(column(b, "x").to_pylist(), bool).reshape(-1, v)


def correlations(n: float, ones: np.ndarray, both: np.ndarray, triplets: int = 400) -> np.ndarray:
    """Correlation of voters beyond what the label they share explains.

    Under voters independent given the label, the covariance of two is
    ``a_i a_j``, so ``a_i**2 = C_ij C_ik / C_jk`` for any other two; a low
    quantile over many of them is not misled by a few correlated pairs."""
    v = len(ones)
    p = ones / n
    c = both / n - np.outer(p, p)
    scale = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-18))
    a = np.zeros(v)
    rng = np.random.default_rng(7)
    for i in range(v):
        others = np.array([j for j in range(v) if j != i])
        pairs = np.array([(j, k) for j in others for k in others if j < k]) if v <= 30 else \
            rng.choice(others, (triplets, 2))
        if not len(pairs):
            continue
        j, k = pairs[:, 0], pairs[:, 1]
        ok = (j != k) & (c[j, k] > 1e-9)
        if ok.any():
            a[i] = np.sqrt(np.quantile(np.abs(c[i, j[ok]] * c[i, k[ok]] / c[j[ok], k[ok]]), 0.4, method="lower"))
    rho = (c - np.outer(a, a)) / scale
    np.fill_diagonal(rho, 0)
    return np.clip(rho, -1, 1)


def fit_label_model(votes: DataFrame, v: int) -> LabelModel:
    """The generative model of the votes ``x array<boolean>``: first the
    voters' correlations, by which correlated ones share weight, then their
    accuracies by EM.  Each pass sends one row of sums a partition; nothing
    else leaves the executors."""
    def passed(run) -> np.ndarray:
        return np.sum([r["s"] for r in votes.mapInArrow(run, "s array<double>").collect()], axis=0)

    def sums(model: LabelModel | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = s = 0.0
            a1, a0 = np.zeros(v), np.zeros(v)
            for b in batches:
                x = _matrix(b, v)
                p = np.where(x.any(1), 0.9, 0.02) if model is None else model.posterior(x)
                n, s = n + len(x), s + p.sum()
                a1, a0 = a1 + p @ x, a0 + (1 - p) @ x
            yield pa.RecordBatch.from_arrays([pa.array([[n, s, *a1, *a0]], pa.list_(pa.float64()))], names=["s"])
        return run

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, ones, n = np.zeros((v, v)), np.zeros(v), 0.0
        for b in batches:
            x = _matrix(b, v).astype(float)
            both, ones, n = both + x.T @ x, ones + x.sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([[n, *ones, *both.ravel()]], pa.list_(pa.float64()))], names=["s"])

    got = passed(together)
    rho = correlations(max(got[0], 1.0), got[1:1 + v], got[1 + v:].reshape(v, v))
    share = 1 / (1 + np.where(rho > STRONG, rho, 0).sum(1))
    model = None
    for _ in range(EM_STEPS):
        got = passed(sums(model))
        n, s, a1, a0 = got[0], got[1], got[2:2 + v], got[2 + v:2 + 2 * v]
        fire1, fire0 = (a1 + 0.5) / (s + 1), (a0 + 0.05) / (n - s + 1)
        # a voter that fires rather on the other class says nothing
        model = LabelModel(prior=min(max((s + 1) / (n + 2), 1e-3), 0.5), share=share, fire0=np.clip(fire0, 1e-6, 1 - 1e-6),
                           fire1=np.clip(np.maximum(fire1, fire0), 1e-6, 1 - 1e-6))
    return model


# ------------------------------------------------------------ classifier
def bounded_patterns(weights: np.ndarray, bias: float, n_terms: int) -> np.ndarray:
    """``weights`` with those of the patterns (after ``n_terms`` terms) shrunk
    alike, so that all of them together, without a term, stay below
    ``PATTERN_LIMIT``: how a text is written doesn't make it toxic."""
    out = weights.copy()
    up = np.maximum(out[n_terms:], 0).sum()
    room = max(0.0, float(np.log(PATTERN_LIMIT / (1 - PATTERN_LIMIT))) - bias)
    if up > room:
        out[n_terms:] = np.where(out[n_terms:] > 0, out[n_terms:] * (room / up), out[n_terms:])
    return out


@dataclass
class ToxicityModel:
    terms: np.ndarray
    weights: np.ndarray
    bias: float
    labels: LabelModel | None = None

    def scores(self, col: pa.Array) -> np.ndarray:
        x = Features(self.terms).rows(col)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS) -> ToxicityModel:
    """Voters, label model and classifier from ``docs`` (doc_id, text) and
    ``labels`` (doc_id, toxic).

    Without usable labels (none, or one class only) the fixed lexicon and the
    patterns vote alone, at their prior weights."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    train = spread(materialize(training_rows(docs, labels, bound), "tox-train"))
    terms = induce_terms(train)
    feats = Features(terms)
    v = feats.size

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feats.rows(column(b, "text"))
            flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * v, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([column(b, "y"), flat], names=["y", "x"])

    votes = materialize(train.mapInArrow(lean(vote), "y int, x array<boolean>"), "tox-votes")
    plain = ToxicityModel(terms, np.r_[np.full(len(terms), 3.0), np.full(len(PATTERNS), 0.2)], -4.0)
    seen = votes.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).head()
    if not seen["n"] or not seen["t"] or seen["t"] == seen["n"]:
        return plain
    label_model = fit_label_model(votes, v)

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = label_model.posterior(_matrix(b, v))
            x = column(b, "x")
            for label, w in ((1.0, p), (0.0, 1 - p)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), label)), pa.array(w), x], names=["label", "w", "x"])

    soft = votes.mapInArrow(posterior, "label double, w double, x array<boolean>") \
        .select("label", "w", array_to_vector(F.transform("x", lambda c: c.cast("double"))).alias("features"))
    lr = LogisticRegression(weightCol="w", regParam=1e-3, maxIter=30, standardization=False).fit(soft.where("w > 0"))
    weights, bias = np.array(lr.coefficients.toArray()), float(lr.intercept)

    # probabilities: scale and shift fitted to the training labels
    margin = F.aggregate(F.zip_with("x", F.lit(weights.tolist()), lambda x, w: F.when(x, w).otherwise(0.0)),
                         F.lit(bias), lambda a, b: a + b)
    one = votes.select(F.col("y").cast("double").alias("label"), array_to_vector(F.array(margin)).alias("features"))
    cal = LogisticRegression(regParam=1e-6, maxIter=30).fit(one)
    scale = float(cal.coefficients[0])
    if scale <= 0:
        scale, shift = 1.0, 0.0
    else:
        shift = float(cal.intercept)
    weights, bias = weights * scale, bias * scale + shift
    return ToxicityModel(terms, bounded_patterns(weights, bias, len(terms)), bias, label_model)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col`` in 0..1 (an existing one of that
    name is replaced), in one pass without a shuffle.

    Null and empty texts get the score of no votes; repeated rows get equal
    scores; an empty table gives no rows."""
    cols = [c for c in docs.columns if c != score_col]
    src = docs.select(*[docs[f"`{c}`"] for c in cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.scores(b.column(cols.index(text_col))))],
                                             names=[*cols, score_col])
    return src.mapInArrow(lean(run), plus(src, score_col, "double"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; the same columns.

    Null and empty texts stay (no vote, no verdict); repeated rows stay or go
    together; an empty table gives no rows; other columns are kept as they are."""
    model = fit(docs, labels)
    cols = docs.columns
    return score_documents(docs, model, score_col="__toxicity").where(F.col("__toxicity") < threshold) \
        .select(*[F.col(f"`{c}`") for c in cols])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every whole text of ``documents``.  Null and empty
    texts get the score of no votes; texts of any length are read whole;
    repeated rows get equal scores; ties don't arise; an empty table gives no
    rows; only doc_id and text are read."""
    prepare(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
