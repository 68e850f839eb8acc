"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its 2-word shingles (lower-cased A-Z) with their
counts.  Each of SAMPLES coordinates draws, from a hash of the term alone,
``r, c ~ Gamma(2, 1)`` and ``b ~ U(0, 1)``; with weight ``w`` it takes
``t = floor(ln w / r + b)`` and the value ``ln c - r (t + 1 - b)``.  The term
with the smallest value, together with its ``t``, is the sample.  Two texts
share a coordinate with probability equal to their generalised Jaccard
similarity (sum of minima over sum of maxima).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, documents, mix, prepare, range_number, range_splits, shingle_hashes, shuffle_width, text_rows, word_hashes

SAMPLES = 64
SHINGLE = 2
#: Texts are fingerprinted in blocks of about this many bytes; tables of
#: values are made for this many terms at once.
BLOCK_BYTES, TERM_BLOCK = 1 << 20, 2048
_QUANTILES = 1 << 14


def _gamma2_quantiles() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x)."""
    p = (np.arange(_QUANTILES) + 0.5) / _QUANTILES
    x = np.full(_QUANTILES, 1.7)
    for _ in range(60):
        x = np.maximum(x - ((1 - (1 + x) * np.exp(-x)) - p) / np.maximum(x * np.exp(-x), 1e-300) * 0.5, x * 0.1)
    return x


_GAMMA = _gamma2_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_ODD = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sample_keys(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each term and coordinate one number: the value in the upper half
    (in its order), the sample's identity in the lower."""
    x = terms[:, None] * _ODD[None, :]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    r = _GAMMA[(x >> np.uint64(50)).astype(np.int32)]
    lnc = _LOG_GAMMA[((x >> np.uint64(36)) & np.uint64(_QUANTILES - 1)).astype(np.int32)]
    b = ((x >> np.uint64(12)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
    many = np.flatnonzero(weights > 1)
    value = lnc - r * (1 - b)
    ident = x & np.uint64(0xFFFFFFFF)
    if len(many):
        t = np.floor(np.log(weights[many]).astype(np.float32)[:, None] / r[many] + b[many])
        value[many] = lnc[many] - r[many] * (t + 1 - b[many])
        ident[many] ^= (t.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
    bits = value.view(np.int32)
    order = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) + (1 << 31)
    return (order.astype(np.uint64) << np.uint64(32)) | ident


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of SAMPLES 16-bit numbers for each text; zeros for one without words."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    w, first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), off)
    sh = [shingle_hashes(w[first[i]:first[i + 1]], SHINGLE) for i in range(len(texts))]
    count = np.array([len(s) for s in sh])
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    if not count.sum():
        return out
    term = np.concatenate(sh)
    row = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((term, row))
    term, row = term[order], row[order]
    new = np.r_[True, (term[1:] != term[:-1]) | (row[1:] != row[:-1])]
    at = np.flatnonzero(new)
    weight = np.diff(np.r_[at, len(term)])
    term, row = term[at], row[at]
    # each (term, weight) is drawn once, however many texts hold it
    key = mix(term) + weight.astype(np.uint64)
    _, pick, back = np.unique(key, return_index=True, return_inverse=True)
    drawn = np.empty((len(pick), SAMPLES), np.uint64)
    for lo in range(0, len(pick), TERM_BLOCK):
        p = pick[lo:lo + TERM_BLOCK]
        drawn[lo:lo + TERM_BLOCK] = sample_keys(term[p], weight[p])
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    ends = np.r_[starts[1:], len(row)]
    for lo, hi in zip(starts, ends, strict=True):
        low = None
        for a in range(lo, hi, TERM_BLOCK):
            m = drawn[back[a:min(hi, a + TERM_BLOCK)]].min(0)
            low = m if low is None else np.minimum(low, m)
        out[row[lo]] = (low & np.uint64(0xFFFF)).astype(np.uint16) ^ ((low >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates."""
    return (a == b).mean(-1)


def edited_text(text: str, nxt: str) -> str:
    """The last half of the code points replaced by the next text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + nxt[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (bucket, role, doc_id, text): each row of role 0 against the row
    after it in its bucket."""
    held: list[tuple[int, int, int | None, str]] = []
    size = 0

    def flush(rows: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch | None:
        pairs = [i for i in range(len(rows) - 1) if rows[i][1] == 0 and rows[i][0] == rows[i + 1][0]]
        if not pairs:
            return None
        edited = [edited_text(rows[i][3], rows[i + 1][3]) for i in pairs]
        fp = fingerprints([r[3] for r in rows] + edited)
        own, nxt, ed = fp[pairs], fp[[i + 1 for i in pairs]], fp[len(rows):]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in pairs], pa.int64()), pa.array([len(rows[i][3]) for i in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
            pa.array([x.tobytes().hex() for x in own]), pa.array([x.tobytes().hex() for x in ed]),
            pa.array(likeness(own, ed)), pa.array(likeness(own, nxt))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    for b in batches:
        for r in zip(column(b, "bucket").to_pylist(), column(b, "role").to_pylist(), column(b, "doc_id").to_pylist(),
                     column(b, "text"), strict=True):
            held.append((r[0], r[1], r[2], r[3].as_py() or ""))
            size += 4 * len(held[-1][3])
            if size > BLOCK_BYTES:
                if (got := flush(held)) is not None:
                    yield got
                # the last row is still to be compared with the next
                held = held[-1:]
                size = 0
    if (got := flush(held)) is not None:
        yield got


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness; see
    ``edited_text``.  The next document is the one with the next smaller id;
    the smallest id's is the largest.

    Rows are dealt into ranges of ids (one shuffle of the texts); a range also
    gets the first row of the range after it.  Null texts count as empty; null
    ids come after all others; rows of equal id follow each other by a hash of
    their text; a single row is its own next; an empty table gives no rows."""
    rows = text_rows(docs, id_col, text_col)
    width = shuffle_width(docs.sparkSession)
    lowest = int(np.iinfo(np.int64).min)
    order = F.coalesce("doc_id", F.lit(lowest))
    bucket = range_number(order, range_splits(rows, "doc_id", 4 * width))
    # one number a range; the first row of each is copied to the range before
    # it (that of the largest ids to the range of the smallest)
    heads = sorted((r["bucket"], r["head"]) for r in rows.select(bucket.alias("bucket"), order.alias("head"))
                   .groupBy("bucket").agg(F.max("head").alias("head")).collect())
    if not heads:
        return docs.sparkSession.createDataFrame([], OUT)
    before = [0] * (heads[-1][0] + 1)
    for i, (b, _) in enumerate(heads):
        before[b] = heads[(i + 1) % len(heads)][0]
    to = F.element_at(F.array(*[F.lit(x) for x in before]), F.col("own") + 1)
    own = rows.select("doc_id", "text", bucket.alias("own"), order.isin([h for _, h in heads]).alias("first"))
    places = F.when(F.col("first"), F.array("own", to)).otherwise(F.array("own"))
    dealt = own.select("doc_id", "text", F.posexplode(places).alias("role", "bucket"))
    return dealt.repartition(width, "bucket") \
        .sortWithinPartitions("bucket", "role", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")) \
        .select("bucket", "role", "doc_id", "text").mapInArrow(_compare, OUT)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and of its edited
    text.  Nulls, empty and long texts, repeats, ties and empty tables: as
    stated by ``fingerprint_documents``."""
    prepare(spark)
    return fingerprint_documents(documents(spark, sf_dir))
