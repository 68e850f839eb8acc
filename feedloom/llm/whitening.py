"""Embedding whitening from a covariance weighted by multiplicity.

1. Each vector becomes integers x = floor(64 c) + 1,000,000, written as one
   compact key: equal x vectors have equal keys, and the key gives x back.
2. Equal keys are counted (map-side first, so a vector that a third of all
   rows share is one row a task).  The distinct vectors, weighted by their
   counts (or by one), are the fit list.
3. Two passes over the distinct vectors: exact integer sums, then the
   weighted centred product X'WX, a block of rows at a time.  What reaches
   the driver is one matrix of the dimension squared, summed by Spark.
4. Every distinct vector is whitened once; its covariance is held against the
   identity; then it is joined back to the rows.  Vectors that many rows
   share are dealt out over salted keys in that join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, materialize, prepare

SCALE, SHIFT = 64, 1_000_000
#: Components returned at most.
COMPONENTS = 32
#: Entries beyond this many units count as not finite: x is exact below it.
LIMIT = 2.0**52
#: A vector with more than this share of all rows (one in ...) is salted in
#: the join; there are fewer such vectors than this.
HOT = 512
#: Rows of one product.
GEMM_ROWS = 4096
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


# ------------------------------------------------------------ keys
def keys_of(x: np.ndarray) -> list[bytes]:
    """Canonical bytes of each row of integers: the smallest width that
    holds all its entries around ``SHIFT``, then the entries."""
    y = x - SHIFT
    top = np.maximum(y.max(1), -(y.min(1) + 1)) if len(y) else np.zeros(0, np.int64)
    width = np.searchsorted([127, 32767, 2**31 - 1], top)
    out = [b""] * len(y)
    for k, kind in enumerate(_WIDTHS):
        at = np.flatnonzero(width == k)
        if not len(at):
            continue
        raw = np.ascontiguousarray(y[at].astype(kind)).view(np.uint8).reshape(len(at), -1)
        for i, r in zip(at, raw):
            out[i] = bytes([k]) + r.tobytes()
    return out


def vectors_of(keys: list[bytes], dim: int) -> np.ndarray:
    """The rows of integers that ``keys`` stand for."""
    out = np.zeros((len(keys), dim), np.int64)
    kind = np.array([k[0] for k in keys], np.int8)
    for k, t in enumerate(_WIDTHS):
        at = np.flatnonzero(kind == k)
        if len(at):
            out[at] = np.frombuffer(b"".join(keys[i][1:] for i in at), t).reshape(len(at), dim)
    return out + SHIFT


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, dim, key)`` of the usable rows: not null, not empty, every
    entry finite."""
    src = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vector_col].cast("array<double>").alias("v")) \
        .where("v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = column(b, "v")
            size = np.diff(v.offsets.to_numpy())
            # null entries come back as nan
            flat = np.floor(v.flatten().to_numpy(zero_copy_only=False).astype(float) * SCALE)
            bad = ~(np.abs(flat) < LIMIT)
            bads = np.r_[0, np.cumsum(bad)]
            ends = np.cumsum(size)
            ok = (bads[ends] == bads[ends - size]) & (size > 0)
            ids = column(b, "vec_id")
            for d in np.unique(size[ok]):
                at = np.flatnonzero(ok & (size == d))
                x = flat[(ends[at] - d)[:, None] + np.arange(d)].astype(np.int64) + SHIFT
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(np.full(len(at), d, np.int32)), pa.array(keys_of(x), pa.binary())],
                                                 names=["vec_id", "dim", "key"])
    return src.mapInArrow(run, "vec_id long, dim int, key binary")


# ------------------------------------------------------------ fit
@dataclass
class Whitening:
    """Sums of the fit list, its covariance's components and their scale."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def mean(self) -> np.ndarray:
        """S/n in double, about ``SHIFT``: the whole part exact."""
        return np.array([(s - self.n * SHIFT) / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - SHIFT) - self.mean()) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2, exact; null beyond 64 bits."""
        # y = x - SHIFT and its sums: n x - S = n y - T
        y, t = x - SHIFT, [s - self.n * SHIFT for s in self.sums]
        reach = max((abs(self.n * int(v)) + abs(u) for v, u in zip(np.abs(y).max(0), t)), default=0) if len(y) else 0
        if reach * reach * len(t) < 2**63:
            return ((self.n * y - np.array(t, np.int64)) ** 2).sum(1).tolist()
        total = [sum((self.n * int(a) - u) ** 2 for a, u in zip(r, t)) for r in y]
        return [v if v < 2**63 else None for v in total]


def _sum_rows(parts: DataFrame) -> np.ndarray:
    """Sums ``(i, row array<double>)`` by i and entry in Spark; one matrix."""
    got = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((1 + max(r["i"] for r in got), 1 + max(r["j"] for r in got))) if got else np.zeros((0, 0))
    for r in got:
        out[r["i"], r["j"]] = r["v"]
    return out


def _matrix_rows(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(m), dtype=np.int32)), pa.array(m.tolist(), pa.list_(pa.float64()))], names=["i", "row"])


def _blocks(b: pa.RecordBatch, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lo in range(0, len(b), GEMM_ROWS):
        part = b.slice(lo, GEMM_ROWS)
        yield vectors_of(column(part, "key").to_pylist(), dim), column(part, "weight").to_numpy()


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Components of ``distinct (key, weight long)``."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * dim
        for b in batches:
            for x, w in _blocks(b, dim):
                n += int(w.sum())
                # exact: entries halved into two parts of 26 bits
                y = x - SHIFT
                hi, lo = y >> 26, y & (2**26 - 1)
                s = [a + (int(h) << 26) + int(q) for a, h, q in zip(s, w @ hi, w @ lo)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([str(v) for v in [n, *s]])], names=["i", "v"])

    # sums of integers beyond 64 bits stay exact as decimals
    total = {r["i"]: int(r["v"]) for r in distinct.mapInArrow(sums, "i int, v string").groupBy("i")
             .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    n = total[0]
    w = Whitening(n, [total[j + 1] + n * SHIFT for j in range(dim)], np.zeros((dim, 0)), np.zeros(0), 0.0)
    mean = w.mean()

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.zeros((dim, dim))
        for b in batches:
            for x, wt in _blocks(b, dim):
                z = (x - SHIFT) - mean
                c += z.T @ (z * wt[:, None])
        yield _matrix_rows(c)

    v = _sum_rows(distinct.mapInArrow(product, "i int, row array<double>")) / n
    value, vector = np.linalg.eigh((v + v.T) / 2)
    value, vector = value[::-1], vector[:, ::-1]
    # components without variance can't be scaled to one
    keep = int((value > max(value[0], 0) * dim * 1e-12).sum()) if value[0] > 0 else 0
    keep = min(keep, components)
    return Whitening(n, w.sums, vector[:, :keep], value[:keep], float(np.trace(v)))


def whiten_vectors(rows: DataFrame, components: int = COMPONENTS, weights: str = "counts",
                   id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every usable row of ``rows``: vec_id, copies,
    n, deviation, whitened array<double>, explained array<double>,
    identity_error.

    ``weights``: ``counts`` fits on all rows, ``one`` on distinct vectors.

    Rows whose vector is null, empty or holds null or non-finite entries (or
    entries beyond 2**52 / 64) are left out; if dimensions differ, so are
    those not of the commonest (ties: the larger).  Null ids are kept; equal
    rows get equal results; a long vector costs its dimension squared;
    components without variance are left out, so rows that are all equal have
    empty arrays; an empty table gives no rows; other columns are not read."""
    spark = rows.sparkSession
    kind = "vec_id long, copies long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    at = materialize(integer_vectors(rows, id_col, vector_col), "whitening-rows")
    common = at.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).head()
    if common is None:
        return spark.createDataFrame([], kind)
    dim, rows_n = int(common["dim"]), int(common["count"])
    at = at.where(F.col("dim") == dim).select("vec_id", "key")
    copies = at.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    distinct = materialize(copies.withColumn("weight", F.col("copies") if weights == "counts" else F.lit(1).cast("long")), "whitening-distinct")
    model = fit(distinct, dim, components)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), GEMM_ROWS):
                part = b.slice(lo, GEMM_ROWS)
                x = vectors_of(column(part, "key").to_pylist(), dim)
                yield pa.RecordBatch.from_arrays([column(part, "key"), column(part, "copies"), column(part, "weight"), pa.array(model.deviations(x), pa.int64()),
                                                  pa.array(list(model.whiten(x)), pa.list_(pa.float64()))],
                                                 names=["key", "copies", "weight", "deviation", "whitened"])

    white = materialize(distinct.mapInArrow(run, "key binary, copies long, weight long, deviation long, whitened array<double>"), "whitened")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted products of (1, whitened): sums and second moments."""
        c = np.zeros((k + 1, k + 1))
        for b in batches:
            z = np.concatenate([np.ones((len(b), 1)), column(b, "whitened").flatten().to_numpy().reshape(len(b), k)], 1)
            c += z.T @ (z * column(b, "weight").to_numpy()[:, None])
        yield _matrix_rows(c)

    error = 0.0
    if k:
        m = _sum_rows(white.select("weight", "whitened").mapInArrow(moments, "i int, row array<double>")) / model.n
        error = float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max())
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values]).cast("array<double>")
    return _joined(at, white.drop("weight"), rows_n).select(
        "vec_id", "copies", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"))


def _joined(at: DataFrame, white: DataFrame, rows_n: int) -> DataFrame:
    """``at (vec_id, key)`` with the columns of ``white`` of its key.

    A key with more than one row in ``HOT`` is salted; such keys are fewer
    than ``HOT``, which bounds what is broadcast."""
    hot = white.where(F.col("copies") * HOT > rows_n) \
        .select("key", F.ceil(F.col("copies") * HOT / rows_n).cast("int").alias("parts"))
    left = at.join(F.broadcast(hot), "key", "left") \
        .withColumn("salt", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))) \
        .select("vec_id", "key", "salt")
    parts = F.when(F.col("copies") * HOT > rows_n, F.ceil(F.col("copies") * HOT / rows_n).cast("int")).otherwise(1)
    right = white.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    return left.join(right, ["key", "salt"])


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector of ``embeddings``, one row a
    vector and component.  Nulls, odd vectors, repeats and empty tables: as
    stated by ``whiten_vectors``."""
    prepare(spark)
    w = whiten_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return w.select("vec_id", F.posexplode("whitened").alias("at", "whitened"), "n", "deviation", "explained", "identity_error") \
        .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                F.get("explained", F.col("at")).alias("explained"), "identity_error")
