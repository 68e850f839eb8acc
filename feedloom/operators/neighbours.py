"""Nearest neighbours of embedding vectors by cosine, over a
random-hyperplane index with multi-probe.

Index: ``bits`` orthonormal hyperplanes (drawn from a seed) give each unit
vector a cell number.  A vector x that lies beyond hyperplanes F of a query q
has ``cos(q, x) <= sqrt(1 - sum((q.h_j)^2 for j in F))``: the sum is the
cell's penalty, and cells are probed by growing penalty.

* ``reach`` given: a query probes every cell with a penalty up to it
  (approximate; ``calibrate`` finds the reach that holds a wanted share of
  the true neighbours of a bounded sample of queries).
* ``reach`` None: exact.  A query probes its own cell first; its k-th best
  cosine there bounds the penalty of any cell that can hold a better one.

Cells and the queries that probe them meet in blocks of bounded size: a cell
with many vectors is split by a further hash, one with many queries too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a cell aimed at; vectors and queries of a block at most about so many.
CELL_ROWS, BLOCK_ROWS = 1024, 4096
MAX_BITS = 20
#: Cosines are compared at this many decimals (ties: the smaller id).
DECIMALS = 6
#: Queries of the calibration sample at most.
SAMPLE = 200


def unit_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int | None = None) -> DataFrame:
    """``(id, v)`` scaled to length 1.  Rows without a direction are left
    out: null, empty, zero, with null or non-finite entries, of another
    dimension."""
    v = df[vector_col].cast("array<double>")
    d = df.select(df[id_col].cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    if dim is not None:
        d = d.where(F.size("v") == dim)
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    d = d.where(finite).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    return d.where((F.col("norm") > 0) & (F.col("norm") < float("inf"))).select("id", F.transform("v", lambda x: x / F.col("norm")).alias("v"))


def hyperplanes(dim: int, bits: int, seed: int = 11) -> np.ndarray:
    """``dim x bits`` orthonormal columns."""
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, bits)))[0] if bits else np.zeros((dim, 0))


def bits_for(n: int, dim: int) -> int:
    return min(max(0, int(np.ceil(np.log2(max(n, 1) / CELL_ROWS)))), dim, MAX_BITS)


def _rows(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def with_cells(unit: DataFrame, planes: np.ndarray) -> DataFrame:
    """``unit (id, v)`` with the number of the cell each is in."""
    dim, bits = planes.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            side = _rows(b.column(1), dim) @ planes >= 0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(side @ (1 << np.arange(bits)), pa.int64())], names=["id", "v", "cell"])
    return unit.select("id", "v").mapInArrow(run, "id long, v array<double>, cell long")


def probes(queries: DataFrame, planes: np.ndarray) -> DataFrame:
    """``queries (id, v, low, high)`` by the cells whose penalty is over
    ``low`` and up to ``high``: ``(id, v, cell)``."""
    dim, bits = planes.shape
    # which hyperplanes lie between a query's cell and the one whose number differs by a mask
    masks = np.arange(1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _rows(b.column(1), dim) @ planes
            own = (p >= 0) @ (1 << np.arange(bits))
            low, high = b.column(2).to_numpy(), b.column(3).to_numpy()
            for i in range(len(b)):
                penalty = np.zeros(1)
                for j in range(bits):
                    penalty = np.concatenate([penalty, penalty + p[i, j] ** 2])
                cells = own[i] ^ masks[(penalty > low[i]) & (penalty <= high[i])]
                if len(cells):
                    at = pa.array(np.full(len(cells), i))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(cells, pa.int64())], names=["id", "v", "cell"])
    return queries.select("id", "v", "low", "high").mapInArrow(run, "id long, v array<double>, cell long")


def _split(side: DataFrame, own: str, other: str) -> DataFrame:
    """Rows by block: their own part of the cell, and every part of the other side."""
    part = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
    return side.select("id", "v", "cell", part.alias(f"{own}_part"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_part"))


def best_in_cells(index: DataFrame, probing: DataFrame, k: int, dim: int) -> DataFrame:
    """``(id, neighbour, similarity)``: the ``k`` best of every query in the
    cells it probes, and perhaps more."""
    rows = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    asked = probing.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    parts = rows.join(asked, "cell").select("cell", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("r"), F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("q"))
    left = _split(index.join(parts, "cell"), "r", "q").withColumnRenamed("r_part", "a").withColumnRenamed("q_part", "b").withColumn("asks", F.lit(False))
    right = _split(probing.join(parts, "cell"), "q", "r").withColumnRenamed("q_part", "b").withColumnRenamed("r_part", "a").withColumn("asks", F.lit(True))

    def compare(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        asks = t["asks"].to_numpy(zero_copy_only=False)
        ids = t["id"].to_numpy()
        v = _rows(t["v"].combine_chunks(), dim)
        out: list[list] = [[], [], []]
        x, at = v[~asks], ids[~asks]
        for lo in range(0, int(asks.sum()) if len(x) else 0, 256):
            q, qid = v[asks][lo:lo + 256], ids[asks][lo:lo + 256]
            s = np.round(q @ x.T, DECIMALS) + 0.0
            s[qid[:, None] == at[None, :]] = -np.inf
            for i in range(len(q)):
                top = np.lexsort((at, -s[i]))[:k] if len(at) <= 4 * k else _top(s[i], at, k)
                top = top[np.isfinite(s[i][top])]
                out[0] += [int(qid[i])] * len(top)
                out[1] += at[top].tolist()
                out[2] += s[i][top].tolist()
        return pa.table({"id": pa.array(out[0], pa.int64()), "neighbour": pa.array(out[1], pa.int64()), "similarity": pa.array(out[2], pa.float64())})

    both = left.select("cell", "a", "b", "asks", "id", "v").unionByName(right.select("cell", "a", "b", "asks", "id", "v"))
    return both.groupBy("cell", "a", "b").applyInArrow(compare, "id long, neighbour long, similarity double")


def _top(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest (ties: the smaller id)."""
    least = np.partition(s, len(s) - k)[len(s) - k]
    some = np.flatnonzero(s >= least)
    return some[np.lexsort((ids[some], -s[some]))[:k]]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, numbered."""
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("id", "rank", "neighbour", "similarity")


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10, reach: float | None = None, id_col: str = "vec_id",
               vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query row among all rows: ``id, rank,
    neighbour, similarity``.

    ``reach``: see the module.  Ids are taken as unique; a row is no neighbour
    of itself; rows without a direction (or an id) are neither queries nor
    neighbours; an empty table gives no rows."""
    from feedloom.sources.io import written
    spark = vectors.sparkSession
    shape = vectors.where(f"{vector_col} is not null and size({vector_col}) > 0").groupBy(F.size(vector_col).alias("dim")) \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).head()
    if shape is None:
        return spark.createDataFrame([], "id long, rank int, neighbour long, similarity double")
    dim = int(shape["dim"])
    planes = hyperplanes(dim, bits_for(int(shape["n"]), dim))
    index = written(with_cells(unit_vectors(vectors, id_col, vector_col, dim), planes), "cells")
    asked = index.join(vectors.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi").select("id", "v")
    if reach is not None:
        return ranked(best_in_cells(index, probes(asked.withColumn("low", F.lit(-1.0)).withColumn("high", F.lit(float(reach))), planes), k, dim), k)
    first = written(ranked(best_in_cells(index, probes(asked.withColumn("low", F.lit(-1.0)).withColumn("high", F.lit(0.0)), planes), k, dim), k), "nearest")
    # a cell with a larger penalty can't hold a better one (the margin covers the rounding)
    s = F.col("s") - 2 * 10.0**-DECIMALS
    bound = first.where(F.col("rank") == k).select("id", F.col("similarity").alias("s"))
    rest = asked.join(bound, "id", "left").select("id", "v", F.lit(0.0).alias("low"), F.when(s > 0, 1 - s * s).otherwise(float(dim)).alias("high"))
    return ranked(first.drop("rank").unionByName(best_in_cells(index, probes(rest, planes), k, dim)), k)


def calibrate(vectors: DataFrame, is_query: Column, k: int = 10, recall: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The reach that holds ``recall`` of the true neighbours of at most
    ``SAMPLE`` queries (those with the smallest hash of their id)."""
    picked = vectors.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    few = vectors.join(F.broadcast(picked), vectors[id_col].cast("long") == picked["id"], "left").withColumn("__few", F.col("id").isNotNull())
    true = neighbours(few.select(vectors[id_col], vectors[vector_col], "__few"), F.col("__few"), k, None, id_col, vector_col).select("id", "neighbour")
    unit = unit_vectors(vectors, id_col, vector_col)
    pairs = true.join(unit.select("id", F.col("v").alias("q")), "id").join(unit.select(F.col("id").alias("neighbour"), F.col("v").alias("x")), "neighbour") \
        .select("q", "x").collect()
    if not pairs:
        return 0.0
    q, x = np.array([r["q"] for r in pairs]), np.array([r["x"] for r in pairs])
    planes = hyperplanes(q.shape[1], bits_for(vectors.count(), q.shape[1]))
    p = q @ planes
    return float(np.quantile(np.where((p >= 0) != (x @ planes >= 0), p**2, 0).sum(1), recall, method="higher"))
