"""Helpers shared by the operators: Arrow text access, vectorised word
hashes, size-checked broadcast joins, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from feedloom.functions.workers import lean  # noqa: F401
from feedloom.session import apply_conf, ensure_checkpoint_dir, ship_package

U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Session settings, shared checkpoint folder and shipped package."""
    apply_conf(spark)
    # sides that grow with the corpus are shuffled alike at every size; a
    # broadcast of megabytes would weigh on the driver
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "256KB")
    # whole texts go to Python: batches of a few megabytes, which each task
    # holds outside the heap and in its worker
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage through storage that outlives any executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes what ``materialize`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``(doc_id, text)`` and nothing else, whatever other columns exist."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), *more)


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """Deal rows over the session's shuffle width (used before CPU-heavy
    stages whose input is a few large files)."""
    return df.repartition(least or shuffle_width(df.sparkSession))


#: A side of a join is broadcast only when its counted rows times this many
#: bytes stay under the bound; else the join shuffles.
BROADCAST_BYTES = 8 << 20


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is under
    ``BROADCAST_BYTES``; unchanged (shuffle join) beyond it."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def range_splits(df: DataFrame, col: str, buckets: int) -> list[int]:
    """At most ``buckets - 1`` ascending values of an integer column that cut
    its rows into near-equal ranges; row ``r`` is in range ``searchsorted(splits, r, "right")``.

    The values are approximate quantiles (a mergeable sketch, one number a
    range reaches the driver), so they hold for any distribution of the ids."""
    if buckets < 2:
        return []
    q = [i / buckets for i in range(1, buckets)]
    r = df.agg(F.percentile_approx(col, q, max(10_000, 10 * buckets)).alias("q")).head()["q"]
    return sorted(set(r or []))


def range_number(value: Column, splits: list[int]) -> Column:
    """Number of splits that are at most ``value``: a binary search over a
    literal array, all in the JVM."""
    if not splits:
        return F.lit(0)
    cuts = F.array(*[F.lit(x) for x in splits])

    def half(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        up = F.element_at(cuts, F.least(mid, F.lit(len(splits) - 1)) + 1) <= value
        return F.when(s["lo"] >= s["hi"], s).when(up, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))) \
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(0), F.lit(len(splits).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi")), half, lambda s: s["lo"])


# ------------------------------------------------------------ Arrow text
def utf8_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``n + 1`` offsets of a string column, without copying the
    text.  Null rows have length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    kind = np.int64 if wide else np.int32
    if bufs[1] is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def row_blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def plus(df: DataFrame, name: str, kind: str | DataType) -> StructType:
    """Schema of ``df`` and one more column (``df`` keeps its own)."""
    return StructType([*df.schema.fields]).add(name, kind)


def ids_of(batch: pa.RecordBatch, name: str = "doc_id") -> list:
    return column(batch, name).to_pylist()


# ------------------------------------------------------------ hashing
def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two multiply-xorshift rounds)."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
RADIX = int(_RNG.integers(2**62, 2**63, dtype=np.uint64)) | 1
RADIX_INV = pow(RADIX, -1, 2**64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, U64)
        have[1:] = U64(base)
        have = np.cumprod(have, dtype=U64)
        if size <= 1 << 21:
            # kept: what blocks of a megabyte need, not what a rare long text does
            _POWERS[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``out[j] - out[i]`` times ``RADIX**-i`` is a hash of ``data[i:j]``."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * powers(RADIX, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Content hash of each ``data[start:end]`` (equal content, equal hash)."""
    h = (prefix[ends] - prefix[starts]) * powers(RADIX_INV, len(prefix))[starts]
    return mix(h + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes that ``space`` does not mark; by default
    ``[^\\x20\\x09-\\x0D]+``) of consecutive documents: start, end (byte positions) and, of length documents + 1, the first word of each document.
    A document's end always ends a word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased (A-Z) word of consecutive documents, and the
    first word of each document (length documents + 1)."""
    low = LOWER[data]
    starts, ends, first = words(low, offsets)
    return span_hash(prefix_hash(low), starts, ends), first


def shingle_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; the whole sequence as one if it is
    shorter, nothing if it is empty."""
    if not len(w):
        return w
    size = min(size, len(w))
    n = len(w) - size + 1
    h = w[:n].copy()
    for j in range(1, size):
        h = h * U64(0x9E3779B97F4A7C15) + w[j:j + n]
    return mix(h + U64(size))


# ------------------------------------------------------------ packing
def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes (all first bytes, all second ones, ..), compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays if len(a))
    return zstandard.ZstdCompressor(level=1).compress(planes)


def expand(data: bytes, *kinds: tuple[str, int]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=sum(np.dtype(k).itemsize * n for k, n in kinds)) \
        if any(n for _, n in kinds) else b""
    out, at = [], 0
    for k, n in kinds:
        w = np.dtype(k).itemsize
        planes = np.frombuffer(raw, np.uint8, w * n, at).reshape(w, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(k))
        at += w * n
    return out


def groups(key: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys and the items of each."""
    order = np.argsort(key, kind="stable")
    key, items = key[order], items[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[cut], np.split(items, cut[1:]) if len(key) else []


# ------------------------------------------------------------ components
def _stars(edges: DataFrame) -> bool:
    """Is every node either a root or linked with one root alone?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")) \
        .union(edges.select(F.col("b").alias("node"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return seen.where("out > 1 or (out = 1 and in = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges (a, b)``; ``comp`` is the
    smallest node reachable.

    Alternates large-star and small-star steps until the edges are stars.
    Each step is a grouped minimum (combined before the shuffle) and a join
    whose large side may be split, so a hub never has to fit in one task.
    Every step is written to the shared folder."""
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not _stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = materialize(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def merge_labels(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``(node, comp)`` after adding ``edges (a, b)`` to the graph of which
    ``labels`` gives the components: only the new edges, between components,
    are contracted.  Nodes without edges aren't listed."""
    if labels is None:
        return materialize(components(edges), "labels")
    a, b = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    between = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    new = materialize(components(between), "labels")
    moved = labels.join(new, labels["comp"] == new["node"], "left").select(labels["node"], F.coalesce(new["comp"], labels["comp"]).alias("comp"))
    added = new.join(labels.select("node"), "node", "left_anti")
    return materialize(moved.union(added.select("node", "comp")), "labels")
