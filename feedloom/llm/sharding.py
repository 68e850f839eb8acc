"""Sharding by a Feistel permutation with cycle walking (DataFrame functions only).

Every row gets a global number 0..N-1.  A keyed Feistel network over
``rows x cols`` (a near-square grid holding N) permutes the numbers; values
that leave 0..N-1 walk on through the network until they return.
``shard = p mod shards`` and ``slot = p div shards`` then follow from the
number alone: shard sizes differ by one at most, slots have no gaps, and the
same rows, key and shard count always give the same result.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, prepare

ROUNDS = 6
#: The grid has fewer than ``isqrt(N) + 2`` cells beyond N, so about one pass
#: in sqrt(N) leaves the range.  A walk can pass each outside cell once at
#: most; up to N = 48**2 that is within WALK steps, and beyond it a longer
#: walk has probability below N**-24.  One that long raises an error.
WALK = 48
#: Rows of a numbering block; only one count a block is summed in one place.
BLOCK_ROWS = 100_000
#: Copies of a row that are numbered at a time.
COPY_STEP = 4096
#: Least number of blocks, whatever the session's shuffle width: the numbers
#: must not depend on it.
LEAST_BLOCKS = 1024


def _network(x: Column, rows: int, cols: int, key: str) -> Column:
    """One pass: (a, b) -> (b, a + F(b) mod m) with m alternating, a bijection."""
    rounds = F.array(*[F.struct(F.lit(f"{key}/{i}").alias("k"), F.lit(rows if i % 2 == 0 else cols).cast("long").alias("m"))
                       for i in range(ROUNDS)])
    c = F.lit(cols).cast("long")
    start = F.struct(((x - x % c) / c).cast("long").alias("a"), (x % c).alias("b"))
    end = F.aggregate(rounds, start, lambda s, r: F.struct(
        s["b"].alias("a"), F.pmod(s["a"] + F.pmod(F.xxhash64(r["k"], s["b"]), r["m"]), r["m"]).alias("b")))
    return F.transform(F.array(end), lambda s: s["a"] * c + s["b"])[0]


def permute(x: Column, n: int, key: str) -> Column:
    """Keyed permutation of 0..n-1."""
    rows = isqrt(n - 1) + 1 if n > 1 else 1
    cols = -(-n // rows)
    n_ = F.lit(n).cast("long")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), _network(x, rows, cols, key),
                         lambda p, _: F.when(p < n_, p).otherwise(_network(p, rows, cols, key)))
    return F.transform(F.array(walked), lambda p: F.when(p < n_, p).otherwise(
        F.raise_error(F.lit("cycle walk too long")).cast("long")))[0]


def number_rows(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with a gapless column ``row`` in 0..n-1 that depends on their
    values only.

    Equal rows are counted first, so no block holds a hot value more than
    once; blocks are numbered by a running sum of their counts."""
    cols = rows.columns
    blocks = max(LEAST_BLOCKS, -(-n // BLOCK_ROWS))
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")) \
        .withColumn("__block", F.pmod(F.xxhash64(*cols), F.lit(blocks)))
    totals = groups.groupBy("__block").agg(F.sum("__n").alias("__total"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__block").orderBy(*[F.col(c).asc_nulls_first() for c in cols]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    first = groups.withColumn("__first", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    # copies of a row are numbered in two steps, so no array holds them all
    step = F.lit(COPY_STEP).cast("long")
    return first.join(offsets, "__block") \
        .select(*cols, (F.col("__offset") + F.col("__first")).alias("__start"), "__n",
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, step)).alias("__lo")) \
        .select(*cols, "__start", F.explode(F.sequence(F.col("__lo"), F.least(F.col("__lo") + step, F.col("__n")) - 1)).alias("__i")) \
        .select(*cols, (F.col("__start") + F.col("__i")).alias("row"))


def assign_shards(docs: DataFrame, shards: int = 16, key: str = "shuffle-1",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row of ``docs``.

    Returns doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 (null
    text: of no bytes), law (``rows``), shard, slot, grown_shard (null).

    Null ids are a value like any other; empty and repeated rows each get a
    number of their own; an empty table gives no rows; other columns are not
    read, whatever their names."""
    text = F.coalesce(docs[text_col].cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    n = docs.count()
    p = permute(F.col("row"), max(n, 1), key)
    placed = number_rows(rows, max(n, 1)).withColumn("p", p)
    s = F.lit(shards).cast("long")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                         (F.col("p") % s).cast("int").alias("shard"),
                         ((F.col("p") - F.col("p") % s) / s).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of ``documents`` in 16 shards.  Nulls,
    empty and long texts, repeats and empty tables: as stated by
    ``assign_shards``; ties (equal rows) get numbers of their own."""
    prepare(spark)
    return assign_shards(documents(spark, sf_dir), 16)
