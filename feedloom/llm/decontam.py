"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over a few consecutive words; positions that the mask
ignores may differ.

1. Every mask is slid over the benchmark items and over the documents.  A bit
   filter of the items' seeds, of fixed size whatever the benchmark's, keeps
   most seeds of the documents out of the exchange.
2. Join: seeds of both sides meet on their hash.  Each hit fixes an item, a
   text and an offset between them; equal ones are merged.
3. Verify: the words of the text around each offset meet the item's words and
   are compared one by one, so that up to 20 % of substituted words are
   tolerated.

Equal texts are one text up to the end.  Nothing but the filter passes
through the driver, and either side may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, documents, lean, materialize, maybe_broadcast, mix, prepare, row_blocks, utf8_view, word_hashes

#: 1: the word counts, 0: it may differ.  Fixed masks of weight 4 or 5; any
#: 13 words with at most 2 substitutions contain a hit of at least one.
MASKS = ("11111", "110101", "1101001", "1011001", "11000101", "10100011", "1001011", "100100101")
#: An overlap is this many consecutive words of an item with at least 80 of
#: 100 equal.
WINDOW = 13
#: Shorter items are matched whole, below EDITED words without substitutions.
#: Any EDITED words or more with 80 of 100 equal contain a hit of a mask, too.
EDITED = 8
#: Items below the shortest mask have one seed each, all their words.
SHORT = ("1", "11", "111", "1111")
#: Bits of the filter (two a seed): 2 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 24


def _needed(words: int) -> int:
    """Equal words that an overlap of this length needs."""
    return -(-words * 80 // 100) if words >= EDITED else words


def spaced_hashes(w: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hash of the mask's words at each start."""
    n = len(w) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, salt * 2 + 1, np.uint64)
    for j, c in enumerate(mask):
        if c == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:j + n]
    return mix(h)


def item_seeds(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the seeds of an item's words."""
    if not len(w):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    masks = list(enumerate(MASKS)) if len(w) > len(SHORT) else [(len(MASKS) + len(w) - 1, SHORT[len(w) - 1])]
    hs = [spaced_hashes(w, mask, m) for m, mask in masks]
    return np.concatenate(hs), np.concatenate([np.arange(len(h)) for h in hs])


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.uint64(64 - (FILTER_BITS.bit_length() - 1))
    return (h >> top).astype(np.int64), (mix(h) >> top).astype(np.int64)


def verify(same: np.ndarray) -> tuple[int, int, int] | None:
    """First and last equal place and the number of equal ones of an item
    laid on a text, over all windows that pass; None if none does."""
    size = min(WINDOW, len(same))
    c = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(c[size:] - c[:-size] >= _needed(size))
    if not len(good):
        return None
    x, y = good[0], good[-1] + size
    idx = np.flatnonzero(same[x:y])
    x, y = x + idx[0], x + idx[-1] + 1
    return int(x), int(y), int(c[y] - c[x])


# ------------------------------------------------------------ stages
def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, ik, words)``: distinct items with the hashes of their words;
    ``ik`` is the content of id and text."""
    rows = benchmark.select(benchmark[id_col].cast("long").alias("item_id"), benchmark[text_col].cast("string").alias("text")) \
        .where("text is not null").distinct().withColumn("ik", F.xxhash64("item_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8_view(column(b, "text"))
            w, first = word_hashes(data, off)
            yield pa.RecordBatch.from_arrays([column(b, "item_id"), column(b, "ik"), pa.array([w[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                                             names=["item_id", "ik", "words"])
    return rows.mapInArrow(run, "item_id long, ik long, words binary").where("length(words) > 0")


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for ik, words in zip(column(b, "ik").to_pylist(), column(b, "words").to_pylist(), strict=True):
            h, at = item_seeds(np.frombuffer(words, np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), ik)), pa.array(at)], names=["hash", "ik", "place"])


def _filter(seeds: DataFrame) -> np.ndarray:
    """The bits of all seeds, merged in Spark; at most FILTER_BITS / 63 numbers
    reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(FILTER_BITS // 63 * 63 + 63, bool)
        for b in batches:
            for x in _bits(column(b, "hash").to_numpy().view(np.uint64)):
                on[x] = True
        words = (on.reshape(-1, 63) << np.arange(63, dtype=np.int64)).sum(1) if on.any() else np.zeros(0, np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["i", "v"])

    out = np.zeros(FILTER_BITS // 63 + 1, np.int64)
    for r in seeds.select("hash").mapInArrow(run, "i long, v long").groupBy("i").agg(F.bit_or("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return np.packbits(((out[:, None] >> np.arange(63)) & 1).astype(bool).reshape(-1)[:FILTER_BITS])


def _document_seeds(packed: bytes):
    """Seeds of the texts that the filter lets through: ``(th, hash, place)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        masks = list(enumerate((*MASKS, *SHORT)))
        for b in batches:
            data, off = utf8_view(column(b, "text"))
            th = column(b, "th").to_numpy()
            for lo, hi in row_blocks(off, 1 << 20):
                w, first = word_hashes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                for m, mask in masks:
                    h = spaced_hashes(w, mask, m)
                    at = np.flatnonzero(on[(h >> np.uint64(40)).astype(np.int64)])
                    at = at[on[_bits(h[at])[1]]]
                    d = np.searchsorted(first, at, "right") - 1
                    # a seed lies within one text
                    ok = at + len(mask) <= first[d + 1]
                    at, d = at[ok], d[ok]
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(th[lo + d]), pa.array(h[at].view(np.int64)), pa.array(at - first[d])], names=["th", "hash", "place"])
    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a text around each offset: ``(th, ik, start, from, region)``."""
    for b in batches:
        data, off = utf8_view(column(b, "text"))
        lists = column(b, "at").to_pylist()
        th = column(b, "th").to_pylist()
        for lo, hi in row_blocks(off, 1 << 20):
            w, first = word_hashes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            rows = []
            for i in range(lo, hi):
                own = w[first[i - lo]:first[i - lo + 1]]
                for e in lists[i]:
                    a, z = max(0, e["start"]), min(len(own), e["start"] + e["n"])
                    rows.append((th[i], e["ik"], e["start"], a, own[a:z].tobytes()))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())],
                                                 names=["th", "ik", "start", "from", "region"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for th, item, start, a, region, words in zip(*(column(b, c).to_pylist() for c in ("th", "item_id", "start", "from", "region", "words")), strict=True):
            x, y = np.frombuffer(words, np.uint64), np.frombuffer(region, np.uint64)
            lo = a - start
            if len(y) < min(WINDOW, len(x)):
                continue
            got = verify(x[lo:lo + len(y)] == y)
            if got:
                rows.append((th, item, a + got[0], got[1] - got[0], got[2]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["th", "item_id", "first_word", "n_words", "n_equal"])


SPAN = "array<struct<item_id:bigint,first_word:bigint,n_words:bigint,n_equal:bigint>>"


def overlaps_of_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """``(th, item_id, first_word, n_words, n_equal)``: the verified overlaps
    of each distinct text (``th``: xxhash64 of the text)."""
    items = materialize(_items(benchmark, item_id_col, item_text_col), "items")
    # each step in Python is written: two in one task would be two workers, and
    # workers stay for the stages that follow
    seeds = materialize(items.mapInArrow(lean(_item_seeds), "hash long, ik long, place long"), "seeds")
    texts = docs.select(docs[f"`{text_col}`"].cast("string").alias("text")).where("text <> ''").withColumn("th", F.xxhash64("text"))
    hits = texts.select("th", "text").mapInArrow(lean(_document_seeds(_filter(seeds).tobytes())), "th long, hash long, place long")
    size = items.select("ik", F.floor(F.length("words") / 8).cast("long").alias("n"))
    at = hits.distinct().join(seeds.withColumnRenamed("place", "q"), "hash").select("th", "ik", (F.col("place") - F.col("q")).alias("start")).distinct()
    at = materialize(at, "offsets")
    lists = at.join(maybe_broadcast(size, 16), "ik").groupBy("th").agg(F.collect_list(F.struct("ik", "start", "n")).alias("at"))
    few = materialize(lists, "lists")
    found = texts.join(maybe_broadcast(few.select("th"), 16), "th").dropDuplicates(["th"]).join(few, "th") \
        .select("th", "text", "at").mapInArrow(lean(_regions), "th long, ik long, start long, `from` long, region binary")
    found = materialize(found, "regions")
    return found.join(items, "ik").select("th", "item_id", "start", "from", "region", "words") \
        .mapInArrow(lean(_verified), "th long, item_id long, first_word long, n_words long, n_equal long").distinct()


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``overlaps``: item_id, first word, length and
    equal words of each verified overlap, by place (an existing column of that
    name is replaced).

    An overlap is WINDOW words of an item with 80 of 100 equal; items below
    that many words must be found whole, with 80 of 100 equal from EDITED
    words on and all equal below.

    Null or empty texts have no overlaps (an empty list); texts and items of
    any length are taken whole; null items are ignored; equal items count
    once; an empty benchmark gives empty lists, an empty table no rows;
    repeated rows give repeated results; ties don't arise."""
    cols = [c for c in docs.columns if c != "overlaps"]
    found = overlaps_of_texts(docs, benchmark, text_col, item_id_col, item_text_col) \
        .groupBy("th").agg(F.sort_array(F.collect_list(F.struct("first_word", "item_id", "n_words", "n_equal"))).alias("o"))
    found = materialize(found.select(F.col("th").alias("__th"), F.transform("o", lambda s: F.struct(
        s["item_id"].alias("item_id"), s["first_word"].alias("first_word"), s["n_words"].alias("n_words"), s["n_equal"].alias("n_equal"))).alias("overlaps")), "overlaps")
    own = docs.select(*[docs[f"`{c}`"] for c in cols], F.xxhash64(docs[f"`{text_col}`"].cast("string")).alias("__th"))
    return own.join(maybe_broadcast(found, 512), "__th", "left") \
        .select(*[F.col(f"`{c}`") for c in cols], F.coalesce("overlaps", F.array().cast(SPAN)).alias("overlaps"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item; the same
    columns.  Null, empty and repeated rows, empty tables: as stated by
    ``benchmark_overlaps``; clean rows stay as they are."""
    cols = docs.columns
    bad = materialize(overlaps_of_texts(docs, benchmark, text_col).select(F.col("th").alias("__th")).distinct(), "contaminated")
    own = docs.select(*[docs[f"`{c}`"] for c in cols], F.xxhash64(docs[f"`{text_col}`"].cast("string")).alias("__th"))
    return own.join(maybe_broadcast(bad, 16), "__th", "left_anti").select(*[F.col(f"`{c}`") for c in cols])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, contaminated, overlaps (item_id, place, length).
    Nulls, empty and long texts, repeats, empty tables: as stated by
    ``benchmark_overlaps``."""
    prepare(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = benchmark_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", (F.size("overlaps") > 0).alias("contaminated"), "overlaps")
