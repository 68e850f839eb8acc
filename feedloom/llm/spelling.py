"""Spelling variants by dense prefix-suffix tiling.

1. Letter runs of every text are counted (one pass, counts merged before the
   shuffle).  A keyed share of the runs loses one letter, as a typing slip
   would.
2. Words that differ by one inserted, deleted or replaced code point share
   their first or their last half, so every word is laid out under its halves.
   The words of one half form a block; blocks beyond ``TILE`` words are cut
   into tiles, each pair of tiles a block pair of its own, so a frequent half
   is spread over many tasks.
3. A block (pair) is two padded matrices of code points.  Common prefix and
   common suffix of all its pairs are counted column by column; a pair is
   near when they reach the longer length minus one.  Only each word's number
   of near words and its best one leave the block, never the pairs.
4. A word's form is its most frequent near word if that is ``RATIO`` times as
   frequent; forms are followed to the last by doubling.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, column, documents, materialize, prepare, row_blocks, text_rows, utf8_view

#: Words of at least this many code points and occurrences.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is at least this many times as frequent as the word.
RATIO = 5
#: One run in this many (by the crc32 of id and run) loses a letter.
SLIP = 199
#: Words of a tile.
TILE = 1024
#: Distinct words that a task holds before it hands its counts on.
HELD = 1 << 18
#: Runs beyond this many bytes are hashed one by one.
LONG = 48

_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
#: First byte of U+00C0..U+00FF in UTF-8; any byte that follows it belongs there.
_LATIN = 0xC3


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter runs of consecutive documents: start, end (bytes), code points, document."""
    n = len(data)
    lead = data == _LATIN
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.r_[False, inside[:-1]]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~np.r_[inside[1:], False] | cut[1:])) + 1
    leads = np.r_[0, np.cumsum(lead, dtype=np.int64)]
    return starts, ends, ends - starts - (leads[ends] - leads[starts]), np.searchsorted(off, starts, "right") - 1


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """crc32 of each ``head + data[start:end]``, given the crc32 of the heads."""
    out = ~heads.astype(np.uint32)
    length = ends - starts
    order = np.argsort(-np.minimum(length, LONG + 1), kind="stable")
    at, crc, sizes = starts[order], out[order], length[order]
    for j in range(min(int(sizes[0]) if len(sizes) else 0, LONG)):
        live = int(np.searchsorted(-sizes, -j, "left"))
        c = crc[:live]
        crc[:live] = _CRC[(c ^ data[at[:live] + j]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out[order] = ~crc
    for i in np.flatnonzero(length > LONG):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(heads[i]))
    return out


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a string array."""
    length = ends - starts
    off = np.r_[0, np.cumsum(length)]
    at = np.repeat(starts - off[:-1], length) + np.arange(off[-1])
    return pa.Array.from_buffers(pa.large_string(), len(starts),
                                 [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data[at])])


def block_words(data: np.ndarray, off: np.ndarray, ids: list, least: int = MIN_LENGTH, slip: int = SLIP) -> pa.Array:
    """Every occurrence of a word (with its slips) in consecutive documents."""
    low = LOWER[data]
    starts, ends, size, doc = runs(low, off)
    keep = size >= least
    starts, ends, size, doc = starts[keep], ends[keep], size[keep], doc[keep]
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crcs(low, starts, ends, heads[doc])
    hit = h % slip == 0
    slipped = []
    for i in np.flatnonzero(hit & (size > least)):
        run = low[starts[i]:ends[i]].tobytes().decode()
        k = int(h[i]) % len(run)
        slipped.append(run[:k] + run[k + 1:])
    return pa.concat_arrays([_slices(low, starts[~hit], ends[~hit]), pa.array(slipped, pa.large_string())])


def count_words(docs: DataFrame, least: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``(word, n)`` of the runs of ``docs (doc_id, text)``.

    Counts are merged in each task, then by Spark before and after the
    shuffle, so a word that holds a third of all runs is one row a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for b in batches:
            data, off = utf8_view(column(b, "text"))
            ids = column(b, "doc_id").to_pylist()
            for lo, hi in row_blocks(off, 1 << 20):
                if off[hi] == off[lo]:
                    continue
                w = block_words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ids[lo:hi], least, slip)
                c = pc.value_counts(w)
                held.append(pa.table({"word": c.field("values"), "n": c.field("counts")}))
                size += len(c)
                if size > HELD:
                    held, size = [merged()], 0
                    if len(held[0]) > HELD // 2:
                        yield from held[0].cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 14)
                        held = []
        if held:
            yield from merged().cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 14)

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= min_count)


# ------------------------------------------------------------ near words
def matrix(words: list[str], width: int) -> np.ndarray:
    """Code points, a row a word, padded with -1."""
    m = np.full((len(words), width), -1, np.int32)
    for i, w in enumerate(words):
        m[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.int32)
    return m


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every pair of rows; padding equals nothing."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros(alive.shape, np.int32)
    for j in range(a.shape[1]):
        x, y = a[:, j], b[:, j]
        alive &= (x[:, None] == y[None, :]) & (x >= 0)[:, None]
        if not alive.any():
            break
        out += alive
    return out


def _reversed(m: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = size[:, None] - 1 - np.arange(m.shape[1])[None, :]
    return np.where(at >= 0, np.take_along_axis(m, np.maximum(at, 0), 1), -1)


def near(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows are one edit apart, and their common starts."""
    head = _common(a, b)
    tail = _common(_reversed(a, na), _reversed(b, nb))
    longer = np.maximum(na[:, None], nb[None, :])
    same = (head == na[:, None]) & (head == nb[None, :])
    return (np.abs(na[:, None] - nb[None, :]) <= 1) & (head + tail >= longer - 1) & ~same, head


def _laid_out(words: DataFrame) -> DataFrame:
    """Each word under its halves, for pairs whose longer word has its length
    or one more: ``(size, half, key, word, n)``."""
    length = F.char_length("word")
    out = None
    for more in (0, 1):
        size = length + more
        front = F.floor(size / 2).cast("int")
        both = F.array(F.struct(F.lit("head").alias("half"), F.left("word", front).alias("key")),
                       F.struct(F.lit("tail").alias("half"), F.right("word", size - front).alias("key")))
        part = words.select("word", "n", size.alias("size"), F.explode(both).alias("k")).select("size", "k.half", "k.key", "word", "n")
        out = part if out is None else out.unionByName(part)
    return out


def _tiled(laid: DataFrame, tile: int) -> DataFrame:
    """``laid`` with ``(ta, tb, side)``: the block pair and which of its two
    matrices the word is in (2: both).  Blocks of one tile have one pair."""
    block = ["size", "half", "key"]
    big = laid.groupBy(*block).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > tile) \
        .select(*block, F.ceil(F.col("m") / tile).cast("int").alias("tiles"))
    # a word's tile depends on the word alone
    t = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1)).alias("u")
    return laid.join(big, block, "left").select(*block, "word", "n", F.coalesce(t, F.lit(0)).alias("t"), other) \
        .select(*block, "word", "n", F.least("t", "u").alias("ta"), F.greatest("t", "u").alias("tb"),
                F.when(F.col("t") == F.col("u"), 2).when(F.col("t") < F.col("u"), 0).otherwise(1).alias("side"))


def _block_result(size: int, half: str, front: list[int], back: list[int] | None, words: list[str], n: np.ndarray,
                  found: np.ndarray, best: np.ndarray, tile: int) -> None:
    """Adds the near words of a block (``back`` None) or block pair to
    ``found`` and ``best`` (places in ``words``, which is by falling n, then word)."""
    rows = np.array(front)
    cols = rows if back is None else np.array(back)
    step = max(64, min(tile, 1 << 10))

    def cut(places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for lo in range(0, len(places), step):
            at = places[lo:lo + step]
            some = [words[i] for i in at]
            yield at, matrix(some, size), np.array([len(w) for w in some])

    for i, (ra, a, na) in enumerate(cut(rows)):
        for j, (rb, b, nb) in enumerate(cut(cols)):
            if back is None and j < i:
                continue
            hit, head = near(a, na, b, nb)
            hit &= np.maximum(na[:, None], nb[None, :]) == size
            if half == "tail":
                # equal first halves meet in their head block
                hit &= head < size // 2
            if back is None and i == j:
                hit = np.triu(hit, 1)
            x, y = np.nonzero(hit)
            for p, q in ((ra[x], rb[y]), (rb[y], ra[x])):
                np.add.at(found, p, 1)
                np.minimum.at(best, p, q)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``(word, n_near, form_n, near)`` of every word of ``words (word, n)``
    with near words: their number, and the most frequent one (ties: the
    smallest in code-point order)."""
    place = ["size", "half", "key", "ta", "tb"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows: consecutive rows of a block (pair) are one group."""
        open_key, words_, ns, sides = None, [], [], []

        def close() -> pa.RecordBatch | None:
            if len(words_) < 2:
                return None
            # by falling n, then word: a smaller place is the better form
            order = sorted(range(len(words_)), key=lambda i: (-ns[i], words_[i]))
            w, n, side = [words_[i] for i in order], np.array([ns[i] for i in order]), [sides[i] for i in order]
            found, best = np.zeros(len(w), np.int64), np.full(len(w), len(w), np.int64)
            if side[0] == 2:
                _block_result(open_key[0], open_key[1], list(range(len(w))), None, w, n, found, best, tile)
            else:
                split = [[i for i, s in enumerate(side) if s == k] for k in (0, 1)]
                if all(split):
                    _block_result(open_key[0], open_key[1], *split, w, n, found, best, tile)
            at = np.flatnonzero(found)
            if not len(at):
                return None
            return pa.RecordBatch.from_arrays([pa.array([w[i] for i in at], pa.string()), pa.array(found[at]), pa.array(n[best[at]]),
                                               pa.array([w[i] for i in best[at]], pa.string())], names=["word", "n_near", "form_n", "near"])

        for b in batches:
            cols = [column(b, c).to_pylist() for c in place]
            ws, nn, ss = (column(b, c).to_pylist() for c in ("word", "n", "side"))
            for key, w, n, s in zip(zip(*cols), ws, nn, ss):
                if key != open_key:
                    if (out := close()) is not None:
                        yield out
                    open_key, words_, ns, sides = key, [], [], []
                words_.append(w)
                ns.append(n)
                sides.append(s)
        if (out := close()) is not None:
            yield out

    rows = _tiled(_laid_out(words), tile).repartition(*place).sortWithinPartitions(*place)
    part = rows.mapInArrow(compare, "word string, n_near long, form_n long, near string")
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("m"), "near")).alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.near").alias("near"))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms (word, form)``: forms followed to the last.

    Each step doubles the distance.  A form is at least ``RATIO`` times as
    frequent as its word, so chains are shorter than log of the largest
    count, and the steps few."""
    at = materialize(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = materialize(at.join(step, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                               F.col("far").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return forms.select("word").join(new.select("word", "root"), "word", "left") \
                .select("word", F.coalesce("root", "word").alias("root"))
        at = new.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, slip: int = SLIP, tile: int = TILE) -> DataFrame:
    """The words of ``docs``, their variants and the forms these go back to.

    Returns word, form, root, n, n_near, form_n.  Null and empty texts hold
    no run; a null id counts as an empty one; repeated rows count each time;
    texts of any length are read whole, and a run of any length is one word;
    ties between forms go to the smaller word; an empty table gives no rows;
    other columns are not read, whatever their names."""
    words = materialize(count_words(text_rows(docs, id_col, text_col), least, min_count, slip), "words")
    best = near_words(words, tile)
    is_form = F.col("form_n") >= F.col("n") * ratio
    forms = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "forms")
    return forms.join(follow(forms.select("word", "form")), "word") \
        .select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of every whole text of ``documents``.  Nulls, empty
    and very long texts, ties, repeated rows and empty tables: as stated by
    ``spelling_variants``."""
    prepare(spark)
    return spelling_variants(documents(spark, sf_dir))
