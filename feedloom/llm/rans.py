"""Token ids as entropy-coded blocks: a static range asymmetric numeral system.

One frequency table over all token ids is shared by every block.  A block
holds whole documents in ascending order; its ids run through interleaved
rANS lanes (id ``i`` belongs to lane ``i mod lanes``), and every
CHECK_STEPS steps the lanes' states, the place in the stream and a checksum
are kept, so blocks, and segments inside a block, decode on their own.

File format: a folder of Parquet files, one row a block, ``payload`` is

    magic ``FRB1``, then little-endian unsigned 32-bit: crc32 of all that
    follows, crc32 of the frequency table, documents, ids, lanes, steps,
    checkpoints, stream words;
    documents x int64 ids of documents, documents x uint32 ids in each;
    checkpoints x (uint32 stream place, uint32 crc32 of the segment's ids);
    checkpoints x lanes x uint64 states; stream words x uint32.

and a folder ``table`` with the frequencies, which sum to 2**SCALE.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir

from .common import (column, documents, materialize, prefix_hash, prepare, range_splits, row_blocks, shuffle_width, span_hash,
                     text_rows, utf8_view)

END_ID = 2
SCALE = 18
TOTAL = 1 << SCALE
LOWEST = np.uint64(1 << 31)
LANES = 2048
CHECK_STEPS = 128
#: Ids of a block; a document is never split, a longer one has a block alone.
BLOCK_IDS = 524_288
#: Words whose ids a worker keeps (about 30 bytes each); beyond it further
#: words are encoded anew.
CACHE_WORDS = 1_500_000
MAGIC = b"FRB1"
#: Signs that often end a word; each is a pre-token of its own there.
_STOPS = tuple(",.;:!?")
_HEAD = struct.Struct("<4s8I")


# ------------------------------------------------------------ tokenizing
class WordEncoder:
    """Ids of whole texts from the ids of their blank-separated words.

    The tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids in a row.  Distinct words are encoded once, many
    in one call; a word's last id in each of its pre-tokens is one of the
    vocabulary's word-final ids, which tells them apart again.  Words with
    other than letters of the first code points, digits and signs, and
    anything that looks like a special token, take the tokenizer's whole
    path."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # code points up to U+017F without NFC or case rules of their own
        self.simple = regex.compile(r"[!-~¡-¬®-įĲ-ňŊ-ž]+").fullmatch
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte_char = [chr(b) if b in set(keep) else "" for b in range(256)]
        n = 0
        for b in range(256):
            if not self.byte_char[b]:
                self.byte_char[b] = chr(256 + n)
                n += 1
        self.latin = {i: "".join(self.byte_char[b] for b in chr(i).encode()) for i in range(33, 0x180)}
        vocab = self.whole.get_vocab()
        self.final = np.zeros(max(vocab.values()) + 1, bool)
        self.final[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # what is known: ascending hashes of words, place and number of their ids
        self.hashes, self.places, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint16), 0

    def _encode_simple(self, words: list[str]) -> list[bytes] | None:
        """Ids of each word; None if they can't be told apart."""
        text, parts, latin, split = [], [], self.latin, self.split
        for w in words:
            w = w.lower()
            if w.isalpha():
                # bytes of printable ASCII stand for themselves
                text.append(w if w.isascii() else w.translate(latin))
                parts.append(1)
            elif w and w[-1] in _STOPS and w[:-1].isalpha():
                text.append(w[:-1] if w.isascii() else w[:-1].translate(latin))
                text.append(w[-1])
                parts.append(2)
            else:
                p = split(w)
                text += p if w.isascii() else [x.translate(latin) for x in p]
                parts.append(len(p))
        ids = np.array(self.bare.encode_batch_fast([" ".join(text)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) != sum(parts) or (len(ids) and ends[-1] != len(ids)):
            return None
        cut = (2 * ends[np.cumsum(parts) - 1]).tolist()
        raw = ids.astype("<u2").tobytes()
        return [raw[x:y] for x, y in zip([0, *cut], cut, strict=False)]

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of each of the words, as little-endian 16-bit numbers."""
        simple = self.simple
        easy = [i for i, w in enumerate(words) if w and (w.isprintable() if w.isascii() else simple(w)) and "<" not in w]
        coded = self._encode_simple([words[i] for i in easy]) if easy else []
        out: list[bytes | None] = [None] * len(words)
        for i, x in zip(easy, coded or [], strict=False):
            out[i] = x
        return [np.array(self.whole.encode(w, add_special_tokens=False).ids, "<u2").tobytes() if x is None else x
                for w, x in zip(words, out, strict=True)]

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a string column (null: empty), with the end id."""
        texts = pc.fill_null(texts, "")
        # U+001C..U+001F part words for Arrow and Python, not for the tokenizer
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]").to_numpy(zero_copy_only=False)
        split = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        words = split.flatten().dictionary_encode()
        data, off = utf8_view(words.dictionary)
        h = span_hash(prefix_hash(data), off[:-1], off[1:])
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        new = np.flatnonzero(self.hashes[at] != h) if len(self.hashes) else np.arange(len(h))
        got = self.learn(words.dictionary.take(pa.array(new)).to_pylist())
        place, size = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        old = np.ones(len(h), bool)
        old[new] = False
        place[old], size[old] = self.places[at[old]], self.sizes[at[old]]
        fresh = np.frombuffer(b"".join(got), "<u2")
        size[new] = [len(x) // 2 for x in got]
        place[new] = self.used + np.cumsum(size[new]) - size[new]
        if self.used + len(fresh) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros(max(len(self.ids), len(fresh)), np.uint16)]
        self.ids[self.used:self.used + len(fresh)] = fresh
        # ids of the distinct words, then of all words in their order
        end_of = np.cumsum(size)
        raw = self.ids[np.repeat(place - (end_of - size), size) + np.arange(end_of[-1] if len(size) else 0)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.r_[0, 2 * end_of]), pa.py_buffer(raw)])
        if len(self.hashes) + len(new) <= CACHE_WORDS:
            order = new[np.argsort(h[new])]
            into = np.searchsorted(self.hashes, h[order])
            self.hashes, self.places, self.sizes = (np.insert(x, into, y[order]) for x, y in ((self.hashes, h), (self.places, place), (self.sizes, size)))
            self.used += len(fresh)
        data, cuts = utf8_view(coded.take(words.indices))
        raw, cut = data.tobytes(), cuts[split.offsets.to_numpy()].tolist()
        end = struct.pack("<H", END_ID)
        out = [raw[x:y] + end for x, y in zip(cut, cut[1:], strict=False)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u2").tobytes() + end
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, path: str, splits: list[int]) -> DataFrame:
    """(doc_id, bucket, n, ids): ids as 16-bit numbers with the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        cut = np.array(splits, np.int64)
        for b in batches:
            _, off = utf8_view(column(b, "text"))
            for lo, hi in row_blocks(off, 4 << 20):
                part = b.slice(lo, hi - lo)
                ids = enc.texts(column(part, "text"))
                doc = column(part, "doc_id")
                key = doc.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(np.searchsorted(cut, key, "right").astype(np.int32)),
                     pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "bucket", "n", "ids"])
    return docs.mapInArrow(run, "doc_id long, bucket int, n long, ids binary")


# ------------------------------------------------------------ coder
def frequency_table(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**SCALE; each id that occurs keeps 1 at least."""
    f = np.zeros(len(counts), np.int64)
    on = counts > 0
    if not on.any():
        return f
    f[on] = np.maximum(1, counts[on] * TOTAL // counts.sum())
    while (d := TOTAL - f.sum()) != 0:
        top = np.argsort(-f, kind="stable")[:max(1, min(abs(d), 64))]
        step = max(1, abs(d) // len(top))
        for i in top:
            d = TOTAL - f.sum()
            if d == 0:
                break
            f[i] += min(step, d) if d > 0 else -min(step, -d, f[i] - 1)
    return f


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    def encode(self, doc_ids: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = int(min(LANES, max(1, n)))
        steps = -(-n // lanes)
        x = np.full(lanes, LOWEST, np.uint64)
        words: list[np.ndarray] = []
        placed = 0
        marks = []
        for t in range(steps - 1, -1, -1):
            s = ids[t * lanes:(t + 1) * lanes]
            m = len(s)
            f = self.freq[s]
            y = x[:m]
            out = y >= f << np.uint64(63 - SCALE)
            if out.any():
                w = (y[out] & np.uint64(0xFFFFFFFF)).astype("<u4")
                words.append(w)
                placed += len(w)
                y = np.where(out, y >> np.uint64(32), y)
            q = y // f
            x[:m] = (q << np.uint64(SCALE)) + (y - q * f) + self.start[s]
            if t % CHECK_STEPS == 0:
                seg = ids[t * lanes:(t + CHECK_STEPS) * lanes]
                marks.append((placed, zlib.crc32(seg.astype("<u4").tobytes()), x.copy()))
        marks.reverse()
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        body = b"".join([doc_ids.astype("<i8").tobytes(), lens.astype("<u4").tobytes(),
                         np.array([(placed - at, c) for at, c, _ in marks], "<u4").tobytes(),
                         np.array([st for _, _, st in marks], "<u8").tobytes(), stream.tobytes()])
        rest = struct.pack("<7I", self.crc, len(doc_ids), n, lanes, steps, len(marks), len(stream)) + body
        return MAGIC + struct.pack("<I", zlib.crc32(rest)) + rest

    def decode(self, payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document ids, lengths and ids of a block; raises ValueError if any
        checksum fails."""
        head = _HEAD.unpack_from(payload)
        magic, crc, table, n_docs, n, lanes, steps, checks, n_words = head
        if magic != MAGIC or zlib.crc32(memoryview(payload)[8:]) != crc:
            raise ValueError("damaged block")
        if table != self.crc:
            raise ValueError("block of another frequency table")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, count, at)
            at += got.nbytes
            return got
        doc_ids, lens = take("<i8", n_docs), take("<u4", n_docs)
        marks = take("<u4", 2 * checks).reshape(checks, 2)
        states = take("<u8", checks * lanes).reshape(checks, lanes)
        stream = take("<u4", n_words)
        segs = [self.segment(k, n, lanes, steps, states[k], int(marks[k, 0]), stream) for k in range(checks)]
        for k, s in enumerate(segs):
            if zlib.crc32(s.astype("<u4").tobytes()) != marks[k, 1]:
                raise ValueError("damaged segment")
        return doc_ids, lens.astype(np.int64), np.concatenate(segs) if segs else np.zeros(0, np.uint16)

    def segment(self, k: int, n: int, lanes: int, steps: int, state: np.ndarray, place: int, stream: np.ndarray) -> np.ndarray:
        """Ids between checkpoint ``k`` and the next, from its state alone."""
        x = state.copy()
        lo, hi = k * CHECK_STEPS, min(steps, (k + 1) * CHECK_STEPS)
        out = np.empty(min(n, hi * lanes) - lo * lanes, np.uint16)
        for t in range(lo, hi):
            m = min(lanes, n - t * lanes)
            y = x[:m]
            slot = y & np.uint64(TOTAL - 1)
            s = self.symbol[slot]
            out[(t - lo) * lanes:(t - lo) * lanes + m] = s
            y = self.freq[s] * (y >> np.uint64(SCALE)) + slot - self.start[s]
            low = np.flatnonzero(y < LOWEST)
            if len(low):
                y[low] = (y[low] << np.uint64(32)) | stream[place:place + len(low)]
                place += len(low)
            x[:m] = y
        return out


# ------------------------------------------------------------ files
def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      block_ids: int = BLOCK_IDS) -> None:
    """Write every text of ``docs`` as token blocks under ``out``.

    Null and empty texts hold the end id alone; null ids come last (stored as
    the largest 64-bit number); repeated rows are kept, equal ids in the order
    of their token ids; an empty table writes an empty folder.  Ids of the
    tokenizer must be below 65,536."""
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col)
    width = shuffle_width(spark)
    splits = range_splits(rows, "doc_id", 4 * width)
    tokens = materialize(tokenize(rows, tokenizer_path, splits), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << 16, np.int64)
        for b in batches:
            data, _ = utf8_view(column(b, "ids"))
            for lo in range(0, len(data), 1 << 23):
                n += np.bincount(data[lo:lo + (1 << 23)].view("<u2"), minlength=1 << 16)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["id", "n"])

    counts = np.zeros(1 << 16, np.int64)
    # one row an id of the vocabulary, 65,536 at most
    for r in tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    freq = frequency_table(counts)
    used = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(used, "id int, freq long").coalesce(1).write.parquet(f"{out}/table")

    # one row a range, whose number is a multiple of the shuffle width
    totals = {r["bucket"]: r["n"] for r in tokens.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    offset, at = {}, 0
    for b in sorted(totals):
        offset[b] = at
        at += totals[b]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        bucket, place, docs_, lens, parts, held = None, 0, [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u2")
            payload = coder.encode(np.array(docs_, np.int64), np.array(lens, np.int64), ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([place - held], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([payload], pa.binary())], names=["bucket", "start", "n", "payload"])
        for b in batches:
            for k, d, n, ids in zip(column(b, "bucket").to_pylist(), column(b, "doc_id").to_pylist(),
                                    column(b, "n").to_pylist(), column(b, "ids"), strict=True):
                if docs_ and (k != bucket or held + n > block_ids):
                    yield block()
                    docs_, lens, parts, held = [], [], [], 0
                if k != bucket:
                    bucket, place = k, offset[k]
                docs_.append(np.iinfo(np.int64).max if d is None else d)
                lens.append(n)
                parts.append(ids.as_buffer())
                held, place = held + n, place + n
        if docs_:
            yield block()

    tokens.repartition(width, "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_last(), "ids") \
        .mapInArrow(pack, "bucket int, start long, n long, payload binary").write.parquet(f"{out}/blocks")


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    freq = np.zeros(1 << 16, np.int64)
    for r in spark.read.schema("id int, freq long").parquet(f"{out}/table").collect():
        freq[r["id"]] = r["freq"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            for start, payload in zip(column(b, "start").to_pylist(), column(b, "payload"), strict=True):
                doc, lens, ids = coder.decode(payload.as_buffer().to_pybytes())
                ends = np.cumsum(lens)
                crc = [zlib.crc32(ids[e - n:e].astype("<u4").tobytes()) for e, n in zip(ends, lens, strict=True)]
                none = doc == np.iinfo(np.int64).max
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64(), mask=none), pa.array(start + ends - lens), pa.array(lens), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    blocks = spark.read.schema("bucket int, start long, n long, payload binary").parquet(f"{out}/blocks")
    return blocks.select("start", "payload").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every whole text of ``documents``, read back.  Nulls,
    empty and long texts, repeats, ties and empty tables: as stated by
    ``write_token_files``."""
    prepare(spark)
    import public_tokenizers

    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex[:12]}"
    write_token_files(documents(spark, sf_dir), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, out)
