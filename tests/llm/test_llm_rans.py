import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import empty, messy, prose, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import rans
from feedloom.llm.rans import Coder, WordEncoder, frequency_table, read_token_files, write_token_files
from feedloom.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["It's NOT 1,234.50 Straße ÀÉÎ ñandú ĲSSEL ŉ İstanbul ΑΣ σς 中文 ­ x́ <|endoftext|> a<|endoftext|>b \x1c\x1d a\x00b  \t z 'S we'LL "
       "don'T O'd ﬁ ½² ª º µ ſ Ÿÿ", "", "   ", "́a ẞ ß", "a b　c", "¨ ´ ¸ ¯ a¨", "x" * 3000]


def ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_words_give_the_ids_of_whole_texts():
    enc = WordEncoder(PATH)
    texts = [*ODD, *[t or "" for _, t in rows()]]
    for t, got in zip(texts, enc.texts(pa.array(texts)), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == ids(t), t[:60]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=9000).map(lambda x: np.array(x, np.uint16)))
def test_round_trip(x):
    coder = Coder(frequency_table(np.bincount(x, minlength=400)) if len(x) else frequency_table(np.ones(400, np.int64)))
    payload = coder.encode(np.array([7]), np.array([len(x)]), x)
    docs, lens, got = coder.decode(payload)
    assert docs.tolist() == [7] and lens.tolist() == [len(x)] and (got == x).all()


def test_table_sums_to_its_total():
    for counts in ([1], [10**9, 1, 1], [0, 5, 0, 5], list(range(1, 60000))):
        f = frequency_table(np.array(counts))
        assert f.sum() == 1 << rans.SCALE and ((f > 0) == (np.array(counts) > 0)).all()


def test_size_is_near_the_entropy():
    r = np.random.default_rng(1)
    x = np.minimum(r.geometric(0.05, 200_000), 400).astype(np.uint16)
    n = np.bincount(x, minlength=401)
    p = n[n > 0] / n.sum()
    coder = Coder(frequency_table(n))
    steps = -(-len(x) // rans.LANES)
    states = 8 * rans.LANES * -(-steps // rans.CHECK_STEPS)
    size = len(coder.encode(np.array([1]), np.array([len(x)]), x)) - states
    assert size * 8 < 1.03 * len(x) * -(p * np.log2(p)).sum()


def test_segments_decode_from_their_checkpoints():
    x = np.random.default_rng(2).integers(0, 50, rans.LANES * rans.CHECK_STEPS * 3 + 77).astype(np.uint16)
    coder = Coder(frequency_table(np.bincount(x)))
    payload = coder.encode(np.array([1]), np.array([len(x)]), x)
    *_, n, lanes, steps, checks, words = struct.unpack_from("<4s8I", payload)
    at = 36 + 8 + 4
    marks = np.frombuffer(payload, "<u4", 2 * checks, at).reshape(-1, 2)
    states = np.frombuffer(payload, "<u8", checks * lanes, at + marks.nbytes).reshape(checks, lanes)
    stream = np.frombuffer(payload, "<u4", words, at + marks.nbytes + states.nbytes)
    for k in range(checks):
        seg = coder.segment(k, n, lanes, steps, states[k], int(marks[k, 0]), stream)
        lo = k * rans.CHECK_STEPS * lanes
        assert (seg == x[lo:lo + len(seg)]).all() and zlib.crc32(seg.astype("<u4").tobytes()) == marks[k, 1]


def test_damage_is_found():
    x = np.arange(5000, dtype=np.uint16) % 50
    coder = Coder(frequency_table(np.bincount(x)))
    payload = bytearray(coder.encode(np.array([1]), np.array([len(x)]), x))
    for at in (0, 5, 40, len(payload) - 1):
        bad = bytearray(payload)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            coder.decode(bytes(bad))
    with pytest.raises(ValueError, match="another"):
        Coder(frequency_table(np.arange(1, 51))).decode(bytes(payload))


def check(spark, data, **options):
    out = scratch_path(spark, f"tok-{uuid.uuid4().hex[:6]}")
    write_token_files(messy(spark, data), out, PATH, **options)
    got = read_token_files(spark, out).collect()
    want, at = [], 0
    for d, x in sorted(((d, ids(t)) for d, t in data), key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<u2").tobytes())):
        want.append((d, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_awkward_rows(spark):
    check(spark, [*rows(), *[(100 + i, t) for i, t in enumerate(ODD)]])


def test_many_blocks(spark):
    check(spark, [(i * 37 % 101, prose(i, 5 + i * 3)) for i in range(60)], block_ids=200)


def test_empty(spark):
    out = scratch_path(spark, "tok-empty")
    write_token_files(empty(spark), out, PATH)
    assert read_token_files(spark, out).count() == 0
