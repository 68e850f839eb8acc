import collections
import math
import zlib

import numpy as np
import pytest
from fixtures_llm import empty, messy, rows

from feedloom.llm import sampling
from feedloom.llm.common import mix
from feedloom.llm.sampling import Sampler, sample_segmentations, vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
KEYS = lambda n: mix(np.arange(1, n + 1, dtype=np.uint64))


@pytest.fixture(scope="module")
def v():
    return vocabulary(PATH, 0.5)


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def every_segmentation(v, text):
    """All segmentations with their probabilities, by brute force."""
    t = "▁" + text.replace(" ", "▁")
    weight = {}
    for h in v.by_length:
        weight |= dict(zip(h[1].tolist(), h[2].tolist(), strict=True))
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    piece = {sp.id_to_piece(i): i for i in weight}
    found = {}

    def walk(at, ids, lp):
        if at == len(t):
            found[tuple(ids)] = lp
            return
        for end in range(at + 1, len(t) + 1):
            if t[at:end] in piece and "▁" not in t[at + 1:end]:
                walk(end, [*ids, piece[t[at:end]]], lp + weight[piece[t[at:end]]])
    walk(0, [], 0.0)
    total = math.log(sum(math.exp(x) for x in found.values()))
    return {k: math.exp(x - total) for k, x in found.items()}


def test_distribution_without_replacement(v):
    text, n, k = "ab the", 6000, 3
    want = every_segmentation(v, text)
    got = Sampler(v, [text] * n, KEYS(n)).run(k)
    first = collections.Counter(tuple(r[0][0].tolist()) for r in got)
    for s, p in want.items():
        assert abs(first[s] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    pairs = collections.Counter(tuple(tuple(x[0].tolist()) for x in r[:2]) for r in got)
    for (a, b), c in pairs.items():
        p = want[a] * want[b] / (1 - want[a])
        assert abs(c / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    for r in got:
        assert len({tuple(x[0].tolist()) for x in r}) == k
        assert all(abs(math.exp(x[1]) - want[tuple(x[0].tolist())]) < 1e-9 for x in r)
        assert r[0][2] > r[1][2] > r[2][2]
    # inclusion scores make weighted sums unbiased: of the whole mass, and of the number of ids
    mass = [sum(math.exp(x[1]) / x[3] for x in r) for r in got]
    length = [sum(math.exp(x[1]) / x[3] * len(x[0]) for x in r) for r in got]
    assert abs(np.mean(mass) - 1) < 0.02
    assert abs(np.mean(length) - sum(p * len(s) for s, p in want.items())) < 0.05


def test_all_segmentations_of_a_small_lattice(v):
    want = every_segmentation(v, "ab c")
    (got,) = Sampler(v, ["ab c"], KEYS(1)).run(len(want) + 5)
    assert {tuple(x[0].tolist()) for x in got} == set(want) and all(abs(x[3] - 1) < 1e-12 for x in got)


def test_decoding_agrees_with_the_library(v, sp):
    texts = [" a  b", "x", "日本語 ñandú 😀\n\tz", "", "aaaa", "the cat\x00\r\n", "́x", "﷽" * 3, *[t or "" for _, t in rows()]]
    for t, got in zip(texts, Sampler(v, texts, KEYS(len(texts))).run(2), strict=True):
        assert 1 <= len(got) <= 2
        for ids, *_ in got:
            assert sp.decode([int(i) for i in ids]) == t and v.decode(ids, np.array([len(ids)])) == [t.encode()]


def test_block_does_not_matter(v):
    texts = [t or "" for _, t in rows()][:8]
    together = Sampler(v, texts, KEYS(8)).run(2)
    for i, t in enumerate(texts):
        (alone,) = Sampler(v, [t], KEYS(8)[i:i + 1]).run(2)
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in together[i]]
        assert np.allclose([x[1:] for x in alone], [x[1:] for x in together[i]])


def test_blocks_share_the_lattices_of_their_words(v, monkeypatch):
    built = []
    lattices = sampling.WordLattices
    monkeypatch.setattr(sampling, "WordLattices", lambda *a: built.append(a) or lattices(*a))
    monkeypatch.setattr(sampling, "CACHE_CODES", 40)
    texts = [t or "" for _, t in rows()]
    n = len(texts)
    want = Sampler(v, texts, KEYS(n)).run(2)
    blocks = [Sampler(v, texts[i:i + 3], KEYS(n)[i:i + 3]) for i in range(0, n, 3)]
    del built[:]
    Sampler.share(blocks)
    got = [x for b in blocks for x in b.run(2)]
    assert len(built) == 1
    for x, y in zip(got, want, strict=True):
        assert [a[0].tolist() for a in x] == [a[0].tolist() for a in y] and np.allclose([a[1:] for a in x], [a[1:] for a in y])


def test_single_numbers_agree_with_arrays():
    for key, s, step in ((0, 1, 0), (2**64 - 1, 2, 7), (123456789, 1, 900)):
        with np.errstate(over="ignore"):
            want = sampling._uniform(np.array([key], np.uint64), np.full(1, np.uint64(s + 500) * sampling._SAMPLE),
                                     np.full(1, np.uint64(step) * sampling._STEP))[0]
        assert Sampler._u(key, s, step) == want


def test_awkward_rows(spark):
    got = sample_segmentations(messy(spark), PATH, 2).collect()
    text = {}
    for d, t in rows():
        text.setdefault(d, set()).add(zlib.crc32((t or "").encode()))
    for r in got:
        assert r["decoded_crc32"] in text[r["doc_id"]] and r["n_tokens"] * 2 == len(r["ids"])
        assert zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()) == r["ids_crc32"]
    for d in (3, 4):
        assert [(r["sample"], r["n_tokens"], r["inclusion"]) for r in got if r["doc_id"] == d] == [(0, 0, 1.0)]
    same = collections.Counter((r["sample"], r["ids_crc32"]) for r in got if r["doc_id"] == 8)
    assert len(same) == 2 and set(same.values()) == {2}
    again = sample_segmentations(messy(spark).repartition(7), PATH, 2, with_ids=False).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["sample"], r["ids_crc32"], round(r["perturbed"], 9)) for r in rs)
    assert key(got) == key(again)


def test_query_returns_the_segmentations(spark, sp, tmp_path):
    texts = {i: t for i, t in enumerate(["the cat  sat", "日本語 ñandú", "", None, "the cat  sat"])}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sampling.op10_sentencepiece(spark, str(tmp_path)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == {0: 2, 1: 2, 2: 1, 3: 1, 4: 2}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["n_tokens"] and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        assert sp.decode(ids.tolist()) == (texts[r["doc_id"]] or "")


def test_empty(spark):
    assert sample_segmentations(empty(spark), PATH).count() == 0
