import math

import numpy as np
import pytest
from fixtures_llm import CLASH
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow.parquet as pq

from feedloom.llm.whitening import _joined, keys_of, op11_whitening, vectors_of, whiten_vectors

SF = "/root/testdata/sf0.001"


def frame(spark, data, kind="float"):
    rows = [(i, v, None, *[f"{c}{i}" for c in CLASH]) for i, v in data]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, whitened string, " + ", ".join(f"`{c}` string" for c in CLASH))


def ints(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def brute(vectors, distinct=False):
    """Mean, eigenpairs and deviations by plain Python integers and numpy."""
    x = [ints(v) for v in vectors]
    fit = sorted(set(map(tuple, x))) if distinct else x
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(x, float) - np.array(s) / n
    zf = np.array(fit, float) - np.array(s) / n
    e, vec = np.linalg.eigh(zf.T @ zf / n)
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, e[::-1], vec[:, ::-1], z


def held(rows, vectors, **how):
    n, dev, e, vec, z = brute([v for _, v in vectors], **how)
    k = min(32, len(e))
    assert len(rows) == len(vectors)
    by = sorted(rows, key=lambda r: (r["vec_id"], r["deviation"]))
    want = sorted(zip((i for i, _ in vectors), dev, z.tolist()), key=lambda r: r[:2])
    got = np.array([r["whitened"] for r in by])
    plain = np.array([w[2] for w in want]) @ vec[:, :k] / np.sqrt(e[:k])
    sign = np.sign((got * plain).sum(0))
    assert np.allclose(got, plain * sign, atol=1e-6)
    assert [(r["vec_id"], r["deviation"], r["n"]) for r in by] == [(w[0], w[1], n) for w in want]
    assert np.allclose([r["explained"] for r in by], np.tile(e[:k] / e.sum(), (len(by), 1)), rtol=1e-6)
    assert all(r["identity_error"] < 1e-4 for r in by)


def some(n, d, seed=0, repeats=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, (n, d)) @ rng.normal(0, 1, (d, d))
    return [(i, [float(c) for c in base[i // repeats].astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("d", [3, 40])
def test_against_brute_force(spark, d):
    vs = some(400, d, repeats=2)
    held(whiten_vectors(frame(spark, vs)).collect(), vs)


def test_hot_vector_and_weights(spark):
    vs = some(90, 4) + [(1000 + i, [0.5, -0.25, 1.0, 2.0]) for i in range(200)]
    rows = whiten_vectors(frame(spark, vs)).collect()
    held(rows, vs)
    assert {r["copies"] for r in rows if r["vec_id"] >= 1000} == {200}
    held(whiten_vectors(frame(spark, vs), weights="one").collect(), vs, distinct=True)


def test_query_against_brute_force(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    vs = [(r["vec_id"], r["embedding"]) for r in t if r["embedding"] is not None]
    per = {}
    out = op11_whitening(spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for r in out.collect():
        per.setdefault(r["vec_id"], []).append(r)
    rows = []
    for i, rs in per.items():
        rs.sort(key=lambda r: r["component"])
        assert [r["component"] for r in rs] == list(range(1, 33))
        rows.append({"vec_id": i, "deviation": rs[0]["deviation"], "n": rs[0]["n"], "whitened": [r["whitened"] for r in rs],
                     "explained": [r["explained"] for r in rs], "identity_error": rs[0]["identity_error"]})
    held(rows, vs)


def test_awkward_rows(spark):
    ok = [(None if i == 3 else i, v) for i, v in some(30, 4)]
    bad = [(50, None), (51, []), (52, [1.0, None, 0.0, 0.0]), (53, [float("nan"), 0.0, 0.0, 0.0]), (54, [0.0, float("inf"), 0.0, 0.0]),
           (55, [1.0, 2.0]), (56, [0.0, 0.0, -3e38, 0.0])]
    rows = whiten_vectors(frame(spark, ok + bad)).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == sorted(str(i) for i, _ in ok)
    held([r for r in whiten_vectors(frame(spark, [o for o in ok if o[0] is not None] + bad)).collect()], [o for o in ok if o[0] is not None])


def test_deviation_beyond_double_precision(spark):
    vs = [(i, [1e9 + i, -1e9, 0.1 * i]) for i in range(50)]
    got = {r["vec_id"]: r["deviation"] for r in whiten_vectors(frame(spark, vs, "double")).collect()}
    assert got == dict(zip((i for i, _ in vs), brute([v for _, v in vs])[1]))


def test_no_variance_and_empty(spark):
    rows = whiten_vectors(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert [(list(r["whitened"]), r["deviation"], r["n"]) for r in rows] == [([], 0, 5)] * 5
    flat = whiten_vectors(frame(spark, [(i, [1.0, float(i)]) for i in range(5)])).collect()
    assert {len(r["whitened"]) for r in flat} == {1}
    assert whiten_vectors(frame(spark, [])).count() == 0 == whiten_vectors(frame(spark, [(1, None), (2, [])])).count()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-2**50, 2**50) | st.integers(-200, 200), min_size=3, max_size=3), min_size=1, max_size=5))
def test_keys_round_trip(vs):
    x = np.array(vs, np.int64)
    keys = keys_of(x)
    assert (vectors_of(keys, 3) == x).all()
    assert len(set(keys)) == len({tuple(v) for v in vs})


def test_salted_join_keeps_every_row(spark):
    at = spark.createDataFrame([(i, b"a" if i % 3 else bytes([i % 251])) for i in range(900)], "vec_id long, key binary")
    white = at.groupBy("key").count().withColumnRenamed("count", "copies")
    got = _joined(at, white, 900)
    assert got.count() == 900 and got.select("vec_id").distinct().count() == 900 and got.where("key = 'a'").select("salt").distinct().count() > 100
