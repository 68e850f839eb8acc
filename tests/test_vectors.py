"""Embedding neighbours (X1) and topic clusters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import feedloom.operators.neighbours as N
from feedloom.operators.clusters import fit_clusters, optimality


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows],
                                 "vec_id long, embedding array<float>")


def clustered(n, dim, groups, noise, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(groups, dim))
    return [(i, (c[i % groups] + noise * rng.normal(size=dim)).astype(np.float32)) for i in range(n)]


def brute(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in asked:
        s = np.round(x[ids == i][0] @ x.T, 6)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), round(float(s[j]), 6)) for j in order]
    return out


def got(df):
    out = {}
    for r in df.orderBy("id", "rank").collect():
        out.setdefault(r["id"], []).append((r["neighbour"], round(r["similarity"], 6)))
    return out


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 20)


def test_exact_mode_is_brute_force(spark, small_cells):
    for noise in (0.2, 5.0):
        rows = clustered(600, 12, 25, noise)
        want = brute(rows, range(0, 600, 50), 7)
        have = got(N.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, 7))
        assert {i: [s for _, s in v] for i, v in have.items()} == {i: pytest.approx([s for _, s in v], abs=2e-6) for i, v in want.items()}
        assert np.mean([[n for n, _ in have[i]] == [n for n, _ in want[i]] for i in want]) > 0.9


def test_calibrated_reach_meets_its_recall(spark, small_cells):
    rows = clustered(800, 16, 40, 0.4, seed=3)
    df, asked = frame(spark, rows), F.col("vec_id") % 50 == 0
    reach = N.calibrate(df, asked, 5, 0.95)
    want, have = brute(rows, range(0, 800, 50), 5), got(N.neighbours(df, asked, 5, reach))
    assert reach < 1 and np.mean([len({n for n, _ in have.get(i, [])} & {n for n, _ in v}) / 5 for i, v in want.items()]) >= 0.9


def test_hot_cell_is_split(spark, small_cells, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rows = clustered(200, 6, 10, 0.3) + [(1000 + i, [1, 2, 3, 4, 5, 6]) for i in range(150)]
    have = got(N.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, 4))
    assert have[1000] == [(1001, 1.0), (1002, 1.0), (1003, 1.0), (1004, 1.0)]
    assert {i: [s for _, s in v] for i, v in have.items()} == \
        {i: pytest.approx([s for _, s in v], abs=2e-6) for i, v in brute(rows, have, 4).items()}


def test_rows_without_direction_and_few_rows(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, None), (3, []), (4, [0, 0]), (5, [1, None]), (6, [float("nan"), 1]), (7, [1, 2, 3]), (None, [1, 0]), (50, [0, 1])]
    have = got(N.neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0, 3))
    assert have == {0: [(1, 0.707107), (50, 0.0)], 50: [(1, 0.707107), (0, 0.0)]}
    assert N.neighbours(frame(spark, []), F.lit(True)).count() == 0 == N.neighbours(frame(spark, [(1, None)]), F.lit(True)).count()


def test_moving_one_vector_breaks_optimality(spark):
    df = frame(spark, clustered(120, 5, 4, 0.1))
    assigned, centres = fit_clusters(df, "embedding", 4, max_iter=200, tol=1e-9)
    assert optimality(df, "embedding", assigned, centres).first().asDict() == \
        {"vectors": 120, "not_once": 0, "not_nearest": 0, "wrong_distance": 0, "off_centre": 0}
    moved = assigned.withColumn("cluster", F.when(F.col("vec_id") == 7, (F.col("cluster") + 1) % 4).otherwise(F.col("cluster")))
    r = optimality(df, "embedding", moved, centres).first()
    assert r["not_nearest"] == 1 and r["off_centre"] == 2 and r["wrong_distance"] == 1
    assert optimality(df, "embedding", assigned.where("vec_id <> 7"), centres).first()["not_once"] == 1
