import random
import zlib

import numpy as np
import pytest
from fixtures_llm import empty, messy, prose, rows

from feedloom.llm.toxicity import LabelModel, fit, fit_label_model, held_out, pattern_hits, reject_toxic, score_documents

BAD = ["grumlo", "grumlas", "vexitor", "vexita", "stupid", "trash", "nastor"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = prose(i + seed * 1000, rng.randrange(20, 80)).split(" ")
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    df = messy(spark, docs)
    model = fit(df.select("doc_id", "text"), table(spark, labels))
    got = {r["doc_id"]: r["score"] for r in score_documents(df.select("doc_id", "text"), model).collect()}
    out = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(got[i] >= 0.5) == bool(labels[i][2]) for i in out]
    assert len(out) > 40 and np.mean(right) >= 0.95
    assert set(r["doc_id"] for r in df.select("doc_id").where(held_out(df["doc_id"])).collect()) == set(out)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = corpus(120)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    df = messy(spark, docs).select("doc_id", "text")
    a, b = fit(df, table(spark, labels)), fit(df, table(spark, flipped))
    assert (a.terms == b.terms).all() and np.allclose(a.weights, b.weights)


def test_label_model_finds_accuracies_and_correlations(spark):
    rng = np.random.default_rng(3)
    n = 4000
    y = rng.random(n) < 0.3
    fire1, fire0 = np.array([0.7, 0.6, 0.5, 0.4, 0.4]), np.array([0.02, 0.05, 0.01, 0.1, 0.1])
    x = rng.random((n, 5)) < np.where(y[:, None], fire1, fire0)
    x[:, 4] = x[:, 3]  # a copy of another voter
    votes = spark.createDataFrame([(r.tolist(),) for r in x], "x array<boolean>")
    m = fit_label_model(votes, 5)
    assert np.abs(m.fire1[:3] - fire1[:3]).max() < 0.1 and np.abs(m.fire0[:3] - fire0[:3]).max() < 0.05
    assert abs(m.prior - 0.3) < 0.06
    assert m.share[3] < 0.6 and m.share[4] < 0.6 and m.share[:3].min() > 0.7
    assert ((m.posterior(x) >= 0.5) == y).mean() > 0.9


def test_posterior_of_no_votes():
    m = LabelModel(0.2, np.array([0.5]), np.array([0.1]), np.ones(1))
    assert m.posterior(np.array([[False]]))[0] < 0.2 < m.posterior(np.array([[True]]))[0]


def test_patterns():
    assert pattern_hits(b"THIS IS SHOUTING AT EVERYONE HERE")[0]
    assert pattern_hits(b"no!!!")[1] and pattern_hits(b"sooooo")[2] and pattern_hits(b"f** you")[3]
    assert pattern_hits(b"calm text, not LOUD.") == [False] * 4 == pattern_hits(b"")


def test_awkward_rows(spark):
    docs, labels = corpus(150)
    model = fit(messy(spark, docs), table(spark, [*labels, (None, 1, 1), (3, None, None), (0, 1, labels[0][2])]))
    got = score_documents(messy(spark), model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    blank = {round(r["score"], 9) for r in got if r["doc_id"] in (3, 4, 5)}
    assert len(blank) == 1 and blank.pop() < 0.5
    df = messy(spark, [*rows(), (50, "grumlo vexita stupid trash you")])
    out = reject_toxic(df, table(spark, labels))
    assert out.columns == df.columns


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_without_usable_labels(spark, labels):
    model = fit(messy(spark), table(spark, labels))
    got = {r["doc_id"]: r["score"] for r in score_documents(messy(spark, [(1, "stupid trash"), (2, "fine day")]), model).collect()}
    assert got[1] >= 0.5 > got[2]


def test_empty(spark):
    docs, labels = corpus(30)
    assert score_documents(empty(spark), fit(empty(spark), table(spark, labels))).count() == 0
