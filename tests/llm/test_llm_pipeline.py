import random

from fixtures_llm import CLASH, empty, messy, prose, rows

import corpus_pipeline
from feedloom.llm.common import materialize
from feedloom.llm.pii import Pseudonymiser, pseudonymise, session_key
from test_llm_decontam import ITEMS
from test_llm_minhash import edited
from test_llm_toxicity import BAD, corpus, table


def tables(spark, tmp_path, docs, labels):
    d = str(tmp_path / "tables")
    messy(spark, docs).write.parquet(f"{d}/documents.parquet")
    table(spark, labels).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_each_decision_takes_effect(spark, tmp_path):
    rng = random.Random(2)
    docs, labels = corpus(300)
    toxic = {d for d, _, t in labels if t}
    docs = [(d, t) for d, t in docs]
    base = prose(9001, 200)
    extra = {1000: base, 1001: edited(base, rng, 0.01), 1002: base, 1003: prose(9002, 20) + " " + ITEMS[0][1] + " " + prose(9003, 20),
             1004: prose(9004, 30) + " mail Bosbt.42@mail8.example.com", 1005: " ".join(BAD[:4]) + " " + prose(9005, 30)}
    docs += list(extra.items())
    d = tables(spark, tmp_path, docs, labels)
    at, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, at, d), "test-stage")
        kept.append((name, {r["doc_id"]: r for r in out.collect()}))
        if name != "sentencepiece":
            assert out.columns == at.columns
        at = out
    got = dict(kept)
    # a few of the toxic rows of the training set may be missed
    assert len(toxic & set(got["toxicity"])) <= 0.05 * len(toxic) and 1005 not in got["toxicity"]
    assert set(range(300)) - toxic <= set(got["toxicity"]) and {1000, 1001, 1002} <= set(got["toxicity"])
    assert {1000, 1001, 1002} & set(got["near_dedup"]) == {1000} and set(range(300)) - toxic <= set(got["near_dedup"])
    assert set(got["near_dedup"]) - set(got["decontamination"]) == {1003}
    assert got["pii"][1004]["text"] == pseudonymise(extra[1004], Pseudonymiser(session_key(spark)))[0] != extra[1004]
    assert set(got["sentencepiece"]) == set(got["pii"]) == set(got["decontamination"])
    final = corpus_pipeline.run(spark, d).collect()
    assert {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in final} == \
        {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in at.collect()}


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    _, labels = corpus(30)
    d = tables(spark, tmp_path, rows(), labels)
    at = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, at, d), "test-stage")
        if name != "sentencepiece":
            assert set(CLASH) <= set(out.columns)
            ids = [r["doc_id"] for r in out.collect()]
            assert {3, 4, 5, 6, 9, 11, 13} <= set(ids) and ids.count(None) == 2
        at = out


def test_empty_tables(spark, tmp_path):
    d = tables(spark, tmp_path, rows(), [])
    at = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        at = materialize(stage(spark, at, d), "test-stage")
        assert at.count() == 0
