import zlib

import pytest
from fixtures_llm import empty, messy, rows
from pyspark.sql import functions as F

from feedloom.llm.sharding import assign_shards, permute


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 1000, 4099])
def test_permutation_is_a_bijection(spark, n):
    got = [r[0] for r in spark.range(n).select(permute(F.col("id"), n, "k")).collect()]
    assert sorted(got) == list(range(n))


def test_keys_give_other_orders(spark):
    a, b = ([r[0] for r in spark.range(500).select(permute(F.col("id"), 500, k)).collect()] for k in ("a", "b"))
    assert a != b and a != sorted(a)


def check(rows_, n, shards):
    assert len(rows_) == n
    per = {}
    for r in rows_:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    sizes = [len(per.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_awkward_rows(spark):
    got = assign_shards(messy(spark), 3).collect()
    check(got, len(rows()), 3)
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"rows"} and all(r["grown_shard"] is None for r in got)


def test_same_result_for_any_partitioning(spark):
    key = lambda df: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())
    assert key(assign_shards(messy(spark).repartition(1), 4)) == key(assign_shards(messy(spark).repartition(5), 4))


def test_same_result_for_any_shuffle_width(spark):
    key = lambda df: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())
    had, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for width in (3, 8, 17):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            got.append(key(assign_shards(messy(spark), 4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
    assert got[0] == got[1] == got[2]


def test_many_equal_rows(spark):
    df = spark.range(500).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    check(assign_shards(df, 16).collect(), 500, 16)


def test_empty(spark):
    assert assign_shards(empty(spark)).count() == 0
