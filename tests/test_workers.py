"""What a worker of an Arrow stage holds doesn't grow with its partition."""
import pyarrow as pa
from pyspark.sql import functions as F

from feedloom.functions.workers import lean
from feedloom.operators.html import clean_html
from feedloom.session import apply_conf
from feedloom.sources.feeds import feed_items


def _bodies(spark, n, text):
    apply_conf(spark)
    return spark.range(0, n, 1, 1).select(F.col("id").alias("feed_id"), F.lit("u").alias("source_url"), F.concat(
        F.lit("<rss><item><title>t"), F.col("id").cast("string"), F.lit("</title><description>"), F.repeat(F.lit(text), 20_000), F.lit("</description></item></rss>")).alias("body"))


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"])
    docs = _bodies(spark, 300, "words ")
    got = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 30 << 20 and max(got) < 8 << 20


def test_small_batches_and_pieces_lose_no_items(spark):
    docs = _bodies(spark, 60, "wörds 日 ")
    got = feed_items(docs, keep=["feed_id"]).select("feed_id", "pos", "title", F.length("body_html").alias("n")).collect()
    assert sorted(got) == [(i, 0, f"t{i}", 160_000) for i in range(60)]
    text = clean_html(docs, "body").select("feed_id", F.length("clean_text").alias("n")).collect()
    assert [r["feed_id"] for r in sorted(text)] == list(range(60)) and all(r["n"] > 100_000 for r in text)


def test_lean_passes_batches_and_errors_on():
    assert list(lean(lambda bs: (2 * b for b in bs))(iter([1, 2]))) == [2, 4]
    run = lean(lambda bs: (1 // b for b in bs))(iter([1, 0]))
    assert next(run) == 1
    try:
        next(run)
    except ZeroDivisionError:
        pass
    else:
        raise AssertionError
