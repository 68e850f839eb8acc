"""Batch versus stream: the same freshness and dedup rules give the same rows."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import SF_SMALL
from feedloom.functions.times import is_fresh
from feedloom.plans import inputs as I
from feedloom.session import scratch_path
from feedloom.streaming import ingest
from feedloom.streaming.ledger import Ledger



def test_stream_equals_batch(spark):
    e = I.events(spark, SF_SMALL)
    batch = {r.event_id for r in e.where(is_fresh("ts", I.AS_OF_FRESH, 24)).collect()}
    base = scratch_path(spark, "t-stream")
    raw = I.table(spark, SF_SMALL, "events")
    for i in range(3):  # three deliveries, overlapping
        raw.where(F.col("event_id") % 3 != i).write.parquet(f"{base}/landing/d={i}")
    s = ingest.read_landed(spark, f"{base}/landing/*", raw.schema, max_files_per_trigger=1)
    s = s.withColumn("ts", F.col("ts").cast("timestamp"))
    f = ingest.fresh_only(s, "ts", I.AS_OF_FRESH, 24)
    ingest.run_available_now(f.select("event_id", "ts"), f"{base}/ckpt",
                             ingest.ledger_writer(f"{base}/ledger", "event_id", f"{base}/ckpt", ["ts"]))
    got = [r.event_id for r in Ledger(spark, f"{base}/ledger", "event_id", StructType.fromDDL("event_id long, ts timestamp"), ["ts"]).rows().collect()]
    assert len(got) == len(set(got))
    assert set(got) == batch


def writer(tmp_path, run):
    (tmp_path / run).mkdir()
    (tmp_path / run / "metadata").write_text('{"id":"%s"}' % run)
    return ingest.ledger_writer(str(tmp_path / "ledger"), "k", str(tmp_path / run), ["n"])


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k string, n int")


def open_ledger(spark, tmp_path, buckets=4):
    return Ledger(spark, str(tmp_path / "ledger"), "k", StructType.fromDDL("k string, n int"), ["n"], buckets)


def ledger(spark, tmp_path):
    return sorted((r.k, r.n) for r in open_ledger(spark, tmp_path).rows().collect())


def test_ledger_batch_replay_is_idempotent(spark, tmp_path):
    w = writer(tmp_path, "one")
    w(rows(spark, ("a", 2), ("b", 1), ("a", 1)), 0)
    w(rows(spark, ("a", 2), ("b", 1), ("a", 1)), 0)  # replay of the same batch
    w(rows(spark, ("b", 0), ("c", 7)), 1)
    assert ledger(spark, tmp_path) == [("a", 1), ("b", 1), ("c", 7)]


def test_another_checkpoint_keeps_earlier_rows(spark, tmp_path):
    writer(tmp_path, "one")(rows(spark, ("a", 1), ("b", 1)), 0)
    writer(tmp_path, "two")(rows(spark, ("a", 5), ("c", 5)), 0)
    assert ledger(spark, tmp_path) == [("a", 1), ("b", 1), ("c", 5)]


def test_ledger_is_not_shuffled(spark, tmp_path):
    led = open_ledger(spark, tmp_path, buckets=16)
    led.append(rows(spark, *[(f"k{i}", i) for i in range(200)]), "a", 0)
    plan = led.new_rows(rows(spark, ("k1", 0), ("x", 1)))._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("LeftAnti"):]
    scan = side[:side.index("ledger_")] if "ledger_" in side else side
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    # exchanges belong to the batch: none stands above the ledger's scan alone
    assert plan.count("Exchange hashpartitioning(k") == plan.count("Exchange hashpartitioning(k", 0, plan.rindex("FileScan parquet")), scan
    read = led.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in read
    assert sorted(r.k for r in led.new_rows(rows(spark, ("k1", 0), ("x", 1), ("x", 0))).collect()) == ["x"]


def test_two_writers_at_once(spark, tmp_path):
    """Both found the key new before either wrote: the reader sees it once."""
    one, two = open_ledger(spark, tmp_path), open_ledger(spark, tmp_path, buckets=9)
    assert two.buckets == one.buckets == 4
    a, b = one.new_rows(rows(spark, ("a", 2), ("b", 5))).collect(), two.new_rows(rows(spark, ("a", 1), ("c", 3))).collect()
    one.append(spark.createDataFrame(a, "k string, n int"), "one", 0, known_new=True)
    two.append(spark.createDataFrame(b, "k string, n int"), "two", 0, known_new=True)
    assert len(one.rows().collect()) == 4
    assert sorted((r.k, r.n) for r in one.read().collect()) == [("a", 1), ("b", 5), ("c", 3)]


def test_rows_without_a_key_stay_beside_the_ledger(spark, tmp_path):
    w = writer(tmp_path, "one")
    w(rows(spark, (None, 1), ("a", 1), (None, 1)), 0)
    w(rows(spark, (None, 2), ("a", 0)), 1)
    w(rows(spark, (None, 2), ("a", 0)), 1)
    assert ledger(spark, tmp_path) == [("a", 1)]
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "ledger-nulls")).collect()) == [1, 1, 2]


def test_state_and_ledger_keep_every_late_key(spark, tmp_path):
    land, base = str(tmp_path / "landing"), str(tmp_path)
    schema = StructType.fromDDL("k string, t timestamp, n int")

    def deliver(*data):
        spark.createDataFrame([(k, t, n) for k, t, n in data], "k string, t string, n int").withColumn("t", F.col("t").cast("timestamp")) \
            .coalesce(1).write.mode("append").parquet(land)
        kept = ingest.stateful_dedup(ingest.read_landed(spark, land, schema), "k", "t", "1 hour")
        ingest.run_available_now(kept, f"{base}/on", ingest.ledger_writer(f"{base}/ledger", "k", f"{base}/on", ["t", "n"], known_new=True))
        ingest.run_available_now(ingest.read_landed(spark, land, schema), f"{base}/late", ingest.late_writer(
            f"{base}/ledger", "k", f"{base}/late", ["t", "n"], "t", "1 hour"))
    deliver(("a", "2024-01-01 10:00:00", 1), ("b", "2024-01-01 10:10:00", 1), ("a", "2024-01-01 10:20:00", 2))
    deliver(("c", "2024-01-02 12:00:00", 1))
    # by now the watermark is a day ahead: two late rows, of which one is new
    deliver(("a", "2024-01-01 10:00:00", 3), ("late", "2024-01-01 09:00:00", 1), ("d", "2024-01-02 12:10:00", 1))
    deliver(("late", "2024-01-01 09:00:00", 2), ("d", "2024-01-02 12:20:00", 9))
    got = Ledger(spark, f"{base}/ledger", "k", schema, ["t", "n"]).read().collect()
    assert sorted((r.k, r.n) for r in got) == [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("late", 1)]
    late = {r.batch_id: r.late for r in spark.read.parquet(f"{base}/late-late").collect()}
    assert late[2] == 2 and late[3] == 1
