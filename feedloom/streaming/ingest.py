"""ST1-ST4: incremental landing, exactly-once-per-key, freshness, ledger.

The parse/normalise functions are the batch ones: they are stateless
column expressions, so the same code runs on a streaming DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.functions.times import to_ts
from feedloom.streaming.ledger import Ledger, path_exists


def read_landed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1: file-source stream over a landing folder (new files only)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def fresh_only(df: DataFrame, ts_col: str, as_of=None, hours: int = 24) -> DataFrame:
    """ST3: P3 as a late-data policy.  ``as_of=None`` uses the processing
    clock of each micro-batch (live); tests pass a literal."""
    now = F.current_timestamp() if as_of is None else to_ts(as_of)
    lo = now - F.make_dt_interval(F.lit(0), F.lit(hours))
    hi = now + F.expr("INTERVAL 1 HOUR")
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps with its checkpoint: the same over
    restarts, another one for another checkpoint."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").head()
    return json.loads(row[0])["id"]


def ledger_writer(ledger_path: str, key: str, checkpoint: str, order: Sequence[str],
                  known_new: bool = False) -> Callable[[DataFrame, int], None]:
    """ST2 + ST4 + SNK4: ``foreachBatch`` sink that appends only keys absent
    from the bucketed ledger, however late they come; within a batch the
    first row by ``order`` wins.

    A micro-batch owns the partition ``run=<query id>, batch_id=<id>`` and
    overwrites it, so a replayed batch (after a failure) writes the same rows
    once.  The query id comes from the checkpoint: another stream over the
    same ledger, whose batches count from 0 again, owns other partitions."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, ledger_path, key, batch.schema, order)
        ledger.append(batch, query_id(batch.sparkSession, checkpoint), batch_id, known_new)
    return write


#: Keeps the state of streams on local disk beside the executors, with
#: changes in the checkpoint, rather than in their memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_dedup(stream: DataFrame, key: str, ts_col: str, delay: str) -> DataFrame:
    """ST2 by state: the first row of each key among those that come within
    ``delay`` of the newest event time.  State holds the keys of that span
    only.  Rows older than the watermark are left to ``late_writer``."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])


def late_writer(ledger_path: str, key: str, checkpoint: str, order: Sequence[str], ts_col: str, delay: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink of a second query over the same source: rows that
    a stateful query may have dropped as late go to the ledger, if new, and
    are counted in ``<checkpoint>-late`` (``batch_id, newest, late``).

    Late is what lies ``delay`` or more before the newest event time of all
    batches so far, this one included.  The stateful query, which reads the
    same files in the same order, knew no newer time, so nothing that it drops
    is missed; rows that it kept are found in the ledger, or dropped by
    ``Ledger.read``."""
    seen_path = f"{checkpoint.rstrip('/')}-late"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max(ts_col)).first()[0]
        if path_exists(spark, seen_path):
            before = spark.read.schema("newest timestamp, late long, batch_id long").parquet(seen_path).where(F.col("batch_id") < batch_id)
            old = before.agg(F.max("newest")).first()[0]
            newest = max(x for x in (newest, old) if x is not None) if (newest or old) else None
        late = batch.where(F.lit(False)) if newest is None else batch.where(F.col(ts_col) <= F.lit(newest) - F.expr(f"INTERVAL {delay}"))
        Ledger(spark, ledger_path, key, batch.schema, order).append(late, query_id(spark, checkpoint), batch_id)
        late.agg(F.lit(newest).cast("timestamp").alias("newest"), F.count(F.lit(1)).alias("late")) \
            .write.mode("overwrite").parquet(f"{seen_path}/batch_id={batch_id}")
    return write


def run_available_now(df: DataFrame, checkpoint: str, sink: str | Callable[[DataFrame, int], None],
                      output_mode: str = "append") -> None:
    """Process everything landed so far, then stop (``availableNow``)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        q = w.foreachBatch(sink).start()
    else:
        q = w.format("parquet").option("path", sink).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
