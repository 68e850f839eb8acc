"""SNK4 / J4 / ST4: a key ledger as a bucketed table.

The ledger is a Parquet table at a path, bucketed and sorted by the key and
partitioned by ``run`` and ``batch_id``.  A batch is shuffled into the
ledger's buckets and merged with them; the ledger itself is never shuffled.
A batch owns its partition and overwrites it, so a replayed batch writes the
same rows once.

Two writers at the same time may both find a key new.  ``read`` settles that:
one row a key, the first by the ledger's order, then by run and batch; it is
a grouping by the bucket column, so it needs no shuffle either.

Rows without a key have no identity; they are kept beside the ledger
(``path-nulls``), not in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feedloom.operators.dedup import first_wins


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class Ledger:
    """A ledger at ``path`` with rows of ``schema``, keyed by ``key``.

    ``order``: columns by which the first row of a key wins.  ``buckets`` is
    taken when the ledger is new; later it is read from the ledger.  It
    should follow the ledger's size, not the session's shuffle width."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, order: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        self.columns = [f.name for f in schema.fields]
        marker = f"{self.path}-buckets"
        if path_exists(spark, marker):
            buckets = spark.read.schema("buckets int").parquet(marker).agg(F.min("buckets")).first()[0]
        else:
            spark.createDataFrame([(buckets,)], "buckets int").write.mode("ignore").parquet(marker)
        self.buckets = int(buckets)
        self.table = "ledger_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        full = StructType([*schema.fields, StructField("run", StringType()), StructField("batch_id", LongType())])
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({cols}) USING parquet PARTITIONED BY (run, batch_id) "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.sql(f"MSCK REPAIR TABLE {self.table}")
        spark.catalog.refreshTable(self.table)

    def rows(self) -> DataFrame:
        """What was appended, with ``run`` and ``batch_id``."""
        return self.spark.table(self.table)

    def read(self) -> DataFrame:
        """The ledger: one row a key."""
        return first_wins(self.rows(), self.key, [*self.order, "run", "batch_id"]).select(*self.columns)

    def new_rows(self, batch: DataFrame, run: str = "", batch_id: int = -1) -> DataFrame:
        """The first row by ``order`` of each key of ``batch`` that the ledger
        lacks (what the same batch wrote in an earlier attempt doesn't count)."""
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        fresh = first_wins(batch.where(F.col(self.key).isNotNull()).select(*self.columns), self.key, self.order)
        # the buckets decide the partitioning of the join
        return fresh.repartition(self.buckets, self.key).join(self.rows().where(~own).select(self.key).hint("merge"), self.key, "left_anti")

    def append(self, batch: DataFrame, run: str, batch_id: int, known_new: bool = False) -> None:
        """Appends the new rows of ``batch``.  ``known_new``: its keys were
        found new otherwise (state), so the ledger is not looked at; ``read``
        drops what it holds twice."""
        rows = batch.where(F.col(self.key).isNotNull()).select(*self.columns).repartition(self.buckets, self.key) if known_new \
            else self.new_rows(batch, run, batch_id)
        out = rows.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("long")).select(*self.columns, "run", "batch_id")
        conf = self.spark.conf
        had = conf.get(_OVERWRITE)
        conf.set(_OVERWRITE, "dynamic")  # only the batch's own partition
        try:
            out.write.mode("overwrite").insertInto(self.table)
        finally:
            conf.set(_OVERWRITE, had)
        lost = batch.where(F.col(self.key).isNull()).select(*self.columns)
        lost.write.mode("overwrite").parquet(f"{self.path}-nulls/run={run}/batch_id={batch_id}")
        self.spark.catalog.refreshTable(self.table)
