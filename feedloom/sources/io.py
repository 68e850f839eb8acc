"""Table reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting: deal the rows of every table over this many partitions
#: after the scan.  Unset (the default), a table is returned as scanned.  For
#: files of a single row group, which no scan setting can split.
SCAN_PARTITIONS = "feedloom.scanPartitions"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table.  Filters and column pruning reach the scan; splits follow
    ``spark.sql.files.maxPartitionBytes`` and, if set, ``SCAN_PARTITIONS``."""
    df = spark.read.format(fmt).load(path)
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read from
    there, so that what follows neither repeats nor loses its work."""
    from feedloom.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
