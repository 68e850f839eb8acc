"""As-of lookup of earlier sightings in a history of crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.sources.io import written


def last_seen(sightings: DataFrame, link: str, ts: str, tie: str, bucket: str = "DAY") -> DataFrame:
    """``sightings`` with ``last_seen``: the time of the sighting of the same
    link just before (by ``ts``, then ``tie``), null for the first.

    Rows meet within their link and time bucket only, so a link that holds
    a third of all rows is spread over its days; between buckets goes one row
    a link and day.  The input is read once.  Sightings without a link or a
    time have no earlier one."""
    key = [link, "__bucket"]
    inside = Window.partitionBy(*key).orderBy(ts, tie)
    known = F.col(link).isNotNull() & F.col(ts).isNotNull()
    # rows without a key are dealt out by themselves
    cut = F.when(known, F.date_trunc(bucket, F.col(ts)).cast("string")).otherwise(F.concat(F.lit("/"), F.xxhash64(tie).cast("string")))
    near = sightings.withColumn("__bucket", cut).withColumn("__known", known) \
        .withColumn("__near", F.when(F.col("__known"), F.max(ts).over(inside.rowsBetween(Window.unboundedPreceding, -1)))) \
        .withColumn("__first", F.row_number().over(inside) == 1) \
        .withColumn("__last", F.max(ts).over(Window.partitionBy(*key)))
    near = written(near, "sightings")
    days = near.where("__first and __known").select(*key, "__last")
    before = Window.partitionBy(link).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(*key, F.max("__last").over(before).alias("__carried"))
    # only a bucket's rows without an earlier one inside it ask
    asks = near.withColumn("__b", F.when(F.col("__known") & F.col("__near").isNull(), F.col("__bucket")).otherwise(
        F.concat(F.lit("/"), F.xxhash64(tie).cast("string"))))
    carried = carried.select(F.col(link).alias("__l"), F.col("__bucket").alias("__b"), "__carried")
    return asks.join(carried, (asks[link] == carried["__l"]) & (asks["__b"] == carried["__b"]), "left") \
        .select(*[asks[c] for c in sightings.columns], F.coalesce("__near", "__carried").alias("last_seen"))
