"""J1 entity resolution against a seed table, and its audit log.

The seed table is one side of two left equi-joins.  No hint and no row
count decides the plan: Spark broadcasts the table while its size is under
the session's threshold and shuffles both sides beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.names import DEFAULT_SEEDS, heuristic_core, is_blank, normalize_name, nospace
from feedloom.functions.text import nullif_empty, py_strip

EXACT = "exact_seed_match"
NOSPACE = "nospace_seed_match"
NORMALIZED = "normalized"
UNKNOWN = "Unknown"


def seed_table(spark: SparkSession, seeds: Sequence[str] | None = None) -> DataFrame:
    """key -> canonical.  Each seed maps its normalised form and that
    form without spaces; on a collision the later seed wins.  An empty or
    missing list means the default list."""
    seeds = list(seeds) if seeds else list(DEFAULT_SEEDS)
    # an Arrow table becomes a local relation, whose size the planner knows
    df = spark.createDataFrame(pa.table({"seed_pos": pa.array(range(len(seeds)), pa.int64()), "canonical": pa.array(seeds, pa.string())}))
    norm = normalize_name("canonical")
    keyed = df.select(
        "seed_pos", "canonical",
        F.explode(F.array(F.struct(norm.alias("key"), F.lit(0).alias("sub")),
                          F.struct(nospace(norm).alias("key"), F.lit(1).alias("sub")))).alias("k"),
    ).select("seed_pos", "canonical", F.col("k.key").alias("key"), F.col("k.sub").alias("sub"))
    # last write wins: highest (seed_pos, sub) per key
    last = keyed.groupBy("key").agg(F.max(F.struct("seed_pos", "sub", "canonical")).alias("w"))
    return last.select("key", F.col("w.canonical").alias("canonical"))


def resolve_names(df: DataFrame, name_col: str, seeds: Sequence[str] | None = None,
                  out_prefix: str = "") -> DataFrame:
    """Add ``{p}raw_clean``, ``{p}canonical_name``, ``{p}match_method``.

    Blank names resolve to ``Unknown`` with a null method (they write no
    log row).  The fallback heuristic is evaluated for unmatched names only."""
    table = seed_table(df.sparkSession, seeds)
    p = out_prefix
    raw = F.col(name_col)
    base = df.select("*", py_strip(raw).alias("__raw_clean"), is_blank(raw).alias("__blank"))
    tmp = base.select("*", normalize_name("__raw_clean").alias("__norm"))
    t1 = table.select(F.col("key").alias("__k1"), F.col("canonical").alias("__c1"))
    t2 = table.select(F.col("key").alias("__k2"), F.col("canonical").alias("__c2"))
    j = (tmp.join(t1, tmp["__norm"] == t1["__k1"], "left")
            .join(t2, nospace(tmp["__norm"]) == t2["__k2"], "left"))
    blank = F.col("__blank")
    core = heuristic_core("__raw_clean")
    canonical = (F.when(blank, F.lit(UNKNOWN))
                  .when(F.col("__c1").isNotNull(), F.col("__c1"))
                  .when(F.col("__c2").isNotNull(), F.col("__c2"))
                  .otherwise(F.coalesce(nullif_empty(core), F.col("__raw_clean"))))
    method = (F.when(blank, F.lit(None).cast("string"))
               .when(F.col("__c1").isNotNull(), F.lit(EXACT))
               .when(F.col("__c2").isNotNull(), F.lit(NOSPACE))
               .otherwise(F.lit(NORMALIZED)))
    return j.select(*df.columns,
                    F.when(~blank, F.col("__raw_clean")).alias(f"{p}raw_clean"),
                    canonical.alias(f"{p}canonical_name"),
                    method.alias(f"{p}match_method"))


def resolution_log(resolved: DataFrame, prefix: str = "") -> DataFrame:
    """one row per resolve call on a non-blank name (duplicates kept)."""
    p = prefix
    return (resolved.filter(F.col(f"{p}match_method").isNotNull())
            .select(F.col(f"{p}raw_clean").alias("raw_name"),
                    F.col(f"{p}canonical_name").alias("canonical_name"),
                    F.col(f"{p}match_method").alias("match_method")))


def resolution_rates(log: DataFrame) -> DataFrame:
    """Calls per method and the share in parts per million."""
    from pyspark.sql import Window
    per = log.groupBy("match_method").agg(F.count(F.lit(1)).alias("n"))
    # the window spans the few aggregated rows (one per method), not the log
    total = F.sum("n").over(Window.partitionBy())
    return per.select("match_method", "n", (F.col("n") * 1_000_000 / total).cast("bigint").alias("share_ppm"))
