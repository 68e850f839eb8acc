"""Record store and exports: SNK1-SNK7, SRC12, G2, G3, P9, X3, X4.

The store is a Parquet table partitioned by ``record_type`` (and ``month``
when asked, X3); payloads are variants, so one table holds every record
type and no read parses text.  Reads prune partitions on ``record_type`` and
take only the payload fields that a caller selects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import nullif_empty, truncate
from feedloom.schemas import LOG_TAB, RECORD_TYPES, SCHEMA_VERSION, TABS, envelope_schema

SNIPPET_CHARS = 200


def envelope(df: DataFrame, record_type: str, content: dict[str, Column], source_name: Column,
             source_url: Column, collected_at: Column) -> DataFrame:
    """Build the record envelope columns from per-type content."""
    return df.select(
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(record_type).alias("recordType"),
        F.struct(*[c.alias(k) for k, c in content.items()]).alias("content"),
        F.struct(source_name.alias("name"), source_url.alias("url")).alias("source"),
        collected_at.alias("collectedAt"),
    )


def with_source_url(envelopes: DataFrame) -> DataFrame:
    """SNK2: an empty source URL falls back to the paper's own."""
    url = F.coalesce(nullif_empty(F.col("source.url")), F.col("content.paper_url"))
    return envelopes.withColumn("source", F.struct(F.col("source.name").alias("name"), url.alias("url")))


def to_store_rows(envelopes: DataFrame, record_type: str, month_from: str | None = None) -> DataFrame:
    """SNK1/SNK2: ``record_type, source_url, payload`` (+ ``month``).  The
    source URL falls back to ``content.paper_url`` when empty."""
    src = F.col("source.url")
    if "paper_url" in envelopes.schema["content"].dataType.fieldNames():
        src = F.coalesce(nullif_empty(src), F.col("content.paper_url"))
    cols = [F.lit(record_type).alias("record_type"), src.alias("source_url"),
            _payload(envelopes.columns)]
    if month_from:
        cols.append(F.substring(F.col(month_from), 1, 7).alias("month"))
    return envelopes.select(*cols)


def _payload(columns: Sequence[str]) -> Column:
    return F.to_variant_object(F.struct(*[F.col(c) for c in columns])).alias("payload")


def save_records(rows: DataFrame, path: str, partition_by: Sequence[str] = ("record_type",)) -> int:
    """SNK1 + G2: append (no dedup, as in the reference; pair with
    ``dedup.ledger_additions`` for insert-if-absent) and return the number
    of rows written, observed during the write itself (no second pass)."""
    from pyspark.sql import Observation
    obs = Observation("saved")
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(*partition_by).parquet(path)
    return int(obs.get["n"])


def save_rejects(rejected: DataFrame, record_type: str, path: str) -> None:
    """P10: the records left out, as ``record_type, reason, payload``."""
    cols = [c for c in rejected.columns if c != "violations"]
    (rejected.select(F.lit(record_type).alias("record_type"), F.array_join("violations", ",").alias("reason"), _payload(cols))
     .write.mode("append").parquet(path))


def save_log(log: DataFrame, path: str) -> int:
    """SNK3: append the log and return the number of rows written, observed
    during the write itself."""
    from pyspark.sql import Observation
    obs = Observation("logged")
    log.select("raw_name", "canonical_name", "match_method").observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return int(obs.get["n"])


def read_records(spark: SparkSession, path: str, record_type: str) -> DataFrame:
    """SRC12 + P9: one record type back as typed envelopes.  The filter on
    the partition column prunes every other type's files."""
    rows = spark.read.parquet(path).where(F.col("record_type") == record_type)
    return rows.select(F.variant_get("payload", "$", envelope_schema(record_type).simpleString()).alias("r")).select("r.*")


def count_by_type(spark: SparkSession, path: str) -> DataFrame:
    """Stored rows per known record type."""
    return (spark.read.parquet(path).where(F.col("record_type").isin(RECORD_TYPES))
            .groupBy("record_type").agg(F.count(F.lit(1)).alias("n")))


def payload_field(payload: Column, path: str, kind: str = "string") -> Column:
    """Key query on the payload (null where the key is missing)."""
    return F.try_variant_get(payload, path, kind)


def _text(c: Column, dtype: str) -> Column:
    """CSV value rules: null -> empty, booleans as True/False, lists joined."""
    if dtype == "boolean":
        return F.coalesce(F.when(c, F.lit("True")).when(~c, F.lit("False")), F.lit(""))
    if dtype.startswith("array"):
        return F.coalesce(F.array_join(c, ", "), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def tab_frame(envelopes: DataFrame, tab: str) -> DataFrame:
    """Flatten one record type to its export tab (all text columns)."""
    _, layout = TABS[tab]
    cols = []
    for header, path in layout:
        c = F.col(path)
        dtype = envelopes.select(c).schema.fields[0].dataType.simpleString()
        t = _text(c, dtype)
        if header == "Text Snippet":
            t = truncate(t, SNIPPET_CHARS)
        cols.append(t.alias(header))
    return envelopes.select(*cols)


def log_tab_frame(log: DataFrame) -> DataFrame:
    return log.select(*[F.coalesce(F.col(src), F.lit("")).alias(h) for h, src in LOG_TAB])


def write_csv(frame: DataFrame, path: str) -> None:
    """SNK6/SNK7: header row, minimal quoting, quotes doubled."""
    (frame.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
          .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))


def write_json_lines(envelopes: DataFrame, path: str) -> None:
    """SNK5: papers as JSON (one object per line, UTF-8 unescaped)."""
    envelopes.write.mode("overwrite").json(path)
