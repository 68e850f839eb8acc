"""Training-text pipeline: documents -> cleaned documents -> token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what it
returns is written as Parquet and read again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.  Rows with null
or empty texts pass every filter; an empty table passes every stage; extra
columns are kept as they are up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import documents, materialize, prepare
from feedloom.llm.decontam import decontaminate
from feedloom.llm.minhash import drop_near_duplicates
from feedloom.llm.pii import pseudonymise_documents, session_key
from feedloom.llm.sampling import sample_segmentations
from feedloom.llm.toxicity import reject_toxic

#: Segmentations of each text in the last stage.
SAMPLES = 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.5 or more.  Null and empty
    texts stay; repeated rows stay or go together."""
    prepare(spark)
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word
    shingles, similarity 0.8 or more).  Null and blank texts stay, but for
    rows repeated in id and text."""
    prepare(spark)
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a passage of the benchmark.  Null and
    empty texts stay; repeated rows stay or go together."""
    prepare(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms of the same format, under the
    session's key.  Nulls and empty texts stay; repeated rows get equal texts."""
    prepare(spark)
    return pseudonymise_documents(docs, session_key(spark), count_col=None)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text, encoded and decoded again.  A null
    or empty text has one sample without ids; repeated rows get equal ones."""
    prepare(spark)
    import public_tokenizers

    return sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), SAMPLES)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]
#: Label model, signatures and sampled segmentations have no SQL form; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is
    written to the shared checkpoint folder and read again."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
