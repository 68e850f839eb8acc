"""Registered queries of the operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chaining import op7_fuzzy_passages
from .cws import op9_fingerprints
from .decontam import op6_decontamination
from .minhash import ORACLE_SQL as MINHASH_SQL
from .minhash import op1_minhash
from .pii import op4_pii
from .rans import op5_rans_tokens
from .sampling import op10_sentencepiece
from .secrets import op12_secrets
from .sharding import op8_sharding
from .spelling import op13_spelling
from .suffix import ORACLE_SQL as SUFFIX_SQL
from .suffix import op2_suffix_array
from .toxicity import op3_toxicity
from .whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_minhash,
    op2_suffix_array,
    op3_toxicity,
    op4_pii,
    op5_rans_tokens,
    op6_decontamination,
    op7_fuzzy_passages,
    op8_sharding,
    op9_fingerprints,
    op10_sentencepiece,
    op11_whitening,
    op12_secrets,
    op13_spelling,
)}
SQL: dict[str, str] = {"op1_minhash": MINHASH_SQL, "op2_suffix_array": SUFFIX_SQL}
