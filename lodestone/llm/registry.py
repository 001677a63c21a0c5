"""The queries of this subpackage and the SQL that gives the same results, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lodestone.llm import exact_dedup, fixity, mixing, multiset, near_dedup, pages, pieces, private, sharding, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_warc_fixity": fixity.op2_warc_fixity,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_sharding": sharding.op6_sharding,
    "op7_private_data": private.op7_private_data,
    "op8_fingerprints": multiset.op8_fingerprints,
    "op9_mixing": mixing.op9_mixing,
    "op10_html_extraction": pages.op10_html_extraction,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op2_warc_fixity": fixity.OP2_SQL,
    "op4_near_dedup": near_dedup.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}
