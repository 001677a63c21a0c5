"""From documents to token ids in five stages; each is written as Parquet and read again as the next one's documents.

Toxic documents go; of equal texts one stays; of each group of near copies one stays; sources are mixed to tempered
weights (none loses a document, small ones repeat some, at most MIX_REPETITION times) and written in the order of the
mixture's blocks; texts become token ids, with the parity of every row. Every stage works on all rows of the one before;
all but the last return the columns of documents.

Defined cases, as the operators have them: null and empty texts are not toxic by themselves, are one text to exact_dedup
(the row of the smallest doc_id stays) and encode to no ids; rows without a doc_id stay unless their text has a row with
one; repeated rows are one row after exact_dedup; rows of one doc_id with different texts all go on; long texts are worked on
whole; an empty table gives an empty result; further columns of documents, whatever their names, pass through all stages but
the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import exact_dedup, mixing, near_dedup, pieces, toxicity
from lodestone.llm._shared import discard_since, mark, read, written

MIX_REPETITION = mixing.REPETITION


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: without the documents it predicts to be toxic. The labels say which documents teach it."""
    return toxicity.reject(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near copies."""
    return near_dedup.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents as often as the mixture takes them, once at least."""
    return mixing.mix(docs, repetition=MIX_REPETITION)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: doc_id, ids, whether decoding gives the text back, and whether sentencepiece gives the same ids."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("exact_dedup", copies),
    ("near_dedup", near_copies),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: Toxicity and tokens can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result. A stage's own tables, and what it read, are deleted once its result is written."""
    docs, before = read(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard_since(spark, before, docs)
    return docs
