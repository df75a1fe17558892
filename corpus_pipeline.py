"""A training corpus from the documents table, in five stages.

Each stage gets what the one before it kept and its decisions take effect:
documents that the quality classifier rejects are dropped, one document of
each group of near duplicates stays, personal data is replaced in the texts,
documents are drawn to the target mixture, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daytally.llm import byte_bpe, mixing, pii, ratings, simhash
from daytally.llm.queries import VOCABULARY, grades, labels
from daytally.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are probably of the lowest grade; fitted on the rated ones of its input."""
    return ratings.select(docs, ratings.fit(docs, grades(labels(spark, sf_dir))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component (one row, if rows repeat); null ids stay."""
    return simhash.select(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents that hold seven tenths of the tokens, to the target shares of source, language and topic."""
    return mixing.select(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the final texts, with the digests of ids and decoded bytes."""
    encoded = byte_bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, ("ids",))
    return encoded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mixture),
    ("byte-level BPE", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL: the classifier, SimHash and the encoder have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None
