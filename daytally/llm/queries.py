"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import brown, byte_bpe, galloping, lsh_forest, minhash, mixing, pii, prefix_table, ratings, shallot, simhash, suffixes, toxicity
from daytally.llm.words import crc_of_id, documents

#: A byte-level vocabulary; its place is a parameter of the operator.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The same vocabulary as a tokenizer file.
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
#: A sentencepiece model, likewise.
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings: 0 for low quality, 1 for good but toxic, 2 for good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).otherwise(2 - F.coalesce("toxic", F.lit(0))).alias("grade")).where("quality is not null")


def op1_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return lsh_forest.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(documents(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN)


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op4_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ratings.rate(docs, ratings.fit(docs, grades(labels(spark, sf_dir))))


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), crc_of_id(F.col("doc_id")) % 7 == 2
    return brown.score(docs, brown.fit(docs.where(~F.coalesce(held_out, F.lit(False)))), held_out)


def op7_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), crc_of_id(F.col("doc_id")) % 5 == 0
    training = labels(spark, sf_dir).where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.fit(docs, training))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")  # no id: not held out


def op8_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_edits(documents(spark, sf_dir))


def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return galloping.alignment(documents(spark, sf_dir), BYTE_LEVEL, public_tokenizers.PATTERN, MODEL)


def op13_prefix_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_table.encode(documents(spark, sf_dir), MODEL)


QUERIES = {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}

ORACLE: dict[str, str] = {}
