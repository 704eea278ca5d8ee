"""The training-data pipeline: each stage reads what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
frame with the columns of ``documents``, the last one the encoded documents. ``run``
writes every stage's result as Parquet and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparktide.llm import bpe, exact_dedup, language, mixing, simhash
from sparktide.workspace import materialise

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a supported language stay."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHashes of four-word shingles within four bits the one with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, width=4, radius=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each source: a row per copy, cut where a block ends inside a document."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, and whether decoding them gives the text back."""
    return bpe.encode_checked(docs, TOKENIZER).withColumn("n_tokens", bpe.count_ids())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The stages train models, hash and encode: no SQL gives these rows. Tests hold
# each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
