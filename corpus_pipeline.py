"""A training corpus from ``documents``, in five stages that each call one operator.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept, and is written
as Parquet and read again before the next one starts. All but the last return the columns of
``documents``, whatever others it has.

Rows of null or empty text, or without a letter, have no language and go with the first stage. Ids may
be null or repeat: of rows equal in all columns one stays, others are told apart by their texts, and none goes for another's.
Nulls in other columns change nothing. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleloom.llm import bpe, decontam, langid, pii, simhash
from tripleloom.llm.common import stage
from tripleloom.llm.queries import VOCABULARY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the language is known; ``lang`` keeps its given value."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data; ``n_chars`` follows the new text."""
    return pii.pseudonymise(docs, pii.session_key(spark)).drop("n_entities").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every document."""
    return bpe.encode(docs, VOCABULARY)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Fingerprints, searches and surrogates have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
