"""From raw documents to packed training sequences: five stages, each stored before the next.

Every stage takes the documents its predecessor kept and returns documents with
the same columns; the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import exact_dedup, language, near_dedup, packing, pii
from martloom.llm.common import documents, fold, stored

# Language mixtures cannot be inferred in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language is found, such as empty ones or ones without letters."""
    model = language.fit_languages(docs.filter(fold("doc_id", 5) != 0))
    return language.keep_languages(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts keeps the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles keeps the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; the length of the text follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of a folder, each to the stored result of the one before."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
