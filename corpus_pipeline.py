"""A corpus from documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stemma.llm import jaccard_join, language, packing, quality, repeated_bytes
from stemma.llm.common import read
from stemma.llm.queries_tokens import digest
from stemma.llm.word_ids import token_ids
from stemma.session import write_out


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labels, doesn't reject."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learned."""
    return language.keep(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard_join.keep_one(docs)


def without_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that stand elsewhere too."""
    return repeated_bytes.shorten(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return digest(packing.pack(token_ids(docs, public_tokenizers.path("word_bpe_49k.json"))))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("repeated_bytes", without_repeated_bytes),
    ("packing", packed),
]
#: Classifiers and tokenizers can't be put in SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
