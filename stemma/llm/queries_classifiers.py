"""Queries for text quality and language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import language, quality
from stemma.llm.common import held_out, read


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score and the decision."""
    docs = read(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op7_quality, op8_language)}
ORACLES: dict[str, str] = {}
