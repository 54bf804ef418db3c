"""Query for document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import minhash
from stemma.llm.common import read


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return minhash.compare_with_next(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op9_fingerprints,)}
ORACLES: dict[str, str] = {}
