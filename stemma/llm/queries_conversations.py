"""Query for the repair of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import conversations
from stemma.llm.common import read


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged, with its faults and the cheapest edits that repair it."""
    return conversations.repair(conversations.damage(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op11_conversation_repair,)}
ORACLES: dict[str, str] = {}
