"""Query for web archives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm import archives
from stemma.llm.common import read
from stemma.session import scratch_root, write_out


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to an ARC file, converted to a WARC record and read back."""
    path = f"{scratch_root(spark)}/archives-{uuid.uuid4().hex}"
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("key"), "url", F.encode("html", "UTF-8").alias("payload"))
    archives.write_arc(pages, f"{path}/arc")
    archives.convert(spark, f"{path}/arc", f"{path}/warc")
    records = write_out(archives.read_warc(spark, f"{path}/warc"), "warc-records").where("kind in ('response', 'revisit')")
    found = archives.with_targets(records)
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("target_key").cast("long").alias("refers_to"))


QUERIES = {f.__name__: f for f in (op13_warc,)}
ORACLES: dict[str, str] = {}
