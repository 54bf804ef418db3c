"""Leaf manifests: page ranges, what is stored, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- fixed values
BATCH_LEAVES = 26
# Leaves, wanted and stored, that one task compares, about.
TASK_LEAVES = 1_000_000
LEAF_FILE = r"^(.+)_(\d{4})\.jpg$"


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    """Stored leaf files: ``id, leaf, content``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jpg").load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.filter(name.rlike(LEAF_FILE)).select(
        F.regexp_extract(name, LEAF_FILE, 1).alias("id"), F.regexp_extract(name, LEAF_FILE, 2).cast("int").alias("leaf"), "content"
    )


def leaf_range(spec: Column) -> Column:
    """``"50-65"`` or ``"54"`` as an array of leaf numbers."""
    first = F.split_part(spec, F.lit("-"), F.lit(1)).cast("int")
    last = F.when(spec.contains("-"), F.split_part(spec, F.lit("-"), F.lit(2)).cast("int")).otherwise(first)
    # a range that runs backwards holds no leaf
    return F.when(last >= first, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))


def is_jpeg(content: Column) -> Column:
    return F.substring(content, 1, 2) == F.expr("X'FFD8'")


def good_leaves(blobs: DataFrame) -> DataFrame:
    """Stored leaves that are pictures; error pages do not count as stored."""
    return blobs.filter(is_jpeg(F.col("content"))).select("id", "leaf")


def leaf_manifest(ranges: DataFrame, stored: DataFrame, batch: int = BATCH_LEAVES, task: int = TASK_LEAVES) -> DataFrame:
    """Leaves still to be fetched: ``id, leaf, batch``.

    ``ranges(id, leaves)``, ``stored(id, leaf)``. Batches of ``batch`` leaves
    are counted from the first leaf of the range. A small table of ranges can
    name many leaves, so their number says over how many tasks they are dealt:
    one for each ``task`` rows.
    """
    leaves = leaf_range(F.col("leaves"))
    listed = ranges.agg(F.sum(F.size(leaves).cast("long"))).first()[0] or 0
    tasks = max(1, -(-(listed + stored.count()) // task))
    wanted = ranges.select("id", "leaves").repartition(tasks).select("id", F.posexplode(leaves).alias("_i", "leaf"))
    # dealt by both keys before they are combined, so no task combines what a whole file holds
    wanted = wanted.repartition(tasks, "id", "leaf").groupBy("id", "leaf").agg((F.floor(F.min("_i") / batch) + 1).cast("int").alias("batch"))
    held = stored.select("id", "leaf").repartition(tasks, "id", "leaf").distinct()
    return wanted.join(held, ["id", "leaf"], "left_anti").select("id", "leaf", "batch")


def batch_ranges(ranges: DataFrame, batch: int = BATCH_LEAVES) -> DataFrame:
    """Batches of a first and last leaf: ``id, batch, first, last, batches``.

    ``ranges(id, first, last)``; an empty range gives no batch.
    """
    good = ranges.filter(F.col("last") > F.col("first"))
    starts = F.sequence(F.col("first"), F.col("last"), F.lit(batch))
    rows = good.select("id", "last", F.size(starts).alias("batches"), F.posexplode(starts).alias("_i", "first"))
    return rows.select(
        "id", (F.col("_i") + 1).alias("batch"), "first",
        F.least(F.col("first") + batch - 1, F.col("last")).alias("last"), "batches",
    )


def batch_status(results: DataFrame) -> DataFrame:
    """One status per document from its batches.

    ``results(id, batches, ok, blocked)``: done when every batch came back
    good, else filter-blocked or batch-failed.
    """
    rows = results.groupBy("id").agg(
        F.max("batches").alias("batches"),
        F.count(F.when(F.col("ok") & ~F.col("blocked"), 1)).alias("_good"),
        F.count(F.when(F.col("ok"), 1)).alias("parts_saved"),
        F.max("blocked").alias("_blocked"),
    )
    status = F.when(F.col("_good") == F.col("batches"), "done").when(F.col("_blocked"), "filter-blocked").otherwise("batch-failed")
    return rows.select("id", "batches", "parts_saved", status.alias("status"))
