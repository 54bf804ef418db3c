"""Session helpers: building a session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "stemma", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes (AQE, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is used only in local mode with the setting absent; on
    a cluster a machine-local folder would be lost with its executor, so the
    setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = os.path.join(tempfile.gettempdir(), f"stemma-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the scratch folder and read it back.

    Cuts lineage without a second evaluation of the input (a reliable
    checkpoint evaluates it twice) and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
