"""Session settings for large clusters, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for these jobs. None of them names a master or a size: the
# cluster decides those.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build(builder=None, app: str = "tasteloom") -> SparkSession:
    builder = (builder or SparkSession.builder).appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local session.

    Spark itself adopts ``spark.checkpoint.dir`` at start-up, so nothing is set here
    when it is given.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tasteloom-"))
    return context.getCheckpointDir()
