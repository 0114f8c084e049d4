"""Folders that are replaced while others read them.

A table's content goes into a new folder each time and is never changed again. A small
table beside it, the log, gets one more row when the folder is complete; that row's file
appears as a whole or not at all. Readers take the newest row once and go on with its
folder, so replacing a table neither disturbs a running query nor shows half a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "folder string, version bigint, through bigint"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}Versions"


def fresh(path: str) -> str:
    """A folder for the next content of the table at ``path``; nobody reads it yet."""
    return f"{path.rstrip('/')}/{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def history(spark: SparkSession, path: str) -> DataFrame:
    """All published folders: ``folder, version, through``."""
    if not _exists(spark, _log(path)):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(_log(path))


def publish(spark: SparkSession, path: str, folder: str, through: int | None = None) -> int:
    """Make a complete folder the table's content; ``through`` is the caller's own mark.

    Of two writers that publish at the same time one is the newest for all readers.
    """
    version = (history(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    row = spark.createDataFrame([(folder, version, through)], LOG)
    row.coalesce(1).write.mode("append").parquet(_log(path))
    return version


def newest(spark: SparkSession, path: str) -> tuple[str, int, int | None] | None:
    """Folder, version and mark of the newest content; None before the first."""
    order = F.struct("version", "folder")
    row = history(spark, path).agg(F.max_by(F.struct("folder", "version", "through"), order)).first()[0]
    return tuple(row) if row else None


def current(spark: SparkSession, path: str) -> str:
    """The folder to read now."""
    found = newest(spark, path)
    if found is None:
        raise ValueError(f"nothing has been published for {path}")
    return found[0]


def delete(spark: SparkSession, folder: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete published folders but the newest ``keep``; for when no reader can still be on them."""
    if keep < 1:
        raise ValueError("the newest content can't be dropped")
    rows = history(spark, path).orderBy(F.desc("version"), F.desc("folder")).collect()
    return [row["folder"] for row in rows[keep:] if delete(spark, row["folder"])]
