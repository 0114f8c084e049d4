"""Tables stored by hash buckets of a key, so that joins and sums by it need no shuffle."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tasteloom.sources.tables import Store


def _table(store: Store, name: str) -> str:
    """The catalog's name for the table: one for each place."""
    return f"{name}_{zlib.crc32(store.path(name).encode()):08x}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_colocated(df: DataFrame, store: Store, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``key``, each sorted, and go on from them.

    Two tables with as many buckets of the same key join side by side. Rows are dealt out by
    bucket first, so that a bucket is one file; a key with a large share of all rows makes
    its bucket as large, so this is for keys without such ones.
    """
    table = _table(store, name)
    (
        df.repartition(buckets, key)
        .write.format(store.fmt)
        .options(**store.options)
        .option("path", store.path(name))
        .bucketBy(buckets, key)
        .sortBy(key)
        .mode("overwrite")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def read_colocated(
    spark: SparkSession, store: Store, name: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """The table in a session that has not written it; the layout must be that of the files."""
    table = _table(store, name)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = store.path(name).replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING {store.fmt} "
        f"CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{place}'"
    )
    return spark.table(table)
