"""Named tables behind any Spark data source.

The default store is a folder of Parquet tables. Another format (a document
database, a search index) is a matter of passing ``fmt`` and its options; its jar
has to be on the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.sources import versions


@dataclass(frozen=True)
class Store:
    """``location`` is the folder of a file format; ``options`` go to the data source.

    ``name_option`` is the option in which a non-file source takes the table name
    (``collection``, ``resource``, ...); left empty, the name is a sub-folder.

    A ``versioned`` store never writes over a table: each replacement is a new folder that
    readers see once it is complete, and running readers keep the one they began with
    (``sources.versions``). For file formats.
    """

    location: str = ""
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    name_option: str = ""
    versioned: bool = False

    def __post_init__(self) -> None:
        if self.versioned and self.name_option:
            raise ValueError("only tables in folders can be versioned")

    def path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}"


def _reader(spark: SparkSession, store: Store, name: str, schema: T.StructType | None):
    reader = spark.read.format(store.fmt).options(**store.options)
    if schema is not None:
        reader = reader.schema(schema)
    if store.name_option:
        return reader.option(store.name_option, name).load()
    path = store.path(name)
    return reader.load(versions.current(spark, path) if store.versioned else path)


def read_table(
    spark: SparkSession, store: Store, name: str, schema: T.StructType, view: str | None = None
) -> DataFrame:
    """Read ``name`` with the given schema; ``view`` also registers it for SQL."""
    table = _reader(spark, store, name, schema).select(*schema.fieldNames())
    if view:
        table.createOrReplaceTempView(view)
    return table


def _save(df: DataFrame, store: Store, name: str, **options: str) -> None:
    writer = df.write.format(store.fmt).mode("overwrite").options(**store.options, **options)
    if store.name_option:
        writer.option(store.name_option, name).save()
    else:
        with replaced(df.sparkSession, store, name) as path:
            writer.save(path)


@contextmanager
def replaced(spark: SparkSession, store: Store, name: str) -> Iterator[str]:
    """The folder to write a table's new content to; published when that is done."""
    path = store.path(name)
    if not store.versioned:
        yield path
        return
    folder = versions.fresh(path)
    yield folder
    versions.publish(spark, path, folder)


def laid_out(df: DataFrame, sort_keys: Sequence[str]) -> DataFrame:
    """Range-partition and sort so that a key filter skips files and row groups.

    A hash of the whole row closes the range key: one key value with a large share
    of the rows is then spread over several files instead of filling one.
    """
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(*sort_keys, spread).sortWithinPartitions(*sort_keys)


def write_table(
    df: DataFrame, store: Store, name: str, sort_keys: Sequence[str] | None = None
) -> None:
    """Replace the whole table."""
    _save(laid_out(df, sort_keys) if sort_keys else df, store, name)


def settled(
    df: DataFrame, store: Store | None, name: str, sort_keys: Sequence[str] | None = None
) -> DataFrame:
    """Write a result that several later steps read, and go on from the table.

    Cuts the lineage: the steps above run once, also when executors are lost later, and
    the size of the table is known to the optimizer. Without a store nothing happens.
    """
    if store is None:
        return df
    write_table(df, store, name, sort_keys)
    return read_table(df.sparkSession, store, name, df.schema)


def one_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence) -> DataFrame:
    """Keep the first row of every key; Spark cuts each key to one row before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_pos", F.row_number().over(newest)).filter("_pos = 1").drop("_pos")


def write_keyed(
    df: DataFrame,
    store: Store,
    name: str,
    key: str,
    order_by: Sequence,
    key_option: str = "",
) -> None:
    """Replace a keyed document table: one row per key.

    ``key_option`` is the source option that takes the document id (for instance
    ``es.mapping.id``).
    """
    extra = {key_option: key} if key_option else {}
    _save(one_per_key(df, key, order_by), store, name, **extra)


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_by_key(df: DataFrame, store: Store, name: str, key: str, buckets: int) -> None:
    """Replace a table made for looking keys up: one folder per hash bucket of the key.

    Rows are spread by bucket, key and row hash, so a bucket with a hot key is written by
    several tasks. The number of buckets is kept in a table beside it.
    """
    _save(df.sparkSession.range(1).select(F.lit(buckets).alias("buckets")), store, _layout(name))
    bucketed = df.withColumn("bucket", key_bucket(key, buckets))
    writer = (
        laid_out(bucketed, ["bucket", key])
        .write.format(store.fmt)
        .options(**store.options)
        .partitionBy("bucket")
        .mode("overwrite")
    )
    with replaced(df.sparkSession, store, name) as path:
        writer.save(path)


def _layout(name: str) -> str:
    return f"{name}Layout"


def buckets_for(df: DataFrame, bucket_rows: int, most: int) -> int:
    """So many buckets that one holds about ``bucket_rows`` rows: that is what a look-up reads."""
    return max(1, min(most, math.ceil(df.count() / bucket_rows)))


def _folders(spark: SparkSession, path: str) -> set[str]:
    """The names of the bucket folders; a bucket without rows has none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return {status.getPath().getName() for status in listed}


def read_by_key(
    spark: SparkSession,
    store: Store,
    name: str,
    schema: T.StructType,
    keys: DataFrame,
    key: str,
    buckets: int | None = None,
) -> DataFrame:
    """The rows of the given keys; only the folders of their buckets are listed and read.

    ``buckets``, if given, must be the number that the table was written with. The bucket
    numbers are all that the driver sees.
    """
    written = _reader(spark, store, _layout(name), None).first()["buckets"]
    if buckets is not None and written != buckets:
        raise ValueError(f"{name} has {written} key buckets, not {buckets}")
    touched = keys.select(key_bucket(key, written).alias("bucket")).distinct()
    path = store.path(name)
    path = versions.current(spark, path) if store.versioned else path
    wanted = {f"bucket={row['bucket']}" for row in touched.collect()} & _folders(spark, path)
    if not wanted:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType(), True)])
    reader = spark.read.format(store.fmt).options(**store.options).schema(stored)
    rows = reader.option("basePath", path).load([f"{path}/{folder}" for folder in sorted(wanted)])
    return rows.select(*schema.fieldNames()).join(keys.select(key), key, "left_semi")


def upsert_batch(df: DataFrame, store: Store, name: str, batch_id: int) -> None:
    """Write one micro-batch into its own partition of the table.

    Running a batch again replaces its partition, so a replay leaves one copy. The
    columns must hold one row per key. An empty batch writes nothing.
    """
    upsert_batches(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), store, name)


def upsert_batches(df: DataFrame, store: Store, name: str) -> None:
    """Rows with their ``batch_id``: the partitions of exactly those batches are replaced."""
    (
        df.write.format(store.fmt)
        .options(**store.options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .mode("overwrite")
        .save(store.path(name))
    )


def _batches(spark: SparkSession, store: Store, name: str, schema: T.StructType) -> DataFrame:
    """All micro-batches of an upsert table; those are never replaced as a whole."""
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType(), True)])
    return _reader(spark, replace(store, versioned=False), name, stored)


def _base(store: Store, name: str) -> str:
    return store.path(f"{name}Base")


def latest(
    spark: SparkSession,
    store: Store,
    name: str,
    schema: T.StructType,
    key: str,
    before: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The newest row of every key over all batches, or over those ``before`` one.

    After ``merge_batches`` only the merged base and the batches since then are read. With
    ``keys`` only those keys are looked for, and of the base only their buckets.
    """
    table = _batches(spark, store, name, schema)
    if before is not None:
        table = table.filter(F.col("batch_id") < before)
    found = versions.newest(spark, _base(store, name))
    if found is not None and (before is None or found[2] < before):
        folder, _, through = found
        table = table.filter(F.col("batch_id") > through)
        base = _merged_rows(spark, store, folder, schema, key, keys)
        table = table.unionByName(base.withColumn("batch_id", F.lit(through).cast("bigint")))
    if keys is not None:
        table = table.join(keys.select(key).distinct(), key, "left_semi")
    return latest_of(table, key).select(*schema.fieldNames())


def _merged_rows(
    spark: SparkSession, store: Store, folder: str, schema: T.StructType, key: str, keys: DataFrame | None
) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType(), True)])
    rows = spark.read.format(store.fmt).options(**store.options).schema(stored).load(folder)
    if keys is not None:
        buckets = _reader(spark, Store(fmt=store.fmt, location=folder), "_layout", None).first()["buckets"]
        touched = keys.select(key_bucket(key, buckets).alias("bucket")).distinct()
        rows = rows.filter(F.col("bucket").isin([row["bucket"] for row in touched.collect()]))
    return rows.select(*schema.fieldNames())


def merge_batches(
    spark: SparkSession,
    store: Store,
    name: str,
    schema: T.StructType,
    key: str,
    before: int | None = None,
    buckets: int = 64,
) -> int | None:
    """Merge the batches of an upsert table into one base, a folder per hash bucket of the key.

    Only the base of the last merge and the batches since then are read. Nothing is
    deleted or written over: the new base is published when it is complete, so a reader or
    a stream that runs meanwhile, or a merge that stops half-way, sees the old one.
    ``before`` leaves out a batch that is still being written. Returns the last batch in
    the base, None if there is nothing to merge.
    """
    table = _batches(spark, store, name, schema)
    if before is not None:
        table = table.filter(F.col("batch_id") < before)
    found = versions.newest(spark, _base(store, name))
    if found is not None:
        table = table.filter(F.col("batch_id") > found[2])
    through = table.agg(F.max("batch_id")).first()[0]
    if through is None:
        return None if found is None else found[2]
    rows = latest(spark, store, name, schema, key, before=through + 1)
    folder = versions.fresh(_base(store, name))
    writer = laid_out(rows.withColumn("bucket", key_bucket(key, buckets)), ["bucket", key]).write
    writer.format(store.fmt).options(**store.options).partitionBy("bucket").save(folder)
    layout = spark.range(1).select(F.lit(buckets).alias("buckets"))
    layout.write.format(store.fmt).save(f"{folder}/_layout")
    versions.publish(spark, _base(store, name), folder, through)
    return through


def latest_of(batches: DataFrame, key: str) -> DataFrame:
    return one_per_key(batches, key, [F.desc("batch_id")])


def compact(
    spark: SparkSession, store: Store, name: str, schema: T.StructType, key: str, target: str
) -> None:
    """Write the newest rows as one batch into ``target``, keeping their batch order.

    The result is again an upsert table (a single partition, the highest batch seen),
    so a stream that is pointed at it continues with larger batch ids.
    """
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType(), True)])
    table = _reader(spark, store, name, stored)
    newest = table.agg(F.max("batch_id")).scalar()
    (
        latest_of(table, key)
        .withColumn("batch_id", newest)
        .write.format(store.fmt)
        .options(**store.options)
        .partitionBy("batch_id")
        .mode("overwrite")
        .save(store.path(target))
    )
