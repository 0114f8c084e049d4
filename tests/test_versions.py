"""Tables replaced under readers, and upsert tables merged in place."""

import pytest
from pyspark.sql import functions as F

from tasteloom.schemas import RATING
from tasteloom.sources import tables, versions
from tasteloom.sources.tables import Store
from tests.helpers import rows


def ratings(spark, n, score):
    return spark.range(n).select(
        F.col("id").cast("int").alias("uid"),
        (F.col("id") % 3).cast("int").alias("mid"),
        F.lit(score).cast("double").alias("score"),
        F.col("id").alias("timestamp"),
    )


def test_readers_keep_what_they_began_with(spark, tmp_path):
    store = Store(str(tmp_path), versioned=True)
    with pytest.raises(ValueError, match="nothing has been published"):
        tables.read_table(spark, store, "R", RATING)
    tables.write_table(ratings(spark, 10, 1), store, "R")
    first = tables.read_table(spark, store, "R", RATING)
    tables.write_table(ratings(spark, 20, 2), store, "R", ["uid"])
    second = tables.read_table(spark, store, "R", RATING)
    # A replacement out of the table itself: its own source isn't touched.
    tables.write_table(second.filter("uid < 5"), store, "R")
    assert first.agg(F.count("*"), F.sum("score")).first() == (10, 10)
    assert second.agg(F.count("*"), F.sum("score")).first() == (20, 40)
    assert tables.read_table(spark, store, "R", RATING).count() == 5
    assert rows(versions.history(spark, store.path("R")), "version") == [(1,), (2,), (3,)]


def test_a_failed_replacement_is_never_seen(spark, tmp_path):
    store = Store(str(tmp_path), versioned=True)
    tables.write_table(ratings(spark, 10, 1), store, "R")
    broken = ratings(spark, 10, 2).withColumn("score", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(broken, store, "R")
    assert tables.read_table(spark, store, "R", RATING).agg(F.sum("score")).first()[0] == 10


def test_old_contents_are_dropped_but_the_newest(spark, tmp_path):
    store = Store(str(tmp_path), versioned=True)
    for score in range(4):
        tables.write_table(ratings(spark, 3, score), store, "R")
    gone = versions.drop_old(spark, store.path("R"), keep=2)
    assert len(gone) == 2
    assert tables.read_table(spark, store, "R", RATING).agg(F.max("score")).first()[0] == 3
    with pytest.raises(ValueError):
        versions.drop_old(spark, store.path("R"), keep=0)


def test_two_writers_at_once_leave_one_newest(spark, tmp_path):
    path = str(tmp_path / "R")
    for folder in ("b", "a"):
        row = spark.createDataFrame([(folder, 1, None)], versions.LOG)
        row.write.mode("append").parquet(f"{path}Versions")
    assert versions.current(spark, path) == "b"
    assert versions.publish(spark, path, "c", through=7) == 2
    assert versions.newest(spark, path) == ("c", 2, 7)


def test_only_folders_are_versioned():
    with pytest.raises(ValueError):
        Store(name_option="collection", versioned=True)


def test_keyed_table_in_a_versioned_store(spark, tmp_path):
    store = Store(str(tmp_path), versioned=True)
    tables.write_by_key(ratings(spark, 100, 1), store, "K", "uid", 8)
    keys = spark.createDataFrame([(3,), (500,)], "uid int")
    found = tables.read_by_key(spark, store, "K", RATING, keys, "uid")
    tables.write_by_key(ratings(spark, 2, 1), store, "K", "uid", 8)
    assert rows(found, "uid") == [(3,)]
    assert tables.read_by_key(spark, store, "K", RATING, keys, "uid").count() == 0


def batch(spark, *pairs):
    return spark.createDataFrame([(u, m, 1.0, 5) for u, m in pairs], RATING)


def test_merging_batches_keeps_the_latest_view(spark, tmp_path):
    store = Store(str(tmp_path))

    def now(**kw):
        return rows(tables.latest(spark, store, "T", RATING, "uid", **kw), "uid", "mid")

    def merge(**kw):
        return tables.merge_batches(spark, store, "T", RATING, "uid", buckets=4, **kw)

    tables.upsert_batch(batch(spark, (1, 10), (2, 20)), store, "T", 0)
    tables.upsert_batch(batch(spark, (1, 11), (3, 30)), store, "T", 1)
    tables.upsert_batch(batch(spark, (3, 31)), store, "T", 2)
    expected = [(1, 11), (2, 20), (3, 31)]
    assert now() == expected
    assert merge(before=2) == 1
    assert now() == expected and now(before=2) == [(1, 11), (2, 20), (3, 30)]
    assert now(before=1) == [(1, 10), (2, 20)]  # before the base: from the batches
    assert merge() == 2 and merge() == 2
    assert now() == expected
    # A batch after the merge, and one that runs again.
    tables.upsert_batch(batch(spark, (2, 22)), store, "T", 3)
    tables.upsert_batch(batch(spark, (2, 22)), store, "T", 3)
    assert now() == [(1, 11), (2, 22), (3, 31)]
    assert now(keys=spark.createDataFrame([(2,), (9,)], "uid int")) == [(2, 22)]
    assert tables.merge_batches(spark, store, "T", RATING, "uid") == 3
    assert now() == [(1, 11), (2, 22), (3, 31)]


def test_latest_reads_the_base_and_later_batches_only(spark, tmp_path):
    store = Store(str(tmp_path))
    for i in range(6):
        tables.upsert_batch(batch(spark, *[(u, i) for u in range(40)]), store, "T", i)
    tables.merge_batches(spark, store, "T", RATING, "uid", before=5, buckets=16)
    found = tables.latest(
        spark, store, "T", RATING, "uid", keys=spark.createDataFrame([(7,)], "uid int")
    )
    assert rows(found, "uid", "mid") == [(7, 5)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "batch_id#" in plan and "> 4)" in plan  # the partition filter
    files = [f for f in found.inputFiles() if "TBase" in f]
    assert {f.split("bucket=")[1].split("/")[0] for f in files} <= {str(b) for b in range(16)}
