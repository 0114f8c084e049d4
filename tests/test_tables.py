import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.schemas import RATING, USER_RECS
from tasteloom.sources import tables
from tasteloom.sources.tables import Store
from tests.helpers import plan_of, rows


@pytest.fixture()
def store(tmp_path):
    return Store(str(tmp_path))


def ratings(spark, n=200):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("uid"),
        F.col("id").cast("int").alias("mid"),
        (F.col("id") % 5 + 0.5).cast("double").alias("score"),
        F.col("id").alias("timestamp"),
    )


def test_write_replaces_and_keeps_rows(spark, store):
    tables.write_table(ratings(spark, 50), store, "Rating")
    tables.write_table(ratings(spark), store, "Rating", ["uid", "mid"])
    back = tables.read_table(spark, store, "Rating", RATING, view="rating_view")
    columns = RATING.fieldNames()
    assert rows(back, *columns) == rows(ratings(spark), *columns)
    assert spark.sql("SELECT count(*) FROM rating_view").first()[0] == 200


def test_layout_splits_a_hot_key(spark):
    hot = spark.range(4000).select(F.lit(1).alias("uid"), F.col("id").alias("mid"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # tiny partitions would be merged again
    try:
        placed = tables.laid_out(hot, ["uid"]).select(F.spark_partition_id().alias("p"))
        parts = placed.groupBy("p").count().collect()
    finally:
        spark.conf.set(setting, "true")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3000


def test_key_filter_reaches_the_scan(spark, store):
    tables.write_table(ratings(spark), store, "Rating", ["uid", "mid"])
    back = tables.read_table(spark, store, "Rating", RATING).filter("uid = 7").select("mid")
    back.collect()
    plan = plan_of(back)
    assert "EqualTo(uid,7)" in plan and "ReadSchema: struct<uid:int,mid:int>" in plan


def test_keyed_write_keeps_one_row_per_key(spark, store):
    tables.write_keyed(ratings(spark), store, "Doc", "uid", [F.desc("timestamp")])
    back = tables.read_table(spark, store, "Doc", RATING)
    assert back.count() == back.select("uid").distinct().count()
    assert rows(back.filter("uid = 1"), "timestamp") == [(198,)]


def batch(spark, *data):
    return spark.createDataFrame(
        [(uid, [(mid, 1.0)]) for uid, mid in data],
        "uid int, recs array<struct<mid:int,score:double>>",
    )


def test_upsert_replay_latest_and_compaction(spark, store):
    tables.upsert_batch(batch(spark, (1, 10), (2, 20)), store, "StreamRecs", 0)
    tables.upsert_batch(batch(spark, (1, 11)), store, "StreamRecs", 1)
    tables.upsert_batch(batch(spark, (1, 12)), store, "StreamRecs", 1)
    tables.upsert_batch(batch(spark).limit(0), store, "StreamRecs", 2)

    def now(name, **kw):
        found = tables.latest(spark, store, name, USER_RECS, "uid", **kw)
        return rows(found.select("uid", F.col("recs")[0]["mid"].alias("mid")), "uid", "mid")

    assert now("StreamRecs") == [(1, 12), (2, 20)]
    assert now("StreamRecs", before=1) == [(1, 10), (2, 20)]
    tables.compact(spark, store, "StreamRecs", USER_RECS, "uid", "Compacted")
    assert now("Compacted") == [(1, 12), (2, 20)]
    tables.upsert_batch(batch(spark, (2, 21)), store, "Compacted", 3)
    assert now("Compacted") == [(1, 12), (2, 21)]


def test_settled(spark, store):
    df = ratings(spark)
    assert tables.settled(df, None, "X") is df
    kept = tables.settled(df, store, "X", ["mid"])
    assert kept.schema.fieldNames() == df.schema.fieldNames()
    assert rows(kept, "uid", "mid") == rows(df, "uid", "mid")


def test_other_formats_take_the_name_as_an_option(spark, tmp_path):
    lists = Store(fmt="json", options={}, location=str(tmp_path))
    tables.write_table(ratings(spark, 5), lists, "J")
    assert tables.read_table(spark, lists, "J", RATING).count() == 5
    by_option = Store(fmt="json", name_option="path")
    target = str(tmp_path / "named")
    tables.write_table(ratings(spark, 5), by_option, target)
    assert tables.read_table(spark, by_option, target, RATING).count() == 5


