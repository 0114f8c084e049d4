from pyspark.sql import functions as F

from tasteloom.schemas import RATING
from tasteloom.sources.colocated import read_colocated, write_colocated
from tasteloom.sources.tables import Store
from tests.helpers import plan_of, rows


def tables(spark, n=300):
    ratings = spark.range(n).select(
        F.col("id").cast("int").alias("uid"),
        (F.col("id") % 40).cast("int").alias("mid"),
        (F.col("id") % 9 / 2).alias("score"),
        F.col("id").alias("timestamp"),
    )
    items = spark.range(45).select(F.col("id").cast("int").alias("mid"), F.lit("x").alias("name"))
    return ratings, items


def test_join_and_sum_without_a_shuffle(spark, tmp_path):
    store = Store(str(tmp_path))
    ratings, items = tables(spark)
    left = write_colocated(ratings, store, "r", "mid", 5)
    right = write_colocated(items, store, "i", "mid", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = right.join(left, "mid", "left").groupBy("mid", "name").agg(F.sum("score").alias("s"))
        plan = plan_of(sums)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = items.join(ratings, "mid", "left").groupBy("mid", "name").agg(F.sum("score").alias("s"))
        assert "Exchange" in plan_of(plain)
        assert rows(sums, "mid", "name") == rows(plain, "mid", "name")
        assert rows(sums.filter("s is not null"), "mid", "s") == rows(plain.filter("s is not null"), "mid", "s")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_files_are_taken_up_by_another_session(spark, tmp_path):
    store = Store(str(tmp_path))
    ratings, _ = tables(spark)
    write_colocated(ratings, store, "later", "mid", 5)
    other = spark.newSession()
    for row in other.catalog.listTables():
        if row.name.startswith("later_"):
            other.sql(f"DROP TABLE {row.name}")  # external: the files stay
    again = read_colocated(other, store, "later", RATING, "mid", 5)
    assert again.count() == 300
    assert "Exchange" not in plan_of(again.groupBy("mid").count())


def test_written_again(spark, tmp_path):
    store = Store(str(tmp_path))
    ratings, _ = tables(spark)
    write_colocated(ratings, store, "again", "mid", 5)
    assert write_colocated(tables(spark, 20)[0], store, "again", "mid", 3).count() == 20
