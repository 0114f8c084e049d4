"""Nothing is lost or misjudged without notice."""

import pytest
from pyspark.sql import functions as F

from tasteloom.operators import tuning
from tasteloom.operators.similarity import dense_index
from tasteloom.schemas import RATING
from tasteloom.sources import tables


def test_lookup_with_another_bucket_count_fails(spark, tmp_path):
    store = tables.Store(str(tmp_path))
    rows = spark.createDataFrame([(u, 1, 4.0, 7) for u in range(5)], RATING)
    tables.write_by_key(rows, store, "ByUser", "uid", 16)
    keys = rows.select("uid")
    assert tables.read_by_key(spark, store, "ByUser", RATING, keys, "uid", 16).count() == 5
    with pytest.raises(ValueError, match="16 key buckets"):
        tables.read_by_key(spark, store, "ByUser", RATING, keys, "uid", 256)


def test_best_grid_point_has_an_error(spark):
    rows = [(1, 0.1, None), (2, 0.1, float("nan")), (3, 0.1, 0.9), (4, 0.1, 0.8)]
    report = spark.createDataFrame(rows, "rank int, reg double, rmse double")
    assert tuning.best(report).first()["rank"] == 4


def test_random_split_is_stable_and_complete(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("score"))
    train, test = tuning.random_split(rows)
    again, _ = tuning.random_split(rows.repartition(9))
    assert train.count() + test.count() == 5000 and train.intersect(test).count() == 0
    assert train.exceptAll(again).count() == 0
    assert 0.77 < train.count() / 5000 < 0.83


def test_dense_vectors_null_first_and_mixed_lengths(spark):
    schema = "mid int, vec array<float>"
    vectors = spark.createDataFrame([(1, None), (2, [1.0, 0.0]), (3, [1.0, 0.1])], schema)
    assert dense_index(vectors.coalesce(1), 0.5).top(5).count() == 2
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 0.0])], schema)
    with pytest.raises(ValueError, match="no cosine"):
        dense_index(mixed, 0.5)


def test_rows_of_a_cut_index_reach_all_items(spark, monkeypatch):
    from tasteloom.operators import similarity

    monkeypatch.setattr(similarity, "_parts", lambda n: F.ceil(n / 2).cast("int"))
    vectors = spark.createDataFrame(
        [(i, [1.0, 0.0]) for i in range(7)] + [(9, [1.0, 0.2])], "mid int, vec array<float>"
    )
    index = dense_index(vectors, 0.5)
    whole = index.neighbours().filter("mid < 9 and sim_cls = 9").count()
    cut = similarity.SimilarityIndex(index.members, index.links.filter("cls <> sim_cls"))
    assert whole == 7 == cut.neighbours().filter("mid < 9 and sim_cls = 9").count()
