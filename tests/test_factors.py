import random

import pytest
from pyspark.sql import functions as F

from tasteloom.operators import factors, tuning
from tests.helpers import plan_of, rows


@pytest.fixture(scope="module")
def ratings(spark):
    """A planted low-rank matrix, with one user and one item that have many ratings."""
    rng = random.Random(5)
    users = {u: (rng.random() * 2, rng.random() * 2) for u in range(60)}
    items = {m: (rng.random() * 2, rng.random() * 2) for m in range(40)}
    data = [
        (u, m, users[u][0] * items[m][0] + users[u][1] * items[m][1], 1000 + m)
        for u in users
        for m in items
        if u == 0 or m == 0 or rng.random() < 0.5
    ]
    return spark.createDataFrame(
        data, "uid int, mid int, score double, timestamp bigint"
    ).cache()


@pytest.fixture(scope="module")
def model(ratings):
    return factors.train(ratings, rank=4, max_iter=8, reg=0.02)


def test_user_lists(model, ratings):
    recs = factors.user_recs(model, 20)
    got = [tuple(r) for r in recs.collect()]
    assert {r[0] for r in got} == set(range(60))
    by_user = {}
    for uid, rank, mid, score in sorted(got):
        by_user.setdefault(uid, []).append(score)
        assert rank == len(by_user[uid]) <= 20 and score > 0 and 0 <= mid < 40
    assert all(s == sorted(s, reverse=True) for s in by_user.values())
    assert dict(recs.dtypes)["score"] == "double"
    # The lists equal the best of all predictions.
    grid = factors.distinct_users(ratings).crossJoin(factors.distinct_items(ratings))
    every = {}
    for r in factors.predict(model, grid).filter("prediction > 0").collect():
        every.setdefault(r["uid"], []).append(r["prediction"])
    for uid, scores in by_user.items():
        assert scores == pytest.approx(sorted(every[uid], reverse=True)[:20], abs=1e-5)


def test_item_similarity(model, spark):
    index = factors.item_recs(model, 0.6)
    vectors = {r["mid"]: r["vec"] for r in factors.item_vectors(model).collect()}
    norm = {m: sum(x * x for x in v) ** 0.5 for m, v in vectors.items()}
    expected = 0
    for a, left in vectors.items():
        for b, right in vectors.items():
            cosine = sum(x * y for x, y in zip(left, right)) / (norm[a] * norm[b])
            expected += a != b and cosine > 0.6
    assert index.links.count() == expected
    assert "Cartesian" not in plan_of(index.links)
    assert {r["rank"] for r in index.top(3).collect()} <= {1, 2, 3}


def test_unknown_pairs_drop_out(model, spark):
    pairs = spark.createDataFrame([(0, 0), (0, 999)], "uid int, mid int")
    assert factors.predict(model, pairs).count() == 1


def test_distinct_and_grid(ratings):
    assert factors.distinct_users(ratings).count() == 60
    assert tuple(factors.candidate_grid_count(ratings).first()) == (60, 40, 2400)


def test_splits(ratings):
    for split in (tuning.random_split, tuning.hash_split):
        train, test = split(ratings)
        assert train.count() + test.count() == ratings.count()
        assert 0.7 < train.count() / ratings.count() < 0.9
        again, _ = split(ratings)
        assert rows(again, "uid", "mid") == rows(train, "uid", "mid")
    train, test = tuning.hash_split(ratings.union(ratings))
    assert train.select("uid", "mid").intersect(test.select("uid", "mid")).count() == 0


def test_rmse(spark):
    rows_ = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "score double, prediction double")
    assert tuning.rmse(rows_).first()["rmse"] == pytest.approx(2.5**0.5)
    observed = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (2, 2, 1.0)], "uid int, mid int, score double")
    predicted = spark.createDataFrame([(1, 1, 4.0)], "uid int, mid int, prediction double")
    assert tuning.with_predictions(observed, predicted).count() == 2


def test_grid_beats_the_global_mean(ratings):
    report = tuning.grid(ratings, ranks=(2, 3), regs=(0.02, 1.0), max_iter=6, parallelism=2)
    got = report.collect()
    assert len(got) == 4 and sum(r["is_best"] for r in got) == 1
    best = min(got, key=lambda r: r["rmse"])
    assert best["is_best"] and tuning.best(report).first()["rmse"] == best["rmse"]
    spread = ratings.agg(F.stddev_pop("score")).first()[0]
    assert best["rmse"] < spread / 2
