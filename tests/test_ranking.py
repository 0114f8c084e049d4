import random

from pyspark.sql import functions as F

from tasteloom.operators import ranking as R
from tests.helpers import plan_of, rows


def test_newest_per_user_and_ties(spark):
    data = [(1, 9, 3.0, 5), (1, 7, 1.0, 8), (1, 4, 2.0, 8), (1, 4, 5.0, 8), (2, 1, 1.0, 1)]
    events = spark.createDataFrame(data, "uid int, mid int, score double, timestamp bigint")
    newest = R.newest_per_user(events)
    assert rows(newest, "uid", "mid", "score", "timestamp") == [(1, 4, 5.0, 8), (2, 1, 1.0, 1)]


def test_recent_lists(spark):
    rng = random.Random(1)
    data = [
        (rng.randint(1, 5), rng.randint(1, 60), rng.randint(1, 10) / 2, rng.randint(1, 30))
        for _ in range(400)
    ]
    ratings = spark.createDataFrame(data, "uid int, mid int, score double, timestamp bigint")
    expected = []
    for uid in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == uid), key=lambda d: (-d[3], d[1], -d[2]))
        expected += [(uid, i, d[1], d[2]) for i, d in enumerate(mine[:20])]
    recent = R.recent(ratings)
    assert rows(recent, "uid", "pos", "mid", "score") == sorted(expected)
    assert "WindowGroupLimit" in plan_of(recent)


def test_positions_number_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_WIDTH", 10)
    rng = random.Random(2)
    mids = rng.sample(range(-200, 1000), 300)
    data = [(m, 1 if i % 3 else 2) for i, m in enumerate(mids)]
    got = R.positions(spark.createDataFrame(data, "mid int, cls int"))
    expected = []
    for cls in (1, 2):
        mine = sorted(m for m, c in data if c == cls)
        expected += [(cls, m, i + 1) for i, m in enumerate(mine)]
    assert rows(got, "cls", "mid", "pos") == sorted(expected)


def test_recs_round_trip(spark):
    pairs = spark.createDataFrame(
        [(1, 5, 0.5), (1, 4, 0.9), (1, 6, 0.5), (2, 1, 0.1)], "mid int, sim_mid int, score double"
    )
    ranked = R.top_per_key(pairs, "mid", 2, item="sim_mid")
    nested = R.as_recs(ranked, "mid", item="sim_mid")
    found = {r["mid"]: [tuple(e) for e in r["recs"]] for r in nested.collect()}
    assert found == {1: [(4, 0.9), (5, 0.5)], 2: [(1, 0.1)]}
    flat = R.from_recs(nested)
    assert rows(flat, "mid", "sim_mid", "score") == [(1, 4, 0.9), (1, 5, 0.5), (2, 1, 0.1)]


def test_full_order_without_a_cap(spark):
    pairs = spark.range(100).select(
        F.lit(1).alias("mid"), F.col("id").alias("sim_mid"), (F.col("id") % 7).alias("score")
    )
    full = R.top_per_key(pairs, "mid", None, item="sim_mid")
    first = R.top_per_key(pairs, "mid", 20, item="sim_mid")
    assert full.count() == 100
    assert rows(full.filter("rank <= 20"), "rank", "sim_mid") == rows(first, "rank", "sim_mid")
