"""Approximate similarity: recall against brute force, exact scores, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tasteloom.operators.approximate import approximate_index, hash_plan
from tests.helpers import plan_of

SCHEMA = "mid int, vec array<float>"


def clustered(n=1200, dim=24, seed=3):
    """Vectors around 60 centres, at all kinds of angles."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((60, dim))
    noise = rng.standard_normal((n, dim)) * rng.uniform(0.2, 1.0, (n, 1))
    return (centres[rng.integers(60, size=n)] + noise).astype(np.float32)


def brute_force(vectors, threshold):
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    scores = unit @ unit.T
    at = np.argwhere((scores > threshold) & ~np.eye(len(unit), dtype=bool))
    return {(int(a), int(b)): scores[a, b] for a, b in at}


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_recall_and_exact_scores(spark, threshold):
    vectors = clustered()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA)
    expected = brute_force(vectors, threshold)
    index = approximate_index(table, threshold)
    found = {(r["cls"], r["sim_cls"]): r["score"] for r in index.links.collect()}
    assert len(found) == index.links.count()
    assert found == pytest.approx({pair: expected[pair] for pair in found})
    assert {(b, a) for a, b in found} == set(found)
    assert len(found) >= 0.93 * len(expected)

    some = approximate_index(table, threshold, queries=F.col("mid") % 100 == 0)
    asked = {(r["mid"], r["sim_mid"]) for r in some.similar_to(some.members).collect()}
    assert asked == {pair for pair in found if pair[0] % 100 == 0}


def test_recall_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    exact = entry.vector_similar(spark, folder).filter("vec_id % 100 = 0")
    found = entry.vector_similar_approx(spark, folder)
    columns = ["vec_id", "sim_cls", "score", "n_similar"]
    everything = {tuple(r) for r in exact.select(columns).collect()}
    some = {tuple(r) for r in found.select(columns).collect()}
    assert some <= everything
    assert len(some) >= 0.9 * len(everything) > 0


def test_plan_of_hashes():
    assert hash_plan(0.95, 0.95, 10**9)[0] > hash_plan(0.6, 0.95, 10**9)[0] > 1
    assert hash_plan(0.6, 0.95, 2)[0] == 1
    for threshold in (-0.5, 0.0, 0.3, 0.6, 0.9, 1.0):
        bits, tables = hash_plan(threshold, 0.95, 10**6)
        agree = 1 - np.arccos(threshold) / np.pi
        assert 1 - (1 - agree**bits) ** tables >= 0.949


def test_copies_odd_vectors_and_empty_tables(spark):
    data = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, [0.0, 0.0]), (5, None), (6, []),
            (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [0.0, 1.0])]
    table = spark.createDataFrame(data, SCHEMA).withColumn("cls", F.lit(0))
    index = approximate_index(table.select("mid", "vec"), 0.9, recall=0.9999)
    pairs = {(r["mid"], r["sim_mid"]) for r in index.similar_to(index.members).collect()}
    assert pairs == {(1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2)}
    assert "CartesianProduct" not in plan_of(index.links)
    assert "BroadcastNestedLoopJoin" not in plan_of(index.links)
    none = approximate_index(table.select("mid", "vec").limit(0), 0.9)
    assert none.links.count() == none.members.count() == 0
