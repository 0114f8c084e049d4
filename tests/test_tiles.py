"""Products in single precision decide nothing; tiles are bounded; pairs meet once."""

import math

import numpy as np
import pyarrow as pa

from tasteloom.operators import approximate, similarity as S
from tests.helpers import plan_of


def test_a_tile_is_bounded_by_rows_too():
    # 65,536 vectors of 64 numbers are 16 MB, but four billion scores in one task.
    assert S.block_count(600_000, 64, 24) >= math.ceil(600_000 / S.BLOCK_ROWS) > 10


def test_near_ties_at_the_edge_of_single_precision():
    """Scores that differ by less than single precision tells are decided in double."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((1, 48))
    vectors = (base + 1e-4 * rng.standard_normal((700, 48))).astype(np.float32)
    norms = np.linalg.norm(vectors.astype(float), axis=1)
    unit = vectors.astype(float) / norms[:, None]
    scores = unit @ unit.T
    threshold = float(np.median(scores))
    ids = np.arange(700)
    rows = pa.table({"cls": ids, "n": np.ones(700, np.int64), "vec": list(vectors), "norm": norms, "block": np.zeros(700, np.int32)})
    for keep in (None, 5):
        batches = S._tile_multiplier(threshold, None, keep)((pa.scalar(0), pa.scalar(0)), iter(rows.to_batches()))
        found = {}
        for batch in batches:
            for a, b, score, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(a, []).append((b, score))
        for a in ids.tolist():
            every = sorted(((b, scores[a, b]) for b in ids.tolist() if b != a and scores[a, b] > threshold + 1e-13), key=lambda e: -e[1])
            got = {b for b, _ in found.get(a, [])}
            assert {b for b, _ in every[:keep]} <= got
            if keep is not None:
                assert len(got) <= keep + 1


def test_pairs_that_meet_are_never_shuffled(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)).astype(np.float32))]
    table = spark.createDataFrame(rows, "mid int, vec array<float>")
    found = approximate.approximate_index(table, 0.3).links
    pairs = [(r["cls"], r["sim_cls"]) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) > 0
    # The links come straight out of the products: no step after them deals rows again.
    above = plan_of(found).split("MapInArrow")[0]
    assert "Exchange" not in above and "Aggregate" not in above


def test_large_buckets_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 8)).astype(np.float32))]
    table = spark.createDataFrame(rows, "mid int, vec array<float>")
    whole = {tuple(r) for r in approximate.approximate_index(table, 0.5, 6).links.collect()}
    monkeypatch.setattr(approximate, "PART_ROWS", 7)
    assert {tuple(r) for r in approximate.approximate_index(table, 0.5, 6).links.collect()} == whole
