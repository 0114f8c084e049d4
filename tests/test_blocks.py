"""Vectors in files: what tasks read of them, and what training, lists and links no longer shuffle."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import factors, solving, tuning
from tasteloom.operators import similarity as S
from tasteloom.sources import blocks
from tasteloom.sources.tables import Store
from tests.helpers import plan_of


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(3)
    rows = [(u, m, float(rng.integers(1, 11)) / 2) for u in range(60) for m in range(50) if rng.random() < 0.3]
    return spark.createDataFrame(rows, "uid int, mid int, score double").persist()


@pytest.fixture(scope="module")
def model(ratings):
    return factors.train(ratings, rank=5, max_iter=2, reg=0.1, seed=2, blocks=2)


def test_chosen_vectors_are_read_alone_or_in_runs(tmp_path, monkeypatch):
    ids = np.arange(0, 3000, 3)
    vectors = np.random.default_rng(1).standard_normal((len(ids), 4)).astype(np.float32)
    paths = [blocks.write_vectors(f"file://{tmp_path}", str(i), ids[i::2], vectors[i::2]) for i in range(2)]
    files = blocks.VectorFiles((*paths, ""), len(ids), 4)
    for gap in (0, 64, 1 << 20):
        monkeypatch.setattr(blocks, "GAP_BYTES", gap)
        for rows in ([0], [5, 6, 7, 400, 999], range(1000)):
            assert (files.chosen(ids[list(rows)]) == vectors[list(rows)]).all()
    with pytest.raises(ValueError):
        files.chosen(np.array([1]))


def test_a_training_keeps_its_last_factors_only(ratings, tmp_path, monkeypatch):
    monkeypatch.setattr(factors, "work_store", lambda ratings: Store(f"file://{tmp_path}/work"))
    got = factors.train(ratings, rank=3, max_iter=3, seed=2, blocks=2)
    assert sorted(os.listdir(tmp_path / "work")) == ["FactorsItems2", "FactorsUsers2"]
    assert got.userFactors.count() == ratings.select("uid").distinct().count()


def test_the_grid_leaves_nothing_behind(ratings, tmp_path, monkeypatch):
    monkeypatch.setattr(tuning, "work_store", lambda ratings: Store(f"file://{tmp_path}/work"))
    report = tuning.grid(ratings, ranks=(2,), regs=(0.1, 1.0), max_iter=2)
    assert report.count() == 2 and not os.path.exists(tmp_path / "work")


def test_predictions_move_no_factors(model, ratings):
    found = factors.predict(model, ratings.select("uid", "mid", "score"))
    assert "Join" not in plan_of(found) and "features" not in plan_of(found)
    users, items = ({r["id"]: np.array(r["features"], float) for r in t.collect()} for t in (model.userFactors, model.itemFactors))
    for r in found.collect():
        assert r["prediction"] == pytest.approx(users[r["uid"]] @ items[r["mid"]], abs=1e-5)
    assert found.count() == ratings.count()


@pytest.mark.parametrize("struck", [False, True])
def test_only_the_best_of_all_items_leave_a_task(model, ratings, struck):
    found = factors._best(model, ratings if struck else None, 3, 7)
    assert len(model.items.paths) > 1 and "features" not in plan_of(found)
    assert found.groupBy("uid").count().agg(F.max("count")).first()[0] <= 3


def _vectors(spark, n=90):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(5)]
    return spark.createDataFrame(rows, "mid int, vec array<float>")


def test_products_pass_on_the_best_of_all_blocks(spark):
    index = S.dense_index(_vectors(spark), -0.9, keep=4, blocks=5)
    own = index.links.filter("cls <> sim_cls").groupBy("cls").count()
    assert own.agg(F.max("count")).first()[0] == 4  # no ties among random vectors
    whole = S.dense_index(_vectors(spark), -0.9, blocks=5)
    assert sorted(map(tuple, index.top(3).collect())) == sorted(map(tuple, whole.top(3).collect()))


@pytest.mark.parametrize("links", [3, 1 << 22])
def test_lists_are_ranked_where_they_are_made(spark, monkeypatch, links):
    df = _vectors(spark)
    monkeypatch.setattr(S, "LIST_LINKS", links)
    left = S._units(
        df.limit(90).select("mid", "vec").toArrow().set_column(0, "cls", [list(range(90))]).append_column("n", [[1] * 90]).append_column(
            "norm", [[float(np.linalg.norm(v)) for v in df.limit(90).toPandas().vec]]
        )
    )
    rows = [r for b in S._lists_of_rows(left, lambda: iter([left]), 0.2, None) for r in b.to_pylist()]
    product = left[2] @ left[2].T
    for a in range(90):
        expected = sorted(((-product[a, b], b) for b in range(90) if b != a and product[a, b] > 0.2))
        got = [(r["rank"], r["sim_cls"]) for r in rows if r["cls"] == a]
        assert got == [(i + 1, b) for i, (_, b) in enumerate(expected)]


def test_lists_of_single_items_are_not_shuffled(spark, tmp_path):
    index = S.dense_index(_vectors(spark), 0.2, 6, blocks=4, store=Store(f"file://{tmp_path}"))
    again = S.SimilarityIndex(index.members, index.links).neighbours()
    assert sorted(map(tuple, index.neighbours().collect())) == sorted(map(tuple, again.collect()))
    assert "Window" in plan_of(again) and "Window" not in plan_of(index.neighbours())


def test_factor_files_hold_every_row(model):
    files = solving.in_files(model.itemFactors)
    assert files.rows == model.itemFactors.count() and files.dim == 5
