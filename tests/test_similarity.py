import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.operators import content, ranking
from tasteloom.operators import similarity as S
from tasteloom.sources import warehouse
from tasteloom.sources.tables import Store
from tests.helpers import cosine_pairs, plan_of, rows, tfidf_pairs, top_lists

WORDS = "action war drama comedy crime noir western music family tv space heist sport".split()


def catalogue(n, seed, copies=0.35):
    """Random genre texts of which a third are copies of one another."""
    rng = random.Random(seed)
    texts = {}
    for mid in range(n):
        if rng.random() < copies:
            texts[mid] = "Drama|Noir|space"
        else:
            # Low word numbers are much more common than high ones.
            picks = [WORDS[int(len(WORDS) * rng.random() ** 2)] for _ in range(rng.randint(1, 5))]
            texts[mid] = "|".join(picks)
    return texts


def frame(spark, texts):
    return spark.createDataFrame(
        [(m, f"n{m}", t) for m, t in texts.items()], "mid int, name string, genres string"
    )


def check_index(spark, index, pairs, k=5):
    """All views of an index against the brute-force pairs."""
    everything = index.similar_to(index.members)
    assert {(r[0], r[1]): r[2] for r in everything.collect()} == pytest.approx(pairs)

    full = sorted(map(tuple, index.ordered_lists(index.members).collect()))
    by_item = {}
    for mid, rank, sim, score in full:
        by_item.setdefault(mid, []).append((sim, score))
        assert rank == len(by_item[mid])
    assert {m: [e[0] for e in found] for m, found in by_item.items()} == {
        m: [e[0] for e in found] for m, found in top_lists(pairs, 10**9).items()
    }

    counts = {}
    for a, _ in pairs:
        counts[a] = counts.get(a, 0) + 1
    assert {r[0]: r[1] for r in index.counts().collect() if r[1]} == counts

    lists = top_lists(pairs, k)
    got = {}
    for mid, rank, sim, score in sorted(map(tuple, index.top(k).collect())):
        got.setdefault(mid, []).append((sim, score))
        assert len(got[mid]) == rank
    assert got == {
        mid: [(sim, pytest.approx(score)) for sim, score in found] for mid, found in lists.items()
    }

    neighbours = index.neighbours()
    assert (neighbours.agg(F.sum("n_similar")).first()[0] or 0) == len(pairs)

    sample = [(a, b) for a in range(0, 30) for b in range(0, 30)]
    asked = spark.createDataFrame(sample, "a int, b int")
    found = {(r["a"], r["b"]): r["score"] for r in index.lookup(asked, "a", "b").collect()}
    assert found == pytest.approx({p: pairs[p] for p in sample if p in pairs})


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.6, 0.95, 1.0])
@pytest.mark.parametrize("seed", [1])
def test_sparse_index_equals_brute_force(spark, tmp_path, threshold, seed):
    texts = catalogue(120, seed)
    index = content.similar(
        frame(spark, texts), threshold, digits=6, store=Store(str(tmp_path))
    )
    check_index(spark, index, tfidf_pairs(texts, threshold))


def test_sparse_index_without_a_store(spark):
    texts = catalogue(60, 3)
    index = content.similar(frame(spark, texts), digits=6)
    check_index(spark, index, tfidf_pairs(texts, 0.6))


def test_full_lists_over_id_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranking, "CHUNK_WIDTH", 16)
    monkeypatch.setattr(S, "PART_ITEMS", 7)
    texts = catalogue(100, 4, copies=0.6)
    index = content.similar(frame(spark, texts), digits=6, store=Store(str(tmp_path)))
    check_index(spark, index, tfidf_pairs(texts, 0.6))


def test_links_are_symmetric(spark, tmp_path):
    index = content.similar(frame(spark, catalogue(120, 5)), digits=6, store=Store(str(tmp_path)))
    links = {(r["cls"], r["sim_cls"]): r["score"] for r in index.links.collect()}
    assert links and all(links[b, a] == s for (a, b), s in links.items())


def test_copies_make_one_class_and_no_pairs(spark):
    texts = {m: "a|b" for m in range(500)} | {500: "c"}
    index = content.similar(frame(spark, texts))
    assert index.links.count() == 1
    assert rows(index.counts().agg(F.sum("n_similar").alias("n")), "n") == [(500 * 499,)]


def test_term_in_every_document_makes_no_pairs(spark):
    index = content.similar(frame(spark, {1: "all", 2: "all", 3: "all|x"}))
    assert index.links.count() == 0


def test_items_without_genres_are_left_out(spark):
    items = spark.createDataFrame(
        [(1, "n", None), (2, "n", "a"), (3, "n", "a"), (4, "n", "")],
        "mid int, name string, genres string",
    )
    index = content.similar(items)
    assert rows(index.counts(), "mid", "n_similar") == [(2, 1), (3, 1)]


def test_negative_threshold(spark):
    with pytest.raises(ValueError):
        content.similar(frame(spark, {1: "a"}), -0.1)


def test_hashed_weights_equal_ml_features(spark):
    items = frame(spark, catalogue(80, 6))
    docs = content.documents(items, content.HASHED)
    own = (
        docs.select("mid", F.inline("terms"))
        .join(S.inverse_frequencies(S.document_classes(docs)), "term")
        .select("mid", "term", (F.col("tf") * F.col("idf")).alias("w"))
    )
    ml = {r["mid"]: r["features"] for r in content.tfidf(items, content.HASHED).collect()}
    assert own.count() > 80
    for mid, term, w in own.collect():
        assert ml[mid].size == 50 and ml[mid][term] == pytest.approx(w)


def test_hashed_index_equals_brute_force(spark, tmp_path):
    items = frame(spark, catalogue(80, 7))
    features = content.tfidf(items, content.HASHED).collect()
    weights = {
        r["mid"]: dict(zip(r["features"].indices.tolist(), r["features"].values.tolist()))
        for r in features
    }
    index = content.similar(
        items, variant=content.HASHED, digits=6, store=Store(str(tmp_path))
    )
    check_index(spark, index, cosine_pairs(weights, 0.6))


def test_warehouse_regression_value(spark, tmp_path):
    items = warehouse.items(spark, "/root/testdata/sf0.01")
    index = content.similar(items, digits=6, store=Store(str(tmp_path)))
    pairs, total = index.neighbours().agg(
        F.sum("n_similar"), F.sum(F.col("n_similar") * F.col("score"))
    ).first()
    assert pairs == 2 * 96_099
    assert total / 2 == pytest.approx(67_357.708, abs=1e-3)
    full = index.similar_to(items)
    assert full.count() == pairs


def test_plans_have_no_cross_join(spark, tmp_path):
    items = frame(spark, catalogue(50, 8))
    index = content.similar(items)
    for df in (index.links, index.members, index.neighbours(), index.top(5), index.counts()):
        plan = plan_of(df)
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


# --- dense ---


def dense(n, dim, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim)).astype(np.float32)
    vectors[: n // 3] = vectors[0]  # a third are copies
    vectors[n - 1] = 0
    vectors[n // 2] = 2 * vectors[n // 2 + 1]
    return {i: v.tolist() for i, v in enumerate(vectors)}


@pytest.mark.parametrize("blocks", [1, 2, 5, None])
def test_dense_index_equals_brute_force(spark, tmp_path, blocks):
    vectors = dense(90, 6, 1)
    df = spark.createDataFrame(list(vectors.items()), "mid int, vec array<float>")
    index = S.dense_index(df, 0.6, 6, blocks=blocks, store=Store(str(tmp_path)))
    weights = {m: dict(enumerate(v)) for m, v in vectors.items()}
    check_index(spark, index, cosine_pairs(weights, 0.6))
    assert "Cartesian" not in plan_of(S.dense_index(df, 0.6, blocks=2).links)


def test_dense_keep_gives_the_same_top_lists(spark):
    vectors = dense(150, 4, 2)
    df = spark.createDataFrame(list(vectors.items()), "mid int, vec array<float>")
    full = S.dense_index(df, 0.2, 6, blocks=3)
    kept = S.dense_index(df, 0.2, 6, blocks=3, keep=5)
    columns = ("mid", "rank", "sim_mid", "score")
    assert rows(full.top(4), *columns) == rows(kept.top(4), *columns)
    assert kept.links.count() < full.links.count()


def test_dense_without_usable_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "mid int, vec array<float>")
    assert S.dense_index(df, 0.6).links.count() == 0
    assert S.dense_index(df.limit(0), 0.6).links.count() == 0


def test_block_count():
    assert S.block_count(100, 8, 8) == 1
    assert S.block_count(20_000, 8, 8) == 4
    assert S.block_count(10_000_000, 200, 4000) >= 477


def test_given_pairs_keep_direction_and_count_once(spark):
    pairs = spark.createDataFrame(
        [(1, 2, 0.9), (2, 1, 0.8), (1, 3, 0.7), (1, 3, 0.75)], "mid int, sim_mid int, score double"
    )
    index = S.index_of_pairs(pairs)
    asked = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (1, 3)], "a int, b int")
    assert rows(index.lookup(asked, "a", "b"), "a", "b", "score") == [
        (1, 2, 0.9), (1, 3, 0.75), (2, 1, 0.8),
    ]


def test_map_view_takes_the_last(spark):
    nested = spark.createDataFrame(
        [(1, [(2, 0.5), (3, 0.6), (2, 0.7)])], "mid int, recs array<struct<mid:int,score:double>>"
    )
    assert S.recs_as_map(nested).first()["scores"] == {3: 0.6, 2: 0.7}
