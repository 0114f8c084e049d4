"""Embedding near duplicates against all pairs, on a hot group, copies and odd vectors."""

import numpy as np
import pytest

from tasteloom.llm import neardup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, cls int, block int"


def brute(rows, threshold=neardup.THRESHOLD):
    """``vec_id, n_links, component_id, kept`` of rows with distinct ids."""
    usable = {}
    for at, (_, vec, label, *_) in enumerate(rows):
        if label is None or not vec or any(x is None or not np.isfinite(x) for x in vec):
            continue
        vec = np.array(vec, np.float64)
        if vec.any():
            usable[at] = (label, vec / np.linalg.norm(vec))
    linked = {at: set() for at in range(len(rows))}
    for a, (la, va) in usable.items():
        for b, (lb, vb) in usable.items():
            if a != b and la == lb and len(va) == len(vb) and va @ vb >= threshold:
                linked[a].add(b)
    out = []
    for at, row in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            for other in linked[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        least = min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)
        out.append((row[0], len(linked[at]), least, row[0] is not None and row[0] == least))
    return sorted(out, key=str)


def cluster(rng, centre, n, noise):
    vecs = centre + noise * rng.normal(size=(n, len(centre)))
    return [[float(np.float32(x)) for x in v] for v in vecs]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    found = []

    def put(vec, label):
        found.append((len(found) * 7 % 1009, vec, label, "x", 1, 2))

    hot = rng.normal(size=24)
    for vec in cluster(rng, hot, 90, 0.05):
        put(vec, 1)
    for vec in cluster(rng, hot, 5, 0.05):
        put(vec, 2)
    for vec in cluster(rng, rng.normal(size=24), 30, 0.27):  # cosines on both sides of the threshold
        put(vec, 1)
    copy = [float(x) for x in range(1, 25)]
    for _ in range(40):
        put(copy, 1)
    put([2 * x for x in copy], 1)
    put(copy[:12], 1)
    put(copy[:12], 1)
    for vec in cluster(rng, np.zeros(24), 60, 1.0):
        put(vec, 1 + len(found) % 3)
    for vec in (None, [], [0.0] * 24, [*copy[:-1], None], [*copy[:-1], float("nan")], [float("inf")] * 24):
        put(vec, 1)
        put(vec, 1)
    put(copy, None)
    put(copy, None)
    put([1e30 * x for x in copy], 1)
    put([1e-38 * x for x in copy], 1)
    return found


@pytest.mark.parametrize("block", [neardup.BLOCK, 16])
def test_all_links_and_components(spark, rows, block):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = neardup.near_duplicates(table, block=block)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, found.collect()), key=str)
    want = brute(rows)
    links = sum(r[1] for r in want)
    assert len(got) == len(want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # nothing below the threshold
    assert sum(r[1] for r in got) >= 0.98 * links
    exact = [r for r in want if r[1] not in range(1, 30)]  # outside the loose cluster
    assert set(exact) <= set(got)


def test_repeated_rows_null_ids_and_no_rows(spark):
    vec = [1.0, 2.0, 3.0]
    table = spark.createDataFrame([(5, vec, 1), (5, vec, 1), (None, vec, 1), (None, None, 1)],
                                  "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, neardup.near_duplicates(table).collect()), key=str)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (None, 0, None, False)], key=str)
    assert neardup.near_duplicates(table.filter("vec_id = 0")).collect() == []


def test_rotation_keeps_angles_and_lengths():
    rng = np.random.default_rng(0)
    rows = neardup.unit(rng.normal(size=(20, 48)))
    turned = neardup.rotated(rows, 4)
    assert turned.shape == (20, 64)
    assert np.allclose(turned @ turned.T, rows @ rows.T)


def test_recall_at_the_threshold():
    """Pairs at exactly 0.93 meet in some table with probability above 0.99."""
    rng = np.random.default_rng(1)
    a = neardup.unit(rng.normal(size=(3000, 64)))
    b = rng.normal(size=a.shape)
    b = neardup.unit(b - (a * b).sum(1)[:, None] * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    x, y = (neardup.codes(v, neardup.TABLES, neardup.HASHES, neardup.PROBES) for v in (a, b))
    met = np.zeros(len(a), bool)
    for t in range(neardup.TABLES):
        at = slice(t * neardup.PROBES, (t + 1) * neardup.PROBES)
        met |= (x[:, [t * neardup.PROBES]] == y[:, at]).any(1)
        met |= (y[:, [t * neardup.PROBES]] == x[:, at]).any(1)
    assert met.mean() > 0.99


def test_a_pair_counts_in_its_first_meeting_only():
    rng = np.random.default_rng(2)
    probes, tables = 3, 4
    a, b = rng.integers(0, 6, (2, 200, tables * probes))
    times = np.zeros(200, int)
    met = np.zeros(200, bool)
    for t in range(tables):
        for code in range(6):
            own_a, own_b = a[:, t * probes] == code, b[:, t * probes] == code
            in_a = (a[:, t * probes : (t + 1) * probes] == code).any(1)
            in_b = (b[:, t * probes : (t + 1) * probes] == code).any(1)
            here = in_a & in_b & (own_a | own_b)
            met |= here
            times += here & neardup.meets_first(a, b, t, code, probes)
    assert (times == met).all()
