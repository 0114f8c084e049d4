"""The Merkle manifest against a tree built by hand, with small builders."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tasteloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, idx string, root string"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def counted(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(row):
    found = [row]
    while len(found[-1]) > 1:
        row = found[-1]
        found.append([digest(row[i : i + 3]) for i in range(0, len(row), 3)])
    return found


def path(tree, j):
    for row in tree[:-1]:
        start = j // 3 * 3
        run = row[start : start + 3]
        yield j - start, run[: j - start] + run[j - start + 1 :]
        j //= 3


def brute(rows):
    sources = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        later = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            later = text.replace("\n", "")
        head = [counted(x) for x in (doc_id, source, lang, n_chars)]
        leaf, shown = (digest([*head, counted(t)]) for t in (text, later))
        sources[source].append((doc_id is not None, doc_id, leaf, shown))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(sources[s], key=lambda x: (x[0], x[1] or 0, x[2])) for s in order}
    trees = {s: levels([x[2] for x in leaves[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for i, source in enumerate(order):
        for j, (_, doc_id, leaf, node) in enumerate(leaves[source]):
            steps = [*path(trees[source], j), *path(top, i)]
            for at, others in steps:
                node = digest([*others[:at], node, *others[at:]])
            proof = digest([o for _, others in steps for o in others])
            out.append((doc_id, leaf, trees[source][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)


def report(spark, rows, block):
    docs = table(spark, rows)
    found = merkle.build(docs, merkle.without_breaks(), block).report()
    assert found.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ]
    return sorted(map(tuple, found.collect()), key=str)


ODD = [
    (1, "a", "en", 3, "x\ny"),
    (1, "a", "en", 3, "x\ny"),
    (2, "a", None, None, None),
    (None, "a", "en", 0, ""),
    (None, None, None, None, None),
    (3, None, "de", 5, "é\n\nü"),
    (-7, "", "fr", 1, "\n"),
    (9, "é", "fr", 1, "z" * 300_000 + "\n"),
    (10, "z", "fr", 1, "lone"),
]


@pytest.mark.parametrize("block", [1, 2, merkle.BLOCK_LEVELS])
def test_odd_rows(spark, block):
    assert report(spark, ODD, block) == brute(ODD)


def test_hot_source_over_many_builders_and_many_sources(spark):
    rows = [(i, "hot", "en", i, f"text {i}\n") for i in range(400)]
    rows += [(1000 + i, f"s{i % 41}", "de", i, f"other\n{i}") for i in range(100)]
    want = brute(rows)
    assert report(spark, rows, 2) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_no_rows_and_one_row(spark):
    assert report(spark, [], 2) == []
    assert report(spark, ODD[:1], 2) == brute(ODD[:1])


def test_untampered_documents_verify(spark):
    rows = merkle.build(table(spark, ODD), block=1).report().collect()
    assert all(r["verified"] for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 31, 80])
def test_places_follow_from_subtree_sizes(n):
    """The closed form gives every node's place in the completion order."""
    leaves = [digest([str(i)]) for i in range(n)]
    tree = levels(leaves)
    log = merkle.completed(leaves, merkle.levels_of(n))
    assert len(log) == sum(map(len, tree))
    for row, at in zip(tree, merkle.places(n, merkle.levels_of(n)), strict=True):
        assert [log[p] for p in at] == row


def test_proofs_survive_packing():
    steps = [(0, ["ab" * 32]), (2, ["cd" * 32, "ef" * 32]), (0, [])]
    assert merkle.unpacked(merkle.packed(steps)) == steps
