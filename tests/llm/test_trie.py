"""The prefix trie against sets of prefixes, whole and cut into any runs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tasteloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, class string, at string"


def sequences(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    out = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = tuple(own.get(first, [])[:h] + found[h:])
    return out


def brute(found, words):
    """Rows of the trie of ``{conv_id: turns}``."""
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, worth = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        value = (len(own) - 1) * words(path[-1]) if path else 0
        for d in range(len(path) + 1):
            worth[path[:d]] += value
            leaves[path[:d]] += not children[path]
    return sorted(
        (
            (
                min(own),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(own),
                len(children[path]),
                leaves[path],
                worth[path],
                [c for c in sorted(own) if len(found[c]) == len(path)],
            )
            for path, own in members.items()
        ),
        key=str,
    )


def counted(turn):
    return len(re.findall(r"[^\x20\x09-\x0D]+", turn[1]))


def hashed(rows):
    return sorted(
        (
            (*r[:-1], hashlib.sha256(",".join(map(str, r[-1])).encode()).hexdigest())
            for r in rows
        ),
        key=str,
    )


def of_table(spark, rows, group=trie.GROUP):
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    found = trie.trie(trie.rebuilt(trie.sequences(table)), group)
    return sorted(map(tuple, found.collect()), key=str)


LONG = "w " * 50_000
ODD = [
    (0, 0, "user", "hello there"),
    (0, 1, "assistant", "a b c"),
    (0, 2, "user", "x"),
    (0, 3, "user", LONG),
    *[(c, t, "user", text) for c in range(1, 45) for t, text in enumerate(("own", "hello there", "y"))],
    (7, None, "user", "null turn first"),
    (7, None, "user", "null turn first"),
    (7, 1, None, None),
    (7, 1, "user", None),
    (None, 0, "user", "no conversation"),
    (-3, 0, "user", "below zero"),
    (61, 0, "user", "no first conversation"),
    (10**12, 5, "", ""),
    (88, 0, "ué", " \t\n 　 "),
    *[(200, t, "user", str(t % 3)) for t in range(120)],
    *[(c, t, "user", "same") for c in range(300, 340) for t in range(3)],
]


@pytest.mark.parametrize("group", [2, trie.GROUP])
def test_odd_conversations(spark, group):
    assert of_table(spark, ODD, group) == hashed(brute(sequences(ODD), counted))


def test_no_rows(spark):
    assert of_table(spark, []) == []


def test_only_turnless(spark):
    """A conversation of one turn that its (missing) group's first one should have given."""
    ids = [c for c in range(100, 120) if zlib.crc32(str(c).encode()) % 4 and c % 20]
    rows = [(c, 0, "user", "x") for c in ids]
    empty = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert of_table(spark, rows) == [(min(ids), 0, None, len(ids), 0, 1, 0, empty)]


def test_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert of_table(spark, ODD, 2) == hashed(brute(sequences(ODD), counted))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def _runs(classes, cuts):
    edges = [0, *sorted(cuts), len(classes)]
    return [classes[a:b] for a, b in zip(edges, edges[1:]) if a < b]


@pytest.mark.parametrize("seed", range(60))
def test_forests_merge_to_the_same_trie_however_they_are_cut(seed):
    rng = random.Random(seed)
    found = {
        c: tuple(rng.choice("ab" if seed % 2 else "abcd") for _ in range(rng.randrange(0, 7)))
        for c in range(rng.randrange(1, 40))
    }
    words = {letter: i + 1 for i, letter in enumerate("abcd")}
    digests = {letter: hashlib.sha256(letter.encode()).digest()[: trie.WIDTH] for letter in "abcd"}
    groups = defaultdict(list)
    for c, turns in found.items():
        groups[b"".join(digests[t] for t in turns), turns].append(c)
    classes = sorted((key, turns, ids) for (key, turns), ids in groups.items())
    out, forests = trie.Finished(), []
    for run in _runs(classes, [rng.randrange(len(classes) + 1) for _ in range(rng.randrange(6))]):
        keys, per_turn = [r[0] for r in run], [[words[t] for t in r[1]] for r in run]
        ids = [min(r[2]) for r in run]
        ends = [str(min(r[2])).encode() for r in run]
        forests.append(trie.grow(keys, per_turn, ids, [len(r[2]) for r in run], ends, out))
    while len(forests) > 1:  # neighbours in any order
        i = rng.randrange(len(forests) - 1)
        packed = trie._forest_row(0, forests[i]).column("forest").to_pylist()[0]
        forests[i : i + 2] = [trie.merge(trie._forest_of(packed), forests[i + 1], out)]
    trie.finish(forests[0], out)
    named = {k: c for k, c in zip(out.key, out.conv) if k}
    members = {str(min(ids)).encode(): sorted(ids) for _, _, ids in classes}
    got = [
        (
            out.conv[i],
            out.depth[i],
            named[out.parent_key[i]] if out.parent_key[i] else out.parent[i],
            out.n[i],
            out.children[i],
            out.leaves[i],
            out.saved[i],
            members.get(out.ends[i], []),
        )
        for i in range(len(out.conv))
    ]
    assert sorted(got, key=str) == brute(found, lambda turn: words[turn])
