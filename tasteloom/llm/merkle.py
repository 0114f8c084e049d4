"""A Merkle manifest of a dataset: a ternary tree per source and one over the sources.

The nodes are kept as append logs in completion order (postorder). Builders are aligned:
each takes a run of 3**7 nodes of one tree, so its log is a contiguous piece of the tree's
postorder, and builders of one round need nothing from each other. The tops of a round
are the nodes of the next one; a source with a third of all rows has more builders, not
a larger one. A node's place in a log follows from subtree sizes alone (``places``), so
siblings are addressed without any search, and only their digests travel: texts are
hashed where they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.llm.base import saved, scratch

FANOUT = 3
#: Levels that a builder completes; it takes 3**7 nodes for that.
BLOCK_LEVELS = 7
#: The columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(column: Column) -> Column:
    text = column.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(column.isNull(), F.lit("-")).otherwise(counted)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The 32 bytes of a leaf: every field as its byte count and value, a null one as ``-``."""
    return F.unhex(F.sha2(F.concat(*map(_field, fields)).cast("binary"), 256))


def without_breaks(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text as a tamperer leaves it: line feeds are gone where 2 divides the id's CRC."""
    chosen = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.translate(text, "\n", "")).otherwise(F.col(text))


# --- one builder's log ------------------------------------------------------------


def levels_of(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    found = 0
    while nodes > 1:
        nodes, found = -(-nodes // FANOUT), found + 1
    return found


def _parent(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def completed(leaves: Sequence[str], levels: int) -> list[str]:
    """All nodes above and with ``leaves`` (digests as hex text) in completion order."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(levels)]
    for i, node in enumerate(leaves):
        log.append(node)
        for run in runs:
            run.append(node)
            if len(run) < FANOUT and i < len(leaves) - 1:
                break
            node = _parent(run)
            run.clear()
            log.append(node)
    return log


@cache
def places(nodes: int, levels: int) -> list[np.ndarray]:
    """Per level the log places of its nodes, in closed form.

    Before node j of level l, which starts at leaf a = j * 3**l, all nodes are complete
    that end at a or earlier: a // 3**i of each level i. Its own subtree follows, as large
    as its leaves say, and it closes that.
    """
    found = []
    for level in range(levels + 1):
        width = FANOUT**level
        first = np.arange(0, nodes, width)
        leaves = np.minimum(width, nodes - first)
        before = sum(first // FANOUT**i for i in range(levels + 1))
        size = sum(-(-leaves // FANOUT**i) for i in range(level + 1))
        found.append(before + size - 1)
    return found


def siblings(log: Sequence[str], nodes: int, levels: int) -> list[list[tuple[int, list[str]]]]:
    """Per level and node: its place in its run, and the digests of the run's others."""
    found = []
    for at in places(nodes, levels)[:levels]:
        own = []
        for start in range(0, len(at), FANOUT):
            run = [log[p] for p in at[start : start + FANOUT]]
            own += [(i, run[:i] + run[i + 1 :]) for i in range(len(run))]
        found.append(own)
    return found


Steps = list[tuple[int, list[str]]]


def packed(steps: Steps) -> bytes:
    """A proof as bytes: per level the node's place, the number of siblings, their digests."""
    return b"".join(bytes((i, len(others))) + bytes.fromhex("".join(others)) for i, others in steps)


def unpacked(proof: bytes) -> Steps:
    steps, at = [], 0
    while at < len(proof):
        place, n = proof[at], proof[at + 1]
        at += 2
        steps.append((place, [proof[at + 32 * k : at + 32 * k + 32].hex() for k in range(n)]))
        at += 32 * n
    return steps


def folded(node: str, step: tuple[int, list[str]]) -> str:
    """The parent that a node and its siblings give."""
    place, others = step
    return _parent([*others[:place], node, *others[place:]])


# --- numbers of rows in an order --------------------------------------------------


def numbered(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """``rows`` with ``at``, the place of each in the whole order, from 0.

    Rows are range-partitioned, sorted and written; only the partitions' sizes meet in
    one place (a window over one row for each partition).
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = saved(ordered.withColumn("_id", F.monotonically_increasing_id()), folder)
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        written.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_id").bitwiseAND((1 << 33) - 1)
    return (
        written.withColumn("_part", part)
        .join(sizes, "_part")
        .withColumn("at", F.col("_before") + row)
        .drop("_id", "_part", "_before")
    )


# --- building ---------------------------------------------------------------------


def _levels_here(n: int, block: int) -> int:
    """Levels that a builder completes in a tree that has ``n`` nodes in this round."""
    return levels_of(n) if n <= FANOUT**block else block


def _built(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, last = [], []
            for n, nodes in zip(batch.column("n").to_pylist(), batch.column("nodes").to_pylist()):
                log = completed([x.hex() for x in nodes], _levels_here(n, block))
                logs.append(bytes.fromhex("".join(log)))
                last.append(bytes.fromhex(log[-1]))
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.record_batch(
                [*kept, pa.array(logs, pa.binary()), pa.array(last, pa.binary())],
                [*batch.schema.names, "log", "top"],
            )

    return run


def _round(nodes: DataFrame, columns: Sequence[str], block: int, folder: str) -> DataFrame:
    """The segments of one round, a row per builder; ``columns`` travel with the nodes."""
    of = F.floor(F.col("idx") / FANOUT**block).alias("block")
    entry = F.array_sort(F.collect_list(F.struct("idx", "digest", *columns)))
    arranged = (
        nodes.groupBy("tree", "n", of)
        .agg(entry.alias("e"))
        .select("tree", "n", "block", *[f"e.{c}" for c in columns], F.col("e.digest").alias("nodes"))
    )
    schema = ", ".join(f"{name} {kind}" for name, kind in arranged.dtypes) + ", log binary, top binary"
    return saved(arranged.mapInArrow(_built(block), schema), folder)


def grown(
    nodes: DataFrame, most: int, columns: Sequence[str], block: int, folder: str
) -> list[DataFrame]:
    """Segments of all rounds over ``tree, n, idx, digest`` nodes, ``n`` of them in each tree.

    ``most`` is the number of nodes of the largest tree. A tree takes part in the rounds
    until one node of it is left.
    """
    span = FANOUT**block
    rounds = [_round(nodes, columns, block, f"{folder}/round0")]
    while most > span:
        most = -(-most // span)
        above = rounds[-1].filter(F.col("n") > span).select(
            "tree",
            F.ceil(F.col("n") / span).alias("n"),
            F.col("block").alias("idx"),
            F.col("top").alias("digest"),
        )
        rounds.append(_round(above, [], block, f"{folder}/round{len(rounds)}"))
    return rounds


def tops(rounds: Sequence[DataFrame], block: int) -> DataFrame:
    """``tree, digest``: the last node of every tree."""
    last = [
        segments.filter(F.col("n") <= FANOUT**block).select("tree", F.col("top").alias("digest"))
        for segments in rounds
    ]
    return reduce(DataFrame.unionByName, last)


# --- proofs -----------------------------------------------------------------------


def _steps(n: int, nodes: int, log: bytes, block: int) -> list[Steps]:
    """For every node of a segment the steps up to the segment's top."""
    text = log.hex()
    digests = [text[i : i + 64] for i in range(0, len(text), 64)]
    found: list[Steps] = [[]]
    for own in reversed(siblings(digests, nodes, _levels_here(n, block))):
        found = [[step, *found[j // FANOUT]] for j, step in enumerate(own)]
    return found


def _proofs(block: int):
    """``tree, block, above`` of every node of a segment: it is a block of the round below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            steps = _steps(row["n"], row["nodes"], row["log"], block)
            first = row["block"] * FANOUT**block
            yield pa.record_batch(
                [
                    pa.array([row["tree"]] * len(steps), pa.int64()),
                    pa.array(range(first, first + len(steps)), pa.int64()),
                    pa.array([packed(s) + row["above"] for s in steps], pa.binary()),
                ],
                ["tree", "block", "above"],
            )

    return run


def proofs(segments: DataFrame, block: int) -> DataFrame:
    """The whole proofs of a round's nodes, from segments ``with_above``."""
    counted = segments.withColumn("nodes", F.size("nodes")).select(
        "tree", "n", "block", "nodes", "log", "above"
    )
    return counted.mapInArrow(_proofs(block), "tree long, block long, above binary")


def with_above(
    rounds: Sequence[DataFrame], bases: DataFrame, block: int, folder: str
) -> DataFrame:
    """The first round's segments with ``above``, the proof of each one's top.

    ``bases`` has ``tree, above`` of whole trees. Rounds are gone through from the last;
    what a round gives to the one below is one proof for each of its builders.
    """
    span = FANOUT**block
    found = None
    for at in range(len(rounds) - 1, -1, -1):
        last = rounds[at].filter(F.col("n") <= span).join(bases, "tree")
        if found is not None:
            given = saved(proofs(found, block), f"{folder}/above{at}")
            inner = rounds[at].filter(F.col("n") > span).join(given, ["tree", "block"])
            last = last.unionByName(inner)
        found = last
    return found


_RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _checked(root: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            yield _segment_report(row, root, block)

    return run


def _segment_report(row: dict, root: str, block: int) -> pa.RecordBatch:
    """Proof and folded root of every leaf of a first-round segment."""
    above = unpacked(row["above"])
    beyond = "".join(other for _, others in above for other in others)
    #: The root that a digest at a node's place folds to.
    known: dict[tuple[int, int, str], str] = {}

    def fold(node: str, j: int, steps: Steps) -> str:
        passed = []
        for level, step in enumerate([*steps, *above]):
            here = (level, j // FANOUT**level, node)
            if here in known:
                node = known[here]
                break
            passed.append(here)
            node = folded(node, step)
        known.update(dict.fromkeys(passed, node))
        return node

    leaves = [x.hex() for x in row["nodes"]]
    shown = [leaf if t is None else t.hex() for leaf, t in zip(leaves, row["shown"])]
    steps = _steps(row["n"], len(leaves), row["log"], block)
    texts = ["".join(o for _, others in s for o in others) + beyond for s in steps]
    roots = [fold(shown[j], j, steps[j]) for j in range(len(leaves))]
    return pa.record_batch(
        [
            pa.array(row["doc_id"], pa.int64()),
            pa.array(leaves),
            pa.array([row["subroot"].hex()] * len(leaves)),
            pa.array([root] * len(leaves)),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in texts]),
            pa.array(roots),
            pa.array([r == root for r in roots]),
        ],
        ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


# --- the manifest -----------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """The logs of all trees. ``root`` is None for a table without rows."""

    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    #: ``tree, at``: the place of a source's subroot among the leaves of the top tree.
    order: DataFrame
    root: bytes | None
    block: int
    folder: str

    def subroots(self) -> DataFrame:
        return tops(self.rounds, self.block)

    def report(self) -> DataFrame:
        """Proof of every leaf, folded from the digest that the document has now."""
        spark = self.order.sparkSession
        if self.root is None:
            return spark.createDataFrame([], _RESULT)
        whole = spark.createDataFrame([(0, b"")], "tree long, above binary")
        top = with_above(self.top_rounds, whole, self.block, f"{self.folder}/top")
        given = proofs(top, self.block).select(F.col("block").alias("at"), "above")
        bases = saved(
            self.order.join(given, "at").select("tree", "above"), f"{self.folder}/bases"
        )
        segments = with_above(self.rounds, bases, self.block, f"{self.folder}/trees")
        named = segments.join(self.subroots().withColumnRenamed("digest", "subroot"), "tree")
        wanted = named.select("n", "doc_id", "nodes", "shown", "log", "above", "subroot")
        return wanted.mapInArrow(_checked(self.root.hex(), self.block), _RESULT)


def build(docs: DataFrame, shown: Column | None = None, block: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of a table with the columns ``FIELDS``; others are not looked at.

    ``shown`` is the text as it is met when the manifest is checked (by default the same).
    A null field is hashed as ``-``, an empty one as ``0:``. Leaves of a source ascend by
    doc_id, null first; equal ids by their digests, so equal rows are leaves side by side.
    Rows without a source are a source of their own, the first. A table without rows has
    no root and an empty report.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "merkle")
    text = F.col("text") if shown is None else shown
    later = leaf_digest([*map(F.col, FIELDS[:-1]), text])
    hashed = docs.select(
        "doc_id",
        "source",
        leaf_digest(list(map(F.col, FIELDS))).alias("digest"),
        F.when(~text.eqNullSafe(F.col("text")), later).alias("shown"),
        # Splits the sort of many equal rows; it decides nothing else.
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )
    leaves = saved(hashed, f"{folder}/leaves")
    placed = numbered(leaves, ["source", "doc_id", "digest", "salt"], f"{folder}/sorted")
    # A source's tree is called after the place of its first leaf, so trees are ordered as sources.
    trees = saved(
        placed.groupBy("source").agg(F.min("at").alias("tree"), F.count("*").alias("n")),
        f"{folder}/sources",
    )
    named = trees.withColumnRenamed("source", "_source")
    nodes = placed.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", "n", (F.col("at") - F.col("tree")).alias("idx"), "digest", "doc_id", "shown"
    )
    facts = trees.agg(F.max("n").alias("most"), F.count("*").alias("trees")).first()
    if not facts["trees"]:
        return Manifest([], [], trees, None, block, folder)
    rounds = grown(nodes, facts["most"], ["doc_id", "shown"], block, f"{folder}/trees")
    order = saved(
        numbered(tops(rounds, block), ["tree"], f"{folder}/subroots"), f"{folder}/order"
    )
    leaves_above = order.select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(facts["trees"]).cast("long").alias("n"),
        F.col("at").alias("idx"),
        "digest",
    )
    top_rounds = grown(leaves_above, facts["trees"], [], block, f"{folder}/top")
    root = tops(top_rounds, block).first()["digest"]
    return Manifest(rounds, top_rounds, order, bytes(root), block, folder)
