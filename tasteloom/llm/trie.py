"""The prefix trie of conversations: which turns they share, and what sharing them saves.

A conversation is the sequence of its turns' digests (16 bytes each); texts stay where
they are read. Equal conversations are one class with a count. Classes are sorted by their
sequences, so each trie node is a run of them and neighbours tell its depth: union-find
over the edges between neighbours, the longest common prefix first, makes a branching
node with each merge. That is done for a batch of classes at a time. What a batch cannot
settle are the nodes on the paths of its first and its last class; the rest is finished and
written. Such contracted forests are merged with their neighbours', batches first, then
partitions in groups, until one is left. A task never holds more than one batch, or the
paths of one group of forests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.base import bounded_batches, saved, scratch

#: Bytes of a turn's digest.
WIDTH = 16
#: Forests that one task merges.
GROUP = 64
#: Ids of one class that are joined to one text; longer lists are hashed text by text.
CHUNK = 1 << 16


# --- conversations as sequences ---------------------------------------------------


def word_count(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns ARRAY<STRUCT<digest, words>>`` of ``conv_id, turn, role, text`` rows.

    Turns are ordered by number, null first, and by digest where numbers are equal;
    repeated rows stay. Rows without a conv_id belong to no conversation.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, WIDTH).alias("digest"),
        word_count(text).alias("words"),
    )
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("turn").isNotNull().alias("given"), "turn", "digest", "words"))
    )
    plain = F.transform(
        "all", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))
    )
    return rows.groupBy("conv_id").agg(ordered.alias("all")).select("conv_id", plain.alias("turns"))


#: A conversation takes over fewer turns than this from the first one of its group.
MOST_SHARED = 4
#: Conversations in a group.
FAMILY = 20


def rebuilt(found: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of their group's first conversation.

    Conversation c takes the first h turns of c - c % 20 (all if there are fewer, none if
    that one doesn't exist), then its own after its first h; h is the CRC of c modulo 4.
    """
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    heads = found.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, MOST_SHARED - 1).alias("_head")
    )
    own = found.withColumn("_first", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn(
        "_h", shared
    )
    head = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "_first", "left").select("conv_id", F.concat(head, rest).alias("turns"))


# --- forests ----------------------------------------------------------------------


@dataclass
class Node:
    """A trie node as far as it is known; ``children``, ``leaves`` and ``saved`` are those
    of finished children."""

    conv: int
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: bytes | None = None

    def add(self, other: Node) -> None:
        self.conv = min(self.conv, other.conv)
        self.n += other.n
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends


@dataclass
class Forest:
    """The unsettled nodes of a run of classes: those on the paths of its first and last.

    ``left[d]`` and ``right[d]`` are the nodes of depth d on the two paths; up to the depth
    ``common`` they are the same objects.
    """

    first: bytes
    last: bytes
    first_words: list[int]
    last_words: list[int]
    left: list[Node]
    right: list[Node]
    common: int


@dataclass
class Finished:
    """Rows of settled nodes; a parent that is not settled is named by its path's key."""

    conv: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    parent: list[int | None] = field(default_factory=list)
    parent_key: list[bytes | None] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    saved: list[int] = field(default_factory=list)
    ends: list[bytes | None] = field(default_factory=list)
    key: list[bytes | None] = field(default_factory=list)

    def row(self, depth, conv, n, children, leaves, saved, ends, parent, parent_key, key=None) -> None:
        self.conv.append(conv)
        self.depth.append(depth)
        self.parent.append(parent)
        self.parent_key.append(parent_key)
        self.n.append(n)
        self.children.append(children)
        self.leaves.append(leaves)
        self.saved.append(saved)
        self.ends.append(ends)
        self.key.append(key)


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // WIDTH
    different = np.frombuffer(a, np.uint8, most) != np.frombuffer(b, np.uint8, most)
    return int(different.argmax()) // WIDTH


def path_key(sequence: bytes, depth: int) -> bytes:
    """What a path's node is called until its smallest member is known."""
    return hashlib.blake2b(sequence[: depth * WIDTH], digest_size=16).digest()


def grow(
    keys: list[bytes], words: list[list[int]], convs: list[int], counts: list[int],
    ends: list[bytes], out: Finished,
) -> Forest:
    """The forest of sorted, different sequences.

    Union-find over the edges between neighbours in descending order of their common
    prefix: a component is the run of classes below its top node, so merging two at depth
    d hangs both tops under the node of depth d. Turns in between have one child each.
    """
    m = len(keys)
    edges = [common_turns(keys[i], keys[i + 1]) for i in range(m - 1)]
    # Compact nodes: a class each, then a branching node for each merge that needs one.
    depth = [len(k) // WIDTH for k in keys]
    nodes = [Node(convs[i], counts[i], ends=ends[i]) for i in range(m)]
    low, high = list(range(m)), list(range(m))
    below: list[list[int]] = [[] for _ in range(m)]
    above: list[int] = [-1] * m
    root, top = list(range(m)), list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for e in sorted(range(m - 1), key=lambda i: -edges[i]):
        a, b = find(e), find(e + 1)
        left, right = top[a], top[b]
        if depth[left] != edges[e]:
            node = len(nodes)
            nodes.append(Node(nodes[left].conv, nodes[left].n))
            depth.append(edges[e])
            low.append(low[left])
            high.append(high[left])
            below.append([left])
            above.append(-1)
            above[left] = node
            left = node
        # The right part starts with a longer sequence, so its top lies deeper.
        below[left].append(right)
        above[right] = left
        nodes[left].conv = min(nodes[left].conv, nodes[right].conv)
        nodes[left].n += nodes[right].n
        high[left] = high[right]
        root[b] = a
        top[a] = left

    open_ = [low[i] == 0 or high[i] == m - 1 for i in range(len(nodes))]
    # Deepest first, so that all below a node is known when its turn comes.
    for i in sorted(range(len(nodes)), key=lambda i: -depth[i]):
        if open_[i]:
            continue
        node, up = nodes[i], above[i]
        per_turn = words[low[i]]
        children, leaves = node.children, node.leaves or 1
        total = node.saved
        end = node.ends
        for d in range(depth[i], depth[up], -1):
            total += (node.n - 1) * per_turn[d - 1]
            last = d == depth[up] + 1
            parent = node.conv
            named = None
            if last:
                parent = None if open_[up] else nodes[up].conv
                named = path_key(keys[low[i]], d - 1) if open_[up] else None
            out.row(d, node.conv, node.n, children, leaves, total, end, parent, named)
            children, end = 1, None
        nodes[up].children += 1
        nodes[up].leaves += leaves
        nodes[up].saved += total

    def path(start: int) -> list[Node]:
        """The nodes on a class's path by depth, with those of single turns."""
        found: list[Node] = []
        i = start
        while i >= 0:
            up = above[i]
            least = depth[up] + 1 if up >= 0 else 0
            found.append(nodes[i])
            found += [chain(i, d) for d in range(depth[i] - 1, least - 1, -1)]
            i = up
        return found[::-1]

    single: dict[tuple[int, int], Node] = {}

    def chain(i: int, d: int) -> Node:
        return single.setdefault((i, d), Node(nodes[i].conv, nodes[i].n))

    return Forest(
        keys[0], keys[-1], words[0], words[-1], path(0), path(m - 1), common_turns(keys[0], keys[-1])
    )


def _settle(path: list[Node], sequence: bytes, words: list[int], down_to: int, out: Finished) -> None:
    """Finish the nodes of a path that are deeper than ``down_to``, each into its parent."""
    for d in range(len(path) - 1, down_to, -1):
        node, up = path[d], path[d - 1]
        total = node.saved + (node.n - 1) * words[d - 1]
        leaves = node.leaves or 1
        out.row(
            d, node.conv, node.n, node.children, leaves, total, node.ends,
            None, path_key(sequence, d - 1), path_key(sequence, d),
        )
        up.children += 1
        up.leaves += leaves
        up.saved += total


def merge(a: Forest, b: Forest, out: Finished) -> Forest:
    """One forest of two neighbours; nodes that lie on none of the outer paths are finished.

    The last path of ``a`` and the first of ``b`` are one as far as their sequences agree.
    """
    shared = common_turns(a.last, b.first)
    for d in range(shared + 1):
        a.right[d].add(b.left[d])
        b.left[d] = a.right[d]
        if d <= b.common:
            b.right[d] = a.right[d]
    _settle(a.right, a.last, a.last_words, max(a.common, shared), out)
    _settle(b.left, b.first, b.first_words, max(b.common, shared), out)
    _settle(a.right[: shared + 1], a.last, a.last_words, max(a.common, b.common), out)
    common = min(a.common, shared, b.common)
    return Forest(a.first, b.last, a.first_words, b.last_words, a.left, b.right, common)


def finish(forest: Forest, out: Finished) -> None:
    """Settle what is left: the forest has no neighbours."""
    _settle(forest.right, forest.last, forest.last_words, forest.common, out)
    _settle(forest.left, forest.first, forest.first_words, 0, out)
    root = forest.left[0]
    out.row(
        0, root.conv, root.n, root.children, root.leaves or 1, root.saved, root.ends,
        None, None, path_key(b"", 0),
    )


# --- forests in tasks -------------------------------------------------------------

_FINISHED = [
    pa.field("conv", pa.int64()),
    pa.field("depth", pa.int64()),
    pa.field("parent", pa.int64()),
    pa.field("parent_key", pa.binary()),
    pa.field("n", pa.int64()),
    pa.field("children", pa.int64()),
    pa.field("leaves", pa.int64()),
    pa.field("saved", pa.int64()),
    pa.field("ends", pa.binary()),
    pa.field("key", pa.binary()),
]
_NODES = pa.list_(
    pa.struct(
        [(n, pa.int64()) for n in ("conv", "n", "children", "leaves", "saved")] + [("ends", pa.binary())]
    )
)
_FOREST = pa.struct(
    [
        ("first", pa.binary()),
        ("last", pa.binary()),
        ("first_words", pa.list_(pa.int32())),
        ("last_words", pa.list_(pa.int32())),
        ("common", pa.int32()),
        ("left", _NODES),
        ("right", _NODES),
    ]
)
_SCHEMA = pa.schema([*_FINISHED, pa.field("at", pa.int64()), pa.field("forest", _FOREST)])
_SPARK_NODES = (
    "array<struct<conv:bigint,n:bigint,children:bigint,leaves:bigint,saved:bigint,ends:binary>>"
)
_SPARK_SCHEMA = (
    "conv bigint, depth bigint, parent bigint, parent_key binary, n bigint, children bigint, "
    "leaves bigint, saved bigint, ends binary, key binary, at bigint, "
    "forest struct<first:binary,last:binary,first_words:array<int>,last_words:array<int>,"
    f"common:int,left:{_SPARK_NODES},right:{_SPARK_NODES}>"
)
FINISHED = [f.name for f in _FINISHED]


def _rows(out: Finished) -> Iterator[pa.RecordBatch]:
    if out.conv:
        n = len(out.conv)
        columns = [pa.array(getattr(out, f.name), f.type) for f in _FINISHED]
        empty = [pa.nulls(n, pa.int64()), pa.nulls(n, _FOREST)]
        yield pa.RecordBatch.from_arrays([*columns, *empty], schema=_SCHEMA)


def _forest_row(at: int, forest: Forest) -> pa.RecordBatch:
    packed = {
        "first": forest.first,
        "last": forest.last,
        "first_words": forest.first_words,
        "last_words": forest.last_words,
        "common": forest.common,
        "left": [vars(node) for node in forest.left],
        # The nodes up to ``common`` stand on both paths and are written once.
        "right": [vars(node) for node in forest.right[forest.common + 1 :]],
    }
    columns = [pa.nulls(1, f.type) for f in _FINISHED]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array([at], pa.int64()), pa.array([packed], _FOREST)], schema=_SCHEMA
    )


def _forest_of(packed: dict) -> Forest:
    left = [Node(**node) for node in packed["left"]]
    right = left[: packed["common"] + 1] + [Node(**node) for node in packed["right"]]
    return Forest(
        packed["first"], packed["last"], packed["first_words"], packed["last_words"],
        left, right, packed["common"],
    )


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that a sorted partition settles, then its forest; batch by batch."""
    forest, at = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        out = Finished()
        new = grow(
            columns["seq"], columns["words"], columns["conv"], columns["n"], columns["class"], out
        )
        at = columns["at"][0] if at is None else at
        forest = new if forest is None else merge(forest, new, out)
        yield from _rows(out)
    if forest is not None:
        yield _forest_row(at, forest)


def _merged(last: bool):
    """Groups of neighbouring forests into one each; the ``last`` round settles all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            out, forest = Finished(), None
            for packed in row["forests"]:
                new = _forest_of(packed["forest"])
                forest = new if forest is None else merge(forest, new, out)
            if last:
                finish(forest, out)
            yield from _rows(out)
            if not last:
                yield _forest_row(row["at"], forest)

    return run


# --- the trie ---------------------------------------------------------------------


def members_of(found: DataFrame) -> DataFrame:
    """``conv_id, class, seq, words``: sequences in the form that classes are sorted by."""
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return found.select(
        "conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["words"]).alias("words")
    ).select("conv_id", F.unhex(F.substring(F.sha2("seq", 256), 1, 32)).alias("class"), "seq", "words")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per class of all its id texts, which come in order; nothing is kept but its state."""
    schema = pa.schema([("class", pa.binary()), ("sha", pa.string())])
    now, state = None, None
    for batch in batches:
        names, digests = [], []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if state is not None and name == now:
                state.update(("," + ids).encode())
                continue
            if state is not None:
                names.append(now)
                digests.append(state.hexdigest())
            now, state = name, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(digests, pa.string())], schema=schema
        )
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([now], pa.binary()), pa.array([state.hexdigest()])], schema=schema
        )


def id_digests(members: DataFrame) -> DataFrame:
    """``class, sha``: SHA-256 of a class's ids, ascending and comma-joined.

    Ids are joined in ranges of 65,536 first, so a class with a third of all conversations
    is a short list of texts to the one task that hashes them in order.
    """
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    ranges = members.groupBy("class", F.floor(F.col("conv_id") / CHUNK).alias("range")).agg(
        F.array_join(ids, ",").alias("ids")
    )
    ordered = ranges.repartition("class").sortWithinPartitions("class", "range")
    return ordered.select("class", "ids").mapInArrow(_hashed, "class binary, sha string")


def _looked_up(rows: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``table`` for ``name``; rows without it aren't shuffled."""
    found = rows.filter(F.col(name).isNotNull()).join(table, name, "left")
    rest = rows.filter(F.col(name).isNull())
    for other in table.columns:
        if other != name:
            rest = rest.withColumn(other, F.lit(None).cast(table.schema[other].dataType))
    return found.unionByName(rest)


def trie(found: DataFrame, group: int = GROUP) -> DataFrame:
    """The nodes of the prefix trie of ``conv_id, turns`` sequences, a row each.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (both over the node's
    subtree) and ``ends_sha256`` of the conversations that end there. Without
    conversations there are no nodes; a conversation without turns ends at the root.
    """
    spark = found.sparkSession
    folder = scratch(spark, "trie")
    bounded_batches(spark)
    members = saved(members_of(found), f"{folder}/members")
    classes = saved(
        members.groupBy("class").agg(
            F.min("conv_id").alias("conv"),
            F.count("*").alias("n"),
            F.first("seq").alias("seq"),
            F.first("words").alias("words"),
        ),
        f"{folder}/classes",
    )
    ordered = classes.repartitionByRange("seq").sortWithinPartitions("seq")
    numbered = ordered.withColumn("at", F.monotonically_increasing_id())
    grown = saved(numbered.mapInArrow(_grown, _SPARK_SCHEMA), f"{folder}/grown")
    finished = [grown.filter(F.col("forest").isNull()).select(*FINISHED)]
    forests = grown.filter(F.col("forest").isNotNull()).select(
        F.shiftright("at", 33).alias("at"), "forest"
    )
    parts = (forests.agg(F.max("at")).first()[0] or 0) + 1
    step = 0
    while True:
        parts, step = -(-parts // group), step + 1
        near = forests.groupBy(F.floor(F.col("at") / group).alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("at", "forest"))).alias("forests")
        )
        merged = saved(near.mapInArrow(_merged(parts == 1), _SPARK_SCHEMA), f"{folder}/merged{step}")
        finished.append(merged.filter(F.col("forest").isNull()).select(*FINISHED))
        if parts == 1:
            break
        forests = merged.filter(F.col("forest").isNotNull()).select("at", "forest")
    nodes = reduce(DataFrame.unionByName, finished)
    named = nodes.filter(F.col("key").isNotNull()).select(
        F.col("key").alias("parent_key"), F.col("conv").alias("_parent")
    )
    nodes = _looked_up(nodes.drop("key"), "parent_key", named)
    digests = saved(id_digests(members), f"{folder}/ends")
    nodes = _looked_up(nodes, "ends", digests.withColumnRenamed("class", "ends"))
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.coalesce("parent", "_parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
