"""Exact n-gram Jaccard join by vertical partitioning.

A text's set is its distinct word n-grams. All n-grams have one global order, from rare to
common, by the load of the bucket that the gram hashes to: ``BUCKETS`` counts over the whole
corpus. The order is cut into ``FRAGMENTS`` of equal load, and each set into the segments
that fall into them. The overlap of two texts is counted per fragment and summed per pair.

Pairs are looked for by exact bounds only. Two sets that reach the threshold share a gram
among the first of each in the global order (prefix filter), have similar sizes, and leave
room behind that gram for the overlap that is needed; a parity bitmap with about a bit per gram
bounds the difference of two sets from below. The join of the gram lists compares the bitmaps
folded to ``SKETCH_BITS``, so that most pairs just under the threshold are never emitted, and emits
a pair at its first common gram alone (as far as ``EARLIER`` grams tell); the whole bitmaps are
compared next. Whatever passes is counted exactly.

Copies and large groups: equal sets are one class, named by a 64-bit digest, and only classes
are joined. Then, in some rounds, each class is compared with one leader of another component:
a class of similar size with which it shares most prefix grams. After these only pairs across
components are looked for, gram lists that lie within one component not at all. So a group of near copies costs about its size, and no link that joins two components
is lost. Links within a component add nothing to it and are not listed.

No list of a gram is gathered: lists are joined, and Spark splits long ones. The sets that
counting needs are made from the texts again, of those classes alone.

Defined cases: null or empty texts have no grams and stay alone; with fewer words than n the
whole text is one gram; rows with a null ``doc_id`` join groups but never name one, and a
group of them alone has a null id; repeated rows are one class; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm import words as W
from tasteloom.llm.base import arrow_map, saved, scratch, slices
from tasteloom.llm.components import components
from tasteloom.llm.ids import id_filter, passing, rows_passing, rows_passing_all, rows_passing_any, with_slot

N = 3
#: The threshold is PERCENT / 100.
PERCENT = 90
_BUCKET_BITS = 16
BUCKETS = 1 << _BUCKET_BITS
FRAGMENTS = 4
#: Least bits of the parity bitmap. A larger set has the next power of two: with fewer bits than
#: grams the bound would lie under what the threshold allows, and every pair would pass.
MAP_BITS = 1024
#: Bits of the map folded to a fixed width, which the join of gram lists compares itself.
SKETCH_BITS = 1024
#: Grams before its own that a list entry knows of, so that a pair is emitted once. A pair whose
#: first common grams lie behind them comes out more than once and is made distinct.
EARLIER = 8
#: Bits of the filters of grams that several classes have: 4 MB, whatever their number.
GRAM_BITS = 1 << 25
#: Rounds in which classes are compared with leaders before pairs are looked for. All but the first
#: are for lists of more than LONG_LIST classes: no entry of a shorter one makes that many pairs.
LEADER_ROUNDS = 4
LONG_LIST = 16


def _grams(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of all rows, repeats included, and the limits of the rows in them."""
    found = W.words(column, W.SPACED_LOWER)
    counts = found.counts()
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    limits = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(limits[-1], np.uint64)
    long = W.inside_rows(found.rows, n)
    row = W.row_of(found.rows)
    long_rows = counts >= n
    at = np.flatnonzero(long)
    place = limits[row[at]] + at - found.rows[row[at]]
    out[place] = W.grams(found.hashes, n)[at] if len(at) else 0
    for i in np.flatnonzero(~long_rows & (counts > 0)):
        first, last = found.rows[i], found.rows[i + 1]
        out[limits[i]] = W.grams(found.hashes[first:last], last - first)[0] ^ np.uint64(last - first)
    return out, limits


def bucket_loads(docs: DataFrame, n: int) -> DataFrame:
    """``bucket, load``: grams of all texts per bucket; a task gives a row per bucket."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            grams, _ = _grams(batch.column(0), n)
            total += np.bincount((grams & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "load"])

    part = docs.select("text").mapInArrow(step, "bucket bigint, load bigint")
    return part.groupBy("bucket").agg(F.sum("load").alias("load"))


@dataclass(frozen=True)
class Order:
    """The global order: the rank of every bucket, and the ranks at which fragments begin."""

    ranks: np.ndarray
    pivots: np.ndarray

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Grams as numbers that sort in the global order; equal only for equal hashes."""
        bucket = (grams & np.uint64(BUCKETS - 1)).astype(np.int64)
        rank = self.ranks[bucket] << np.uint64(64 - _BUCKET_BITS)
        return rank | grams >> np.uint64(_BUCKET_BITS)

    def fragment_limits(self, keys: np.ndarray) -> np.ndarray:
        rank = keys >> np.uint64(64 - _BUCKET_BITS)
        return np.concatenate([[0], np.searchsorted(rank, self.pivots), [len(keys)]])


def global_order(docs: DataFrame, n: int, fragments: int = FRAGMENTS) -> Order:
    """The driver sees one number per bucket."""
    rows = bucket_loads(docs, n).toArrow()
    loads = np.zeros(BUCKETS, np.int64)
    loads[rows["bucket"].to_numpy()] = rows["load"].to_numpy()
    order = np.argsort(loads, kind="stable")
    ranks = np.empty(BUCKETS, np.uint64)
    ranks[order] = np.arange(BUCKETS, dtype=np.uint64)
    so_far = np.cumsum(loads[order])
    cuts = so_far[-1] * np.arange(1, fragments) // fragments
    return Order(ranks, np.searchsorted(so_far, cuts, side="right").astype(np.uint64))


def _sets(batch: pa.RecordBatch, at: int, order: Order, n: int) -> Iterator[np.ndarray]:
    grams, limits = _grams(batch.column(at), n)
    keys = order.keys(grams)
    for a, b in zip(limits[:-1], limits[1:], strict=True):
        yield np.unique(keys[a:b])


def _digest(keys: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "little", signed=True)


def _ceil(a, b):
    return -(-a // b)


def probe_prefix(size: int, percent: int) -> int:
    """Grams among which a set shares one with any similar set that is not larger."""
    return size - _ceil(percent * size, 100) + 1


def parity_map(keys: np.ndarray) -> bytes:
    """Bit i: whether an odd number of the keys falls on it."""
    bits = max(MAP_BITS, 1 << max(len(keys) - 1, 0).bit_length())
    at = (W.mixed(keys) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1 == 1).tobytes()


def parity_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits in which the maps of each pair differ, the longer one folded onto the shorter.

    No more than the keys that only one of the sets has.
    """
    out = np.zeros(len(left), np.int64)
    lengths = np.array([[len(a), len(b)] for a, b in zip(left, right, strict=True)]).reshape(-1, 2)
    for pair in np.unique(lengths, axis=0):
        at = np.flatnonzero((lengths == pair).all(1))
        sides = [
            np.frombuffer(b"".join(side[i] for i in at), np.uint64).reshape(len(at), -1) for side in (left, right)
        ]
        width = pair.min() // 8
        a, b = (
            np.bitwise_xor.reduce(side.reshape(len(at), -1, width), axis=1) for side in sides
        )
        out[at] = np.bitwise_count(a ^ b).sum(1, np.int64)
    return out


def sketch(parity: bytes) -> list[int]:
    """The map folded to ``SKETCH_BITS``, as signed numbers of 64 bits."""
    words = np.frombuffer(parity, np.uint64).reshape(-1, SKETCH_BITS // 64)
    return np.bitwise_xor.reduce(words, axis=0).view(np.int64).tolist()


def sketch_distance(x: str, y: str) -> Column:
    """Bits in which two sketches differ: no more than the grams that only one set has."""
    words = [F.col(x)[i].bitwiseXOR(F.col(y)[i]) for i in range(SKETCH_BITS // 64)]
    return sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0]))


def _signatures(docs: DataFrame, order, n: int, percent: int) -> DataFrame:
    """``doc_id, row, n_shingles, cid, prefix, map`` of every row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, cids, prefixes, maps = [], [], [], []
        for keys in _sets(batch, 2, order.value, n):
            sizes.append(len(keys))
            cids.append(_digest(keys))
            prefixes.append(keys[: probe_prefix(len(keys), percent)].view(np.int64) if len(keys) else keys[:0].view(np.int64))
            maps.append(parity_map(keys))
        limits = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
        flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
        return pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(cids, pa.int64()),
                pa.ListArray.from_arrays(pa.array(limits), pa.array(flat, pa.int64())),
                pa.array(maps, pa.binary()),
            ],
            ["doc_id", "row", "n_shingles", "cid", "prefix", "map"],
        )

    schema = "doc_id bigint, row bigint, n_shingles bigint, cid bigint, prefix array<bigint>, map binary"
    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("row"), "text"), step, schema)


def _needed(x: str, y: str, percent: int) -> Column:
    """Grams that two sets of these sizes share if they reach the threshold."""
    total = (F.col(x) + F.col(y)) * percent
    return F.ceil(total / (100 + percent))


def _near(pairs: DataFrame, classes: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs ``x, y`` whose sizes and bitmaps allow the threshold, with ``nx, ny``.

    The pairs are read twice: only the bitmaps of classes that may be in one are moved.
    """
    ends = pairs.select(F.col("x").alias("cid")).union(pairs.select("y"))
    some = saved(rows_passing(classes, "cid", id_filter(ends, "cid")), folder)
    for side in ("x", "y"):
        known = some.select(
            F.col("cid").alias(side), F.col("n").alias(f"n{side}"), F.col("map").alias(f"m{side}")
        )
        pairs = pairs.join(known, side)
    schema = "x bigint, y bigint, nx bigint, ny bigint"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = parity_distances(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            nx, ny, need = (batch.column(i).to_numpy() for i in (2, 3, 6))
            yield pa.record_batch(batch.columns[:4], ["x", "y", "nx", "ny"]).filter(
                pa.array(apart <= nx + ny - 2 * need)
            )

    need = _needed("nx", "ny", percent).cast("bigint").alias("need")
    sized = pairs.filter(F.least("nx", "ny") >= _needed("nx", "ny", percent))
    return sized.select("x", "y", "nx", "ny", "mx", "my", need).mapInArrow(step, schema)


def partial_overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``x, y, fragment, common`` from ``x, y`` pairs and ``cid, fragment, grams`` segments.

    Repeated rows may give a segment twice, and then its overlap.
    """

    def side(name: str) -> DataFrame:
        return segments.select(
            F.col("cid").alias(name), F.col("fragment").alias(f"f{name}"), F.col("grams").alias(f"g{name}")
        )

    fragments = F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("f")
    both = (
        pairs.select("x", "y", fragments)
        .join(side("x").withColumnsRenamed({"x": "_x"}), (F.col("x") == F.col("_x")) & (F.col("f") == F.col("fx")))
        .join(side("y").withColumnsRenamed({"y": "_y"}), (F.col("y") == F.col("_y")) & (F.col("f") == F.col("fy")))
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [
                len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), True))
                for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            ]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(common, pa.int64())], ["x", "y", "fragment", "common"]
            )

    return both.select("x", "y", F.col("f").alias("fragment"), "gx", "gy").mapInArrow(
        step, "x bigint, y bigint, fragment int, common bigint"
    )


def _segments(docs: DataFrame, wanted: DataFrame, order, n: int) -> DataFrame:
    """Segments of the sets of the ``cid, rep`` classes, made from their texts."""
    bits = id_filter(wanted, "rep")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cids, fragments, grams = [], [], []
        for keys in _sets(batch, 1, order.value, n):
            limits = order.value.fragment_limits(keys)
            cid = _digest(keys)
            for i, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                if b > a:
                    cids.append(cid)
                    fragments.append(i)
                    grams.append(keys[a:b].tobytes())
        return pa.record_batch(
            [pa.array(cids, pa.int64()), pa.array(fragments, pa.int32()), pa.array(grams, pa.binary())],
            ["cid", "fragment", "grams"],
        )

    some = with_slot(docs.select(F.col("doc_id").alias("rep"), "text"), "rep")
    return arrow_map(some, step, "cid bigint, fragment int, grams binary", first=passing(bits))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order, n: int, percent: int, folder: str) -> DataFrame:
    """The pairs ``x, y, nx, ny`` that reach the threshold, as links ``a, b``."""
    ends = pairs.select(F.col("x").alias("cid")).union(pairs.select("y")).distinct()
    wanted = saved(classes.select("cid", "rep").join(ends, "cid", "left_semi"), f"{folder}-wanted")
    segments = saved(_segments(docs, wanted, order, n), f"{folder}-segments")
    common = (
        partial_overlaps(pairs.select("x", "y"), segments)
        .groupBy("x", "y", "fragment")
        .agg(F.max("common").alias("common"))
        .groupBy("x", "y")
        .agg(F.sum("common").alias("common"))
    )
    union = F.col("nx") + F.col("ny") - F.col("common")
    linked = pairs.join(common, ["x", "y"]).filter(100 * F.col("common") >= percent * union)
    return saved(linked.select(F.col("x").alias("a"), F.col("y").alias("b")), folder)


def _band(percent: int, slack: float = 1.0) -> Column:
    """Number of the band of sizes in which ``n`` lies; within one, sizes may be similar enough."""
    return F.floor(F.log(F.col("n").cast("double")) / -float(np.log(percent / 100) * slack))


def distinct_classes(signed: DataFrame, folder: str) -> tuple[DataFrame, object, DataFrame]:
    """Rows ``cid, rep, n, prefix, map``, a filter, and one row of each class that it lets pass.

    The classes are these and the rows that surely do not pass; only rows whose set may repeat are moved.
    """
    held = signed.filter("n_shingles > 0").select(
        "cid", F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "prefix", "map"
    )
    repeated = held.groupBy("cid").agg(F.count("*").alias("c")).filter("c > 1").select("cid")
    bits = id_filter(repeated, "cid")
    same = [F.first(c).alias(c) for c in ("n", "prefix", "map")]
    merged = rows_passing(held, "cid", bits).groupBy("cid").agg(F.min("rep").alias("rep"), *same)
    return held, bits, saved(merged.select(held.columns), folder)


def _sketches(facts: DataFrame) -> DataFrame:
    """``cid, sketch`` of every class."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = pa.array([sketch(m) for m in batch.column(1).to_pylist()], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), folded], ["cid", "sketch"])

    return facts.select("cid", "map").mapInArrow(step, "cid bigint, sketch array<bigint>")


def _indexed(n: str, pos: str, percent: int) -> Column:
    """Whether the smaller set of a similar pair is sure to share a gram at such a place."""
    needed = F.ceil(F.col(n) * (2 * percent) / (100 + percent))
    return F.col(pos) < F.col(n) - needed + 1


def _keyed(entries: DataFrame, percent: int) -> DataFrame:
    """The list entries with two keys: entries of one gram that may link have one in common.

    Sizes that reach the threshold lie in the same band or in neighbouring ones, so each entry
    stands under its own band and the next.
    """
    # A little wider than exact bands: rounding must not put similar sizes two bands apart.
    band = _band(percent, 1.000001)
    return entries.select("*", F.xxhash64("gram", band).alias("own"), F.xxhash64("gram", band + 1).alias("next"))


def gram_lists(held: DataFrame, repeated, merged: DataFrame, percent: int, folder: str) -> DataFrame:
    """``gram, cid, n, pos`` of the prefix grams that may link a class to another one.

    That is, another class of similar size has the gram in its prefix too, and one of them at a
    place by which the smaller set is found. The filters let too much through, never too little:
    40 bits of a gram stand for it, and lists that lie within one class link nothing.
    """
    low = F.col("gram").bitwiseAND(F.lit((1 << 40) - 1)).alias("low")

    def entries(rows: DataFrame) -> DataFrame:
        listed = rows.select("cid", "n", F.posexplode("prefix").alias("pos", "gram"))
        return listed.select("cid", "n", "pos", "gram", low)

    once = rows_passing(held.select("cid", "n", "prefix"), "cid", repeated, passes=False)
    counts = entries(once).unionByName(entries(merged)).groupBy("low").agg(F.count("*").alias("c"))
    bits = id_filter(counts.filter("c > 1"), "low", GRAM_BITS)
    shared = rows_passing_all(entries(held), [("cid", repeated, False), ("low", bits, True)])
    shared = shared.unionByName(rows_passing(entries(merged), "low", bits)).drop("low")
    shared = saved(shared, f"{folder}/shared")
    at = _indexed("n", "pos", percent).alias("at")
    keys = _keyed(shared, percent).select(at, F.explode(F.array("own", "next")).alias("key"))
    similar = keys.groupBy("key").agg(F.count("*").alias("c"), F.max("at").alias("at")).filter("c > 1 and at")
    bits = id_filter(similar, "key", GRAM_BITS)
    lists = rows_passing_any(_keyed(shared, percent), ["own", "next"], bits)
    return saved(lists.drop("own", "next"), f"{folder}/lists")


def _leaders(named: DataFrame, step: int, percent: int) -> DataFrame:
    """``x, y``: every class and the leader with which it shares most prefix grams.

    A gram has one leader for each band of sizes, another one in each step; sizes within a
    band differ by less than the threshold allows. Leaders of the same component are left out.
    """
    banded = named.withColumn("band", _band(percent))
    first = F.min_by(F.struct("cid", "root"), F.xxhash64(F.lit(step), F.col("cid"))).alias("lead")
    leaders = banded.groupBy("gram", "band").agg(first, F.count("*").alias("c")).filter("c > 1")
    led = banded.join(
        leaders.select("gram", "band", F.col("lead.cid").alias("y"), F.col("lead.root").alias("of_y")),
        ["gram", "band"],
    ).filter("root <> of_y")
    return (
        led.groupBy(F.col("cid").alias("x"), "y")
        .agg(F.count("*").alias("c"))
        .groupBy("x")
        .agg(F.max_by("y", F.struct("c", -F.col("y"))).alias("y"))
    )


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists with the ``root`` of the component of each class."""
    return lists.join(roots.withColumnRenamed("id", "cid"), "cid", "left").select(
        "gram", "cid", "n", "pos", F.coalesce("root", "cid").alias("root")
    )


def _across(named: DataFrame) -> DataFrame:
    """``gram, c``: the lists that span components, and their lengths."""
    spans = named.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("c"))
    return spans.filter("a <> b").select("gram", "c")


def _with_earlier(entries: DataFrame, sketches: DataFrame) -> DataFrame:
    """List entries with the sketch of their class and its first grams before theirs."""
    in_order = F.sort_array(F.collect_list(F.struct("pos", "gram")))
    whole = entries.groupBy("cid").agg(F.first("n").alias("n"), F.first("root").alias("root"), in_order.alias("all"))
    heads = whole.join(sketches, "cid").withColumn("head", F.slice(F.col("all.gram"), 1, EARLIER))
    return heads.select("cid", "n", "root", "sketch", "head", F.posexplode("all").alias("i", "entry")).select(
        F.col("entry.gram").alias("gram"),
        "cid",
        "n",
        F.col("entry.pos").alias("pos"),
        "root",
        "sketch",
        F.slice("head", F.lit(1), F.least("i", F.lit(EARLIER))).alias("earlier"),
    )


def classes_and_links(docs: DataFrame, n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (``doc_id, row, n_shingles, cid``), classes and the links that join components."""
    spark = docs.sparkSession
    folder = scratch(spark, "jaccard")
    order = spark.sparkContext.broadcast(global_order(docs, n))
    signed = saved(_signatures(docs, order, n, percent), f"{folder}/signatures")
    rows = signed.select("doc_id", "row", "n_shingles", "cid")
    held, repeated, merged = distinct_classes(signed, f"{folder}/merged")
    known = rows_passing(held.drop("prefix"), "cid", repeated, passes=False).unionByName(merged.drop("prefix"))
    facts = saved(known, f"{folder}/classes")
    lists = gram_lists(held, repeated, merged, percent, folder)

    roots, found = None, []
    led, named = lists, lists.withColumn("root", F.col("cid"))
    for step in range(LEADER_ROUNDS):
        best = saved(_leaders(named, step, percent), f"{folder}/best{step}")
        near = saved(_near(best, facts, percent, f"{folder}/maps{step}"), f"{folder}/near{step}")
        if not near.take(1):
            break
        found.append(_verified(near, docs, facts, order, n, percent, f"{folder}/links{step}"))
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        roots = components(links, f"{folder}/components{step}")
        if step == 0:
            long = _across(_rooted(lists, roots)).filter(F.col("c") > LONG_LIST)
            led = saved(rows_passing(lists, "gram", id_filter(long, "gram", GRAM_BITS)), f"{folder}/long")
        named = saved(_rooted(led, roots), f"{folder}/named{step}")
    named = saved(_rooted(lists, roots), f"{folder}/named") if roots else named
    across = rows_passing(named, "gram", id_filter(_across(named), "gram", GRAM_BITS))
    across = saved(_with_earlier(across, _sketches(facts)), f"{folder}/across")
    # The smaller set is found by a shorter prefix.
    sides = {"cid": "c", "n": "n", "pos": "p", "root": "r", "sketch": "s", "earlier": "e"}
    x = across.select("gram", *(F.col(c).alias(f"{a}x") for c, a in sides.items()))
    y = across.select("gram", *(F.col(c).alias(f"{a}y") for c, a in sides.items()))
    need = _needed("nx", "ny", percent)
    room = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    pairs = (
        x.filter(_indexed("nx", "px", percent))
        .join(y, "gram")
        .filter(
            (F.col("rx") != F.col("ry"))
            & ((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("cx") < F.col("cy"))))
            & (100 * F.col("nx") >= percent * F.col("ny"))
            & (room >= need)
            & (sketch_distance("sx", "sy") <= F.col("nx") + F.col("ny") - 2 * need)
            & ~F.arrays_overlap("ex", "ey")
        )
        .select(F.col("cx").alias("x"), F.col("cy").alias("y"))
        .distinct()
    )
    pairs = saved(pairs, f"{folder}/pairs")
    last = saved(_near(pairs, facts, percent, f"{folder}/maps"), f"{folder}/near")
    links = _verified(last, docs, facts, order, n, percent, f"{folder}/links")
    for more in found:
        links = links.unionByName(more)
    return rows, facts, links


def groups(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; ``row`` and ``group`` name them."""
    rows, classes, links = classes_and_links(docs, n, percent)
    folder = scratch(docs.sparkSession, "groups")
    roots = saved(components(links, f"{folder}/components"), f"{folder}/roots")
    placed = classes.select("cid", "rep").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
    placed = placed.select("cid", "rep", F.coalesce("root", "cid").alias("group"))
    least = placed.groupBy("group").agg(F.min("rep").alias("component_id"))
    named = saved(placed.join(least, "group").select("cid", "group", "component_id"), f"{folder}/named")
    alone = F.col("n_shingles") == 0
    joined = rows.join(named.withColumnRenamed("cid", "_c"), F.col("cid") == F.col("_c"), "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "row",
        F.when(~alone, F.col("group")).alias("group"),
    )


def one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id.

    Only texts that may have to go, or whose row may be there twice, are moved.
    """
    found = saved(groups(docs, n, percent), f"{scratch(docs.sparkSession, 'kept')}/groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("r")
    grouped = found.filter(F.col("group").isNotNull())
    best = grouped.groupBy(F.col("group").alias("_group")).agg(first)
    kept = best.select(F.col("r.doc_id").alias("_id"), F.col("r.row").alias("_row"))
    rows = grouped.groupBy("group", "doc_id", "row").agg(F.count("*").alias("c"))
    is_best = F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("row") == F.col("r.row"))
    unsure = rows.join(best, F.col("group") == F.col("_group")).filter((F.col("c") > 1) | ~is_best)
    bits = id_filter(unsure.select(F.xxhash64("doc_id", "row").alias("key")), "key")
    columns = {f"_c{i}": name for i, name in enumerate(docs.columns)}
    held = docs.select(
        *(F.col(f"`{old}`").alias(new) for new, old in columns.items()),
        F.col("doc_id").cast("bigint").alias("_doc"),
        F.xxhash64("text").alias("_mine"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("_key"),
    )
    text = f"_c{docs.columns.index('text')}"
    empty = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) == 0
    moved = rows_passing(held, "_key", bits).withColumn("_empty", empty)
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_row"))
    some = moved.filter(~F.col("_empty")).join(kept, same, "left_semi").dropDuplicates(["_doc", "_mine"])
    own = [F.col(new).alias(old) for new, old in columns.items()]
    return (
        rows_passing(held, "_key", bits, passes=False).select(*own)
        .unionByName(some.select(*own))
        .unionByName(moved.filter("_empty").select(*own))
    )
