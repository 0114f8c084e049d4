"""All-pairs cosine similarity, kept whole without listing every pair.

Items with equal vectors form one *class*, named after its lowest item id. A
similarity product is a ``SimilarityIndex``: which item is in which class, and which
classes are more similar than the threshold (a class of several items is linked to
itself with score 1). That is the complete answer, but copies cost nothing: a group
of n equal items is n membership rows instead of n * (n - 1) pairs. Exact top-k
lists, counts, lookups and the full list of chosen items all come from the index.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.functions import l2_norm
from tasteloom.operators.pruning import Regions, regions, with_region
from tasteloom.operators.ranking import chunk_of, ranked, top_per_key
from tasteloom.sources.blocks import REPORT, collected, reported, work_folder
from tasteloom.sources.files import opened, written
from tasteloom.sources.tables import Store, settled


@dataclass(frozen=True)
class SimilarityIndex:
    members: DataFrame  # mid, cls, n (items in cls)
    links: DataFrame  # cls, sim_cls, score, n (items in sim_cls); both directions
    #: The links with their ``rank`` in the list of ``cls`` and ``own`` (items in cls), if known.
    lists: DataFrame | None = None

    def settled(self, store: Store | None, name: str) -> SimilarityIndex:
        """Write the two tables and go on from them.

        They are not range-sorted: that would run the pair comparison twice, once for
        the sample of the key range.
        """
        members = settled(self.members, store, f"{name}Members")
        if self.lists is None:
            return SimilarityIndex(members, settled(self.links, store, f"{name}Links"))
        return _with_lists(members, settled(self.lists, store, f"{name}Links"))

    def members_of(self, items: DataFrame) -> DataFrame:
        """At least the members rows of the given ``mid``; here all, the join picks them."""
        return self.members

    def members_in(self, classes: DataFrame) -> DataFrame:
        """At least the members of the given ``cls``."""
        return self.members

    def links_of(self, classes: DataFrame) -> DataFrame:
        """At least the links of the given ``cls``."""
        return self.links

    def above(self, score: float) -> SimilarityIndex:
        """The index without links of ``score`` or less."""
        lists = None if self.lists is None else self.lists.filter(F.col("score") > score)
        return replace(self, links=self.links.filter(F.col("score") > score), lists=lists)

    def _others(self) -> Column:
        """Items that a link leads to: an item is not similar to itself."""
        return F.col("n") - (F.col("cls") == F.col("sim_cls")).cast("int")

    def _to_members(self, per_class: DataFrame) -> DataFrame:
        """Give rows made per class to all items of the class.

        Rows that are grouped by class stay where they are. Only for a large class they move: it
        is cut into parts of its items, and its rows are repeated for each part. AQE would
        not split it, because the other side is grouped by the join key.
        """
        one_part = _parts(F.col("n")) == 1
        whole = self.members.filter(one_part).select("mid", "cls")
        large = self.members.filter(~one_part)
        own = large.select("cls", F.col("n").alias("size")).distinct()
        last = _parts(F.col("size")) - 1
        repeated = (
            per_class.join(own, "cls")
            .withColumn("part", F.explode(F.sequence(F.lit(0), last)))
            .drop("size")
        )
        part = F.pmod(F.xxhash64("mid"), _parts(F.col("n"))).cast("int")
        items = large.select("mid", "cls", part.alias("part"))
        return whole.join(per_class, "cls").unionByName(items.join(repeated, ["cls", "part"]).drop("part"))

    def neighbours(self) -> DataFrame:
        """The uncapped lists: ``mid, rank, sim_cls, score, n_similar``, best class first.

        One row per item and similar class; ``n_similar`` other items share the score.
        Ranks are the same for all items of a class and are made once per class.
        """
        if self.lists is None:
            rows = self._to_members(ranked(self.links, "cls", [F.desc("score"), F.asc("sim_cls")]))
        else:
            # A class of one item is named after it: its list needs no look-up.
            several = replace(self, members=self.members.filter("n > 1"))
            rows = self.lists.filter("own = 1").withColumn("mid", F.col("cls"))
            rows = rows.unionByName(several._to_members(self.lists.filter("own > 1")))
        return rows.select("mid", "rank", "sim_cls", "score", self._others().alias("n_similar"))

    def counts(self) -> DataFrame:
        """How many similar items each item has: ``mid, n_similar``."""
        totals = self.links.groupBy("cls").agg(F.sum(self._others()).alias("n_similar"))
        return self._to_members(totals).select("mid", "n_similar")

    def top(self, k: int) -> DataFrame:
        """Exact top-k lists: ``mid, rank, sim_mid, score``.

        The first k + 1 classes of a class, and the first k + 1 items of each of those,
        already hold the first k + 1 items of its list, one of which may be the item
        itself. So the list is made once per class and only then given to its items.
        """
        near = ranked(self.links, "cls", [F.desc("score"), F.asc("sim_cls")], k + 1)
        heads = ranked(self.members, "cls", [F.asc("mid")], k + 1).select(
            F.col("cls").alias("sim_cls"), F.col("mid").alias("sim_mid")
        )
        entries = near.drop("rank").join(heads, "sim_cls").select("cls", "sim_mid", "score")
        best = ranked(entries, "cls", [F.desc("score"), F.asc("sim_mid")], k + 1)
        entry = F.struct("rank", "sim_mid", "score")
        lists = best.groupBy("cls").agg(F.array_sort(F.collect_list(entry)).alias("list"))
        others = F.slice(F.filter("list", lambda e: e["sim_mid"] != F.col("mid")), 1, k)
        return (
            self._to_members(lists)
            .select("mid", F.posexplode(others).alias("at", "e"))
            .select("mid", (F.col("at") + 1).alias("rank"), "e.sim_mid", "e.score")
        )

    def similar_to(self, mids: DataFrame) -> DataFrame:
        """Full lists of the given items: ``mid, sim_mid, score``.

        The result is as long as the lists are. Large classes are joined chunk by chunk
        of their id range, so no join key stands for more than one chunk of items.
        """
        chunked = self.members.select(
            F.col("cls").alias("sim_cls"), F.col("mid").alias("sim_mid"), chunk_of("mid").alias("chunk")
        )
        parts = chunked.select("sim_cls", "chunk").distinct()
        near = mids.select("mid").distinct().join(self.members, "mid").join(self.links, "cls")
        return (
            near.join(parts, "sim_cls")
            .join(chunked, ["sim_cls", "chunk"])
            .filter(F.col("mid") != F.col("sim_mid"))
            .select("mid", "sim_mid", "score")
        )

    def ordered_lists(self, mids: DataFrame) -> DataFrame:
        """Full lists of the given items in order: ``mid, rank, sim_mid, score``."""
        full = top_per_key(self.similar_to(mids), "mid", None, item="sim_mid")
        return full.select("mid", "rank", "sim_mid", "score")

    def lookup(self, pairs: DataFrame, left: str, right: str) -> DataFrame:
        """The pairs that are in the index, with their ``score``, in this direction."""
        wanted = [pairs.select(F.col(side).alias("mid")) for side in (left, right)]
        own = self.members_of(wanted[0]).select(F.col("mid").alias(left), F.col("cls"))
        other = self.members_of(wanted[1]).select(
            F.col("mid").alias(right), F.col("cls").alias("sim_cls")
        )
        placed = pairs.filter(F.col(left) != F.col(right)).join(own, left).join(other, right)
        links = self.links_of(placed.select("cls")).drop("n")
        return placed.join(links, ["cls", "sim_cls"]).drop("cls", "sim_cls")


def _with_lists(members: DataFrame, lists: DataFrame) -> SimilarityIndex:
    return SimilarityIndex(members, lists.select("cls", "sim_cls", "score", "n"), lists)


PART_ITEMS = 1 << 16


def _parts(items: Column) -> Column:
    """Into how many parts a class of so many items is cut."""
    return F.ceil(items / PART_ITEMS).cast("int")


def index_of_pairs(pairs: DataFrame) -> SimilarityIndex:
    """An index over given ``mid, sim_mid, score`` rows; every item is its own class.

    The direction of the rows is kept. A pair given more than once counts once, with
    its highest score.
    """
    links = pairs.groupBy(
        F.col("mid").alias("cls"), F.col("sim_mid").alias("sim_cls")
    ).agg(F.max("score").alias("score"), F.lit(1).cast("bigint").alias("n"))
    both = pairs.select(F.explode(F.array("mid", "sim_mid")).alias("mid")).distinct()
    one = F.lit(1).cast("bigint").alias("n")
    return SimilarityIndex(both.select("mid", F.col("mid").alias("cls"), one), links)


def recs_as_map(nested: DataFrame) -> DataFrame:
    """``mid, recs`` lists as ``mid, scores MAP<mid, score>``; of repeated ids the last wins.

    Items with an empty list have no row.
    """
    entries = nested.select("mid", F.posexplode("recs").alias("at", "r"))
    last = entries.groupBy("mid", F.col("r.mid").alias("other")).agg(
        F.max_by("r.score", "at").alias("score")
    )
    entry = F.struct("other", "score")
    return last.groupBy("mid").agg(F.map_from_entries(F.collect_list(entry)).alias("scores"))


def _rounded(score: Column, digits: int | None) -> Column:
    return score if digits is None else F.round(score, digits)


def _own_links(classes: DataFrame, threshold: float) -> DataFrame:
    """The link of every class of several items to itself."""
    return classes.filter((F.col("n") > 1) & F.lit(1.0 > threshold)).select(
        "cls", F.col("cls").alias("sim_cls"), F.lit(1.0).alias("score"), "n"
    )


# --- sparse vectors ---------------------------------------------------------------


def term_counts(tokens: Column) -> Column:
    """Tokens of one text as a sorted ``ARRAY<STRUCT<term, tf>>``; no shuffle needed."""
    return F.transform(
        F.array_sort(F.array_distinct(tokens)),
        lambda t: F.struct(
            t.alias("term"), F.size(F.filter(tokens, lambda x: x == t)).cast("double").alias("tf")
        ),
    )


def document_classes(docs: DataFrame) -> DataFrame:
    """``mid, terms`` to one row per distinct term-count array: ``terms, cls, n``.

    Grouping is on the counts, which are exact; weights could differ in the last bit.
    """
    return docs.groupBy("terms").agg(F.min("mid").alias("cls"), F.count("*").alias("n"))


def inverse_frequencies(classes: DataFrame) -> DataFrame:
    """``term, df, idf`` with ``idf = ln((N + 1) / (df + 1))``."""
    documents = classes.agg(F.sum("n")).scalar()
    return (
        classes.select("n", F.inline("terms"))
        .groupBy("term")
        .agg(F.sum("n").alias("df"))
        .withColumn("idf", F.log((documents + 1) / (F.col("df") + 1)))
    )


def _unit_vectors(classes: DataFrame) -> DataFrame:
    """``cls, n, vec`` with unit weights, rarest term first.

    Terms that all documents have weigh nothing and drop out, and so do vectors with no
    other terms.
    """
    weighted = (
        classes.select("cls", "n", F.inline("terms"))
        .join(inverse_frequencies(classes).filter("idf > 0"), "term")
        .groupBy("cls", "n")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("df", "term", (F.col("tf") * F.col("idf")).alias("w")))
            ).alias("raw")
        )
        .withColumn("norm", l2_norm(F.col("raw.w")))
        .filter("norm > 0")
    )
    unit = F.transform(
        "raw", lambda x: F.struct(x["term"].alias("term"), (x["w"] / F.col("norm")).alias("w"))
    )
    return weighted.select("cls", "n", unit.alias("vec"))


SLACK = 1e-9


def _prefix_rows(vectors: DataFrame, least: float) -> DataFrame:
    """One row per vector and term that it has to share for a cosine above ``least``.

    With the terms in one global order, the part of a unit vector after its prefix is at
    most ``least`` long. Two vectors with no prefix term in common share terms only
    in that part of one of them, so their cosine cannot exceed it. Terms that very many
    vectors have come last in the order and are light, so they are seldom in a prefix.

    Columns: ``cls, n, term, w``; ``earlier`` (the terms before this one), ``later`` (terms
    and weights after it), ``rest`` (the length of ``later``) and ``bits`` (one of 64
    bits for each term of ``later``).
    """

    def bit(term: Column) -> Column:
        place = F.pmod(F.xxhash64(term), F.lit(64)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    def square_sum(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0.0), lambda total, x: total + x["w"] * x["w"])

    at = vectors.select("cls", "n", "vec", F.posexplode("vec").alias("at", "x"))
    later = F.slice(F.col("vec"), F.col("at") + 2, F.size("vec"))
    rows = at.select(
        "cls",
        "n",
        F.col("x.term").alias("term"),
        F.col("x.w").alias("w"),
        F.slice(F.col("vec.term"), F.lit(1), F.col("at")).alias("earlier"),
        later.alias("later"),
        F.sqrt(square_sum(later)).alias("rest"),
        F.aggregate(
            later, F.lit(0).cast("bigint"), lambda bits, x: bits.bitwiseOR(bit(x["term"]))
        ).alias("bits"),
    )
    return rows.filter(F.hypot("w", "rest") > least)


def sparse_index(
    docs: DataFrame,
    threshold: float,
    digits: int | None = None,
    store: Store | None = None,
    name: str = "Sparse",
) -> SimilarityIndex:
    """Exact TF-IDF cosine above ``threshold`` over ``mid, terms`` rows.

    ``digits`` rounds the scores, before they meet the threshold. With a ``store`` the
    steps that are read more than once, and the index itself, become tables in it.
    """
    if threshold < 0:
        raise ValueError("a negative threshold would also admit pairs without a common term")
    # Lower than any cosine that can still pass: bounds may be off in the last bits, and
    # rounding may lift a score above the threshold.
    least = threshold - SLACK - (0 if digits is None else 0.5 * 10**-digits)
    classes = settled(document_classes(docs), store, f"{name}Classes")
    rows = settled(_prefix_rows(_unit_vectors(classes), least), store, f"{name}Prefixes")
    left = rows.withColumnRenamed("cls", "a")
    right = rows.select(
        F.col("cls").alias("b"),
        F.col("n").alias("other_n"),
        "term",
        F.col("w").alias("other_w"),
        F.col("earlier").alias("other_earlier"),
        F.map_from_entries("later").alias("other_later"),
        F.col("rest").alias("other_rest"),
        F.col("bits").alias("other_bits"),
    )
    # A pair that shares several prefix terms is taken at the first of them only, so all
    # its other common terms come later in both. That bounds the cosine, before it is
    # computed, by the lengths of the later parts; no common bit means no common term.
    here = F.col("w") * F.col("other_w")
    apart = F.col("bits").bitwiseAND(F.col("other_bits")) == 0
    bound = here + F.when(apart, 0.0).otherwise(F.col("rest") * F.col("other_rest"))
    first = ~F.arrays_overlap("earlier", "other_earlier")
    product = F.aggregate(
        "later",
        here,
        lambda total, x: total
        + x["w"] * F.coalesce(F.try_element_at("other_later", x["term"]), F.lit(0.0)),
    )
    pairs = (
        left.join(right, "term")
        .filter((F.col("a") < F.col("b")) & (bound > least) & first)
        .select("a", "b", "n", "other_n", _rounded(product, digits).alias("score"))
        .filter(F.col("score") > threshold)
    )
    both_ways = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("a").alias("cls"), F.col("b").alias("sim_cls"), "score",
                    F.col("other_n").alias("n"),
                ),
                F.struct(F.col("b").alias("cls"), F.col("a").alias("sim_cls"), "score", "n"),
            )
        )
    )
    # Every vector keeps its first term, so these are the classes that have a length.
    own = _own_links(rows.filter(F.size("earlier") == 0).select("cls", "n"), threshold)
    members = docs.join(classes, "terms").select("mid", "cls", "n")
    return SimilarityIndex(members, both_ways.unionByName(own)).settled(store, name)


# --- dense vectors ----------------------------------------------------------------

TILE_BYTES = 16 << 20
STRIP_ROWS = 256
#: Rows of a block at most: what a product costs follows the rows of both, not their bytes.
BLOCK_ROWS = 1 << 15
#: Entries of a row that are looked at together for its best ones.
CHUNK = 64
MAX_TILE_PARTITIONS = 20_000


def block_count(rows: int, dim: int, parallelism: int) -> int:
    """Blocks of at most 16 MB and ``BLOCK_ROWS`` rows, and enough of them to use the cluster."""
    by_size = math.ceil(rows * dim * 4 / TILE_BYTES)
    by_cores = min(math.ceil(rows / 512), math.ceil(math.sqrt(2 * parallelism)))
    return max(1, by_size, math.ceil(rows / BLOCK_ROWS), by_cores)


def row_floors(scores: np.ndarray, k: int) -> np.ndarray:
    """A score that at least ``k`` entries of each row reach: the k-th of the best of chunks."""
    whole = scores.shape[1] // CHUNK * CHUNK
    if whole // CHUNK < k:
        return np.partition(scores, -k, axis=1)[:, -k]
    heads = scores[:, :whole].reshape(len(scores), -1, CHUNK).max(2)
    return np.partition(heads, -k, axis=1)[:, -k]


def _best_entries(at: np.ndarray, scores: np.ndarray, keep: int) -> np.ndarray:
    """Which entries of rows ``at`` (ascending) are level with the keep-th best of their row."""
    order = np.lexsort((-scores, at))
    first = np.searchsorted(at, at)  # where an entry's row begins, in either order
    size = np.searchsorted(at, at, side="right") - first
    floor = scores[order][np.minimum(first + keep, first + size) - 1]
    return scores >= floor


#: Unit vectors of a block: ids, class sizes, vectors in double and in single precision.
Units = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _units(rows: pa.Table) -> Units:
    ids, sizes = rows.column("cls").to_numpy(), rows.column("n").to_numpy()
    norms = rows.column("norm").to_numpy()
    flat = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(len(ids), -1).astype(np.float64) / norms[:, None]
    return ids, sizes, vectors, vectors.astype(np.float32)


def _links(*columns: np.ndarray) -> pa.RecordBatch:
    schema = pa.schema(
        [("cls", pa.int64()), ("sim_cls", pa.int64()), ("score", pa.float64()), ("n", pa.int64())]
    )
    return pa.RecordBatch.from_arrays([pa.array(values) for values in columns], schema=schema)


def _strip(
    left: Units,
    right: Units,
    start: int,
    threshold: float,
    digits: int | None,
    keep: int | None,
    floors: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and scores of the links of ``STRIP_ROWS`` rows from ``start``.

    Products in single precision rule pairs out; what is left is decided in double. Scores
    below ``floors`` (one for each row of ``left``) are left out too.
    """
    (ids, _, vectors, rough), (other_ids, _, others, other_rough) = left, right
    # Of unit vectors; sums of so many products, and the vectors themselves, are rounded.
    error = (vectors.shape[1] + 4) * 2.0**-23
    unit = 0.0 if digits is None else 10.0**-digits
    scores = rough[start : start + STRIP_ROWS] @ other_rough.T
    least = np.float32(threshold - unit - error)
    # One entry more: a vector itself may be among them.
    if keep is not None and keep + 1 < scores.shape[1] and (floors is None or not (floors > threshold).all()):
        least = np.maximum(least, row_floors(scores, keep + 1) - np.float32(2 * error + unit))[:, None]
    if floors is not None:
        least = np.maximum(least, (floors - (2 * error + unit)).astype(np.float32)[:, None])
    at, to = np.nonzero(scores >= least)
    exact = np.einsum("ij,ij->i", vectors[start + at], others[to])
    if digits is not None:
        exact = np.round(exact, digits)
    wanted = (exact > threshold) & (ids[start + at] != other_ids[to])
    if floors is not None:
        wanted &= exact >= floors[at]
    at, to, exact = at[wanted], to[wanted], exact[wanted]
    if keep is not None and len(at):
        # Everything level with the keep-th best stays, so ties are not cut here.
        best = _best_entries(at, exact, keep)
        at, to, exact = at[best], to[best], exact[best]
    return start + at, to, exact


def _tile_multiplier(threshold: float, digits: int | None, keep: int | None):
    """The links of a pair of blocks."""

    def strips(left: Units, right: Units, both_ways: bool) -> Iterator[pa.RecordBatch]:
        (ids, sizes, *_), (other_ids, other_sizes, *_) = left, right
        for start in range(0, len(ids), STRIP_ROWS):
            at, to, exact = _strip(left, right, start, threshold, digits, keep)
            yield _links(ids[at], other_ids[to], exact, other_sizes[to])
            if both_ways:
                yield _links(other_ids[to], ids[at], exact, sizes[at])

    def multiply(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        low, high = (k.as_py() for k in key)
        left = _units(rows.filter(pc.equal(rows.column("block"), low)))
        if low == high:
            yield from strips(left, left, False)
            return
        right = _units(rows.filter(pc.equal(rows.column("block"), high)))
        if len(left[0]) and len(right[0]):
            yield from strips(left, right, keep is None)
            if keep is not None:
                yield from strips(right, left, False)

    return multiply


def _best_of_rows(
    left: Units, rights: Iterator[Units], threshold: float, digits: int | None, keep: int
) -> pa.RecordBatch:
    """The links of rows that are level with the keep-th best of their row over all blocks."""
    ids = left[0]
    best = np.full((len(ids), keep), -np.inf)
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    for right in rights:
        parts = [found]
        for start in range(0, len(ids), STRIP_ROWS):
            floors = best[start : start + STRIP_ROWS, -1]
            at, to, exact = _strip(left, right, start, threshold, digits, keep, floors)
            parts.append((at, right[0][to], exact, right[1][to]))
            rows = np.unique(at)
            if len(rows):
                every = np.concatenate([np.repeat(rows, keep), at])
                scores = np.concatenate([best[rows].ravel(), exact])
                order = np.lexsort((-scores, every))
                place = np.arange(len(every)) - np.searchsorted(every[order], every[order])
                best[rows] = scores[order[place < keep]].reshape(-1, keep)
        found = tuple(np.concatenate(side) for side in zip(*parts, strict=True))
        level = found[2] >= best[found[0], -1]
        found = tuple(side[level] for side in found)
    return _links(ids[found[0]], *found[1:])


def vector_classes(
    vectors: DataFrame, store: Store | None, name: str
) -> tuple[DataFrame, DataFrame, int]:
    """Rows of vectors with a length, their classes (``vec, norm, cls, n``) and the dimension."""
    usable = vectors.filter(F.size("vec") > 0).withColumn("norm", l2_norm("vec"))
    usable = usable.filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    classes = usable.groupBy("vec", "norm").agg(
        F.min("mid").alias("cls"), F.count("*").alias("n")
    )
    classes = settled(classes, store, f"{name}Classes")
    sizes = classes.agg(F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first()
    if sizes["a"] != sizes["b"]:
        raise ValueError(f"vectors of {sizes['a']} and of {sizes['b']} numbers have no cosine")
    return usable, classes, sizes["a"] or 1


#: Links of the lists that are made at the same time, if a list is not longer itself.
LIST_LINKS = 1 << 22
LIST_ROWS = 1 << 10


def _lists_of_rows(
    left: Units, rights: Callable[[], Iterator[Units]], threshold: float, digits: int | None
) -> Iterator[pa.RecordBatch]:
    """The whole lists of rows, in order and with ranks, a bounded number of links at a time.

    As many rows as their lists leave room for meet all blocks together; if there turn out to be
    too many links, the last rows wait for the next time.
    """
    ids, sizes = left[:2]
    start, size = 0, LIST_ROWS
    while start < len(ids):
        end = min(start + size, len(ids))
        own = np.flatnonzero(sizes[start:end] > 1) + start if threshold < 1 else np.zeros(0, np.int64)
        parts, count = [(own.astype(np.int32), ids[own], np.ones(len(own)), sizes[own])], len(own)
        for right in rights():
            first = start
            while first < end:
                at, to, exact = _strip(left, right, first, threshold, digits, None)
                parts.append((at.astype(np.int32), right[0][to], exact, right[1][to]))
                count += len(at)
                first += STRIP_ROWS
                while count > LIST_LINKS and end > start + 1:
                    end = start + (end - start) // 2
                    parts = [tuple(side[part[0] < end] for side in part) for part in parts]
                    count = sum(len(part[0]) for part in parts)
        at, others, scores, n = (np.concatenate(side) for side in zip(*parts, strict=True))
        kept = at < end
        at, others, scores, n = at[kept], others[kept], scores[kept], n[kept]
        order = np.lexsort((others, -scores, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at) + 1
        columns = (ids[at], others[order], scores[order], n[order], rank.astype(np.int32), sizes[at])
        for first in range(0, len(at), LINK_ROWS):
            some = [pa.array(values[first : first + LINK_ROWS]) for values in columns]
            yield pa.RecordBatch.from_arrays(some, names=["cls", "sim_cls", "score", "n", "rank", "own"])
        size = max(1, end - start) * (2 if count < LIST_LINKS // 4 else 1)
        start = end


#: Links of one Arrow batch.
LINK_ROWS = 1 << 16


#: The blocks that a block meets, as spans of their numbers.
Spans = list[tuple[int, int]]


def _placed(classes: DataFrame, found: Regions, dim: int, blocks: int) -> tuple[DataFrame, list[Spans]]:
    """Every class with its ``block``, and the blocks that each block meets."""
    total = max(1, int(found.sizes.sum()))
    largest = max(1, min(math.ceil(total / blocks), TILE_BYTES // (dim * 4), BLOCK_ROWS))
    parts = [math.ceil(size / largest) for size in found.sizes.tolist()]
    first = np.concatenate([[0], np.cumsum(parts)]).tolist()
    held = [p > 0 for p in parts]
    # All that is per region or pair of regions is bounded by the number of pivots.
    near = [
        [(first[b], first[b + 1] - 1) for b in np.nonzero(row)[0].tolist() if held[a] and held[b]]
        for a, row in enumerate(found.near)
    ]
    table = [(a, first[a], max(1, parts[a])) for a in range(len(parts))]
    placed = with_region(classes.select("cls", "n", "vec", "norm"), found.pivots).join(
        F.broadcast(classes.sparkSession.createDataFrame(table, "region int, start int, parts int")), "region"
    )
    block = (F.col("start") + F.pmod(F.xxhash64("cls"), F.col("parts"))).cast("int")
    meets = [near[a] for a, count in enumerate(parts) for _ in range(count)]
    return placed.select("cls", "n", "vec", "norm", block.alias("block")), meets


def _met(spark: SparkSession, meets: list[Spans]) -> DataFrame:
    """``block, others``: the numbers of the blocks that a block meets."""
    rows = spark.createDataFrame(list(enumerate(meets)), "block int, near array<struct<a int, b int>>")
    others = F.flatten(F.transform("near", lambda span: F.sequence(span["a"], span["b"])))
    return rows.select("block", others.alias("others"))


def _tiles(classes: DataFrame, found: Regions, dim: int, blocks: int) -> tuple[DataFrame, int]:
    """Every class once for each product it takes part in (``low, high`` blocks), and their number."""
    placed, meets = _placed(classes, found, dim, blocks)
    pairs = F.transform(
        "others",
        lambda other: F.struct(
            F.least(F.col("block"), other).alias("low"), F.greatest(F.col("block"), other).alias("high")
        ),
    )
    tiled = placed.join(_met(classes.sparkSession, meets), "block").select(
        "cls", "n", "vec", "norm", "block", F.inline(pairs)
    )
    return tiled, _products(meets)


def _products(meets: list[Spans]) -> int:
    """Pairs of blocks that meet, each once."""
    return max(1, sum(max(0, b + 1 - max(a, at)) for at, spans in enumerate(meets) for a, b in spans))


def _in_files(placed: DataFrame, blocks: int) -> list[str]:
    """The path of each block's vectors, empty where there are none."""
    folder = work_folder(placed.sparkSession)

    def write(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, rows.schema) as out:
            out.write_table(rows)
        block = key[0].as_py()
        yield reported(block, written(folder, f"{block}.arrow", iter([sink.getvalue()])), rows.num_rows, 0)

    wrote = placed.repartitionById(blocks, F.col("block")).groupBy("block").applyInArrow(write, REPORT)
    return list(collected(wrote, blocks).paths)


def _read(path: str) -> pa.Table:
    with opened(path) as file:
        return pa.ipc.open_file(file).read_all()


def _links_of_rows(paths: list[str], parts: int, threshold: float, digits: int | None, keep: int | None):
    """The links, or with ``keep`` the best ones, of some rows of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if not (path := paths[row["block"]]):
                    continue
                left = _units(_read(path))
                left = tuple(side[row["part"] :: parts] for side in left)
                others = [paths[other] for other in row["others"] if paths[other]]

                def rights(others: list[str] = others) -> Iterator[Units]:
                    return (_units(_read(other)) for other in others)

                if keep is None:
                    yield from _lists_of_rows(left, rights, threshold, digits)
                else:
                    yield _best_of_rows(left, rights(), threshold, digits, keep)

    return run


def dense_index(
    vectors: DataFrame,
    threshold: float,
    digits: int | None = None,
    keep: int | None = None,
    blocks: int | None = None,
    store: Store | None = None,
    name: str = "Dense",
) -> SimilarityIndex:
    """Exact cosine above ``threshold`` over ``mid, vec`` rows (``vec ARRAY<FLOAT>``).

    Distinct vectors are dealt by region (``pruning``), within a region by hash, into blocks of
    bounded size, each one file. Every pair of blocks whose regions can hold a pair above the
    threshold is compared; the others are skipped. A task compares rows of one block with all blocks
    near it, one file after the other, so that a list is whole and ranked where it is made and
    no link is shuffled. ``keep=k`` passes on only what is among the first k classes of a list:
    enough for ``top(k - 1)``, while links and counts are then no longer complete.
    """
    spark = vectors.sparkSession
    usable, classes, dim = vector_classes(vectors, store, name)
    if blocks is None:
        blocks = block_count(classes.count(), dim, spark.sparkContext.defaultParallelism)
    # A rounded score passes from half a unit of its last digit below the threshold.
    least = threshold if digits is None else threshold - 0.5 * 10.0**-digits
    found = regions(classes, least, blocks)
    if len(found.pivots):
        placed, meets = _placed(classes.withColumn("cls", F.col("cls").cast("bigint")), found, dim, blocks)
        paths = _in_files(placed, len(meets))
    else:
        meets, paths = [[(0, 0)]], [""]
    # Parts of a block's rows, so that every core has some.
    parts = math.ceil(2 * spark.sparkContext.defaultParallelism / len(meets))
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    tasks = _met(spark, meets).select("block", "others", part)
    tasks = tasks.repartitionById(len(meets) * parts, F.col("block") * parts + F.col("part"))
    schema = "cls bigint, sim_cls bigint, score double, n bigint"
    if keep is None:
        schema += ", rank int, own bigint"
    id_type = vectors.schema["mid"].dataType
    links = tasks.mapInArrow(_links_of_rows(paths, parts, threshold, digits, keep), schema).withColumns(
        {name: F.col(name).cast(id_type) for name in ("cls", "sim_cls")}
    )
    members = usable.join(classes, ["vec", "norm"]).select("mid", "cls", "n")
    if keep is None:
        return _with_lists(members, links).settled(store, name)
    return SimilarityIndex(members, links.unionByName(_own_links(classes, threshold))).settled(store, name)
