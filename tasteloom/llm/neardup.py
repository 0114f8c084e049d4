"""Near duplicates among embeddings: cross-polytope hashing with several probes.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its
hash is the axis, with sign, that it then lies closest to. Three such hashes make a bucket.
Each vector is filed in its own bucket of every table and probes the next likely ones, so
two vectors meet where one's own bucket is among the other's. Pairs that meet are compared
in double precision; a pair that meets in several buckets counts in the first of them.

Equal vectors are one class with a count. Buckets in which nobody meets are found from
codes alone, so only vectors with a neighbour travel. A bucket of any size is cut into
blocks, and each pair of blocks is one matrix product that gives sums and a spanning
forest, never the list of its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.base import bounded_batches, saved, scratch
from tasteloom.llm.components import components

THRESHOLD = 0.93
#: Tables, hashes in a bucket's name and buckets looked up in each table. For vectors of 64
#: numbers at a cosine of 0.93 two meet in a table with probability 0.48, in any with 0.994;
#: a table has 128**3 buckets then, so that few unrelated vectors meet.
TABLES = 8
HASHES = 3
PROBES = 4
#: Axes that a probe may take instead of the closest one.
NEXT_AXES = 4
#: Vectors in a block of a bucket, and those multiplied at once.
BLOCK = 4096
STRIP = 256
#: Pairs whose first meeting is looked for at once.
PAIRS = 1 << 15
_SEED = 11


# --- hashing ----------------------------------------------------------------------


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, keeping lengths; 2**k columns."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
        rows = rows.reshape(n, width)
        step *= 2
    return rows / np.sqrt(width)


@cache
def _signs(width: int, which: int) -> np.ndarray:
    return np.random.default_rng([_SEED, width, which]).choice([-1.0, 1.0], (3, width))


def rotated(rows: np.ndarray, which: int) -> np.ndarray:
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    for signs in _signs(width, which):
        rows = hadamard(rows * signs)
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def codes(rows: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Per row the bucket of each table and its probes, likeliest first: (rows, tables * probes)."""
    axes = min(NEXT_AXES, 2 * rows.shape[1])
    choices = np.array(list(itertools.product(range(axes), repeat=hashes)))
    out = []
    for table in range(tables):
        cost = np.zeros((len(rows), len(choices)))
        name = np.zeros((len(rows), len(choices)), np.int64)
        for k in range(hashes):
            turned = rotated(rows, table * hashes + k)
            both = np.concatenate([turned, -turned], axis=1)
            near = np.argsort(-both, axis=1, kind="stable")[:, :axes]
            far = np.take_along_axis(both, near, 1)
            cost += ((far[:, :1] - far) ** 2)[:, choices[:, k]]
            name = name * both.shape[1] + near[:, choices[:, k]]
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out.append(np.take_along_axis(name, best, 1))
    return np.concatenate(out, axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _coded(tables: int, hashes: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                found = codes(unit(_matrix(part.column("vec"), dim)), tables, hashes, probes)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1])
                yield pa.record_batch(
                    [*part.columns, listed.cast(pa.list_(pa.int64()))], [*part.schema.names, "codes"]
                )

    return run


# --- comparing --------------------------------------------------------------------


class _Sets:
    """Union-find over the rows of one product."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.parent[a], self.parent[b]
        apart = a != b
        for x, y in np.unique(np.stack([a[apart], b[apart]], 1), axis=0).tolist():
            x, y = self._root(x), self._root(y)
            self.parent[max(x, y)] = min(x, y)
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            x = self.parent[x]
        return x


def meets_first(
    a: np.ndarray, b: np.ndarray, table: int, code: int, probes: int
) -> np.ndarray:
    """Whether pairs of code rows meet in this bucket and in none before it."""
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        at = slice(t * probes, (t + 1) * probes)
        own_a, own_b = a[:, t * probes], b[:, t * probes]
        a_met = (own_a[:, None] == b[:, at]).any(1)
        b_met = (own_b[:, None] == a[:, at]).any(1)
        if t < table:
            first &= ~(a_met | b_met)
        else:
            first &= ~(a_met & (own_a < code)) & ~(b_met & (own_b < code))
    return first


@dataclass
class _Rows:
    """Rows of many products, in the order of their keys."""

    keys: np.ndarray
    cls: np.ndarray
    n: np.ndarray
    own: np.ndarray
    block: np.ndarray
    vectors: np.ndarray
    names: np.ndarray

    @staticmethod
    def of(table: pa.Table, dim: int) -> _Rows:
        def numbers(name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        keys = np.stack([label, *(numbers(k) for k in _KEYS[2:])], 1)
        vectors = unit(_matrix(table.column("vec").combine_chunks(), dim))
        codes_ = table.column("codes").combine_chunks()
        names = _matrix(codes_, len(codes_[0]))
        parts = (numbers(c) for c in ("cls", "n", "own", "block"))
        return _Rows(keys, *parts, vectors, names)


_KEYS = ["label", "dim", "table", "code", "low", "high"]


def _product(rows: _Rows, at: slice, threshold: float, probes: int):
    """``cls, links, other`` of a product's linked rows; each row is in one of two blocks."""
    _, table, code, low, high = rows.keys[at.start].tolist()
    cls, n, own, block = rows.cls[at], rows.n[at], rows.own[at], rows.block[at]
    vectors, names = rows.vectors[at], rows.names[at]
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    links, sets = np.zeros(len(cls), np.int64), _Sets(len(cls))
    for start in range(0, len(left), STRIP):
        some = left[start : start + STRIP]
        close = vectors[some] @ vectors[right].T >= threshold
        close &= own[some][:, None] | own[right][None, :]
        i, j = np.nonzero(close)
        i, j = some[i], right[j]
        if low == high:
            ordered = i < j
            i, j = i[ordered], j[ordered]
        for first in range(0, len(i), PAIRS):
            x, y = i[first : first + PAIRS], j[first : first + PAIRS]
            here = meets_first(names[x], names[y], table, code, probes)
            x, y = x[here], y[here]
            links += np.bincount(x, n[y], len(cls)).astype(np.int64)
            links += np.bincount(y, n[x], len(cls)).astype(np.int64)
            sets.join(x, y)
    linked = np.flatnonzero(links)
    return cls[linked], links[linked], cls[sets.parent[linked]]


def _compared(threshold: float, probes: int):
    """All products of a partition that is sorted by their keys, a batch of rows at a time."""

    def products(table: pa.Table, whole: bool) -> tuple[pa.RecordBatch, pa.Table]:
        """The products of a table; its last one may go on, so it is left unless ``whole``."""
        dims = table.column("dim").to_numpy()
        found, begin = [], 0
        for end in [*(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]:
            rows = _Rows.of(table.slice(begin, end - begin), int(dims[begin]))
            edges = (np.flatnonzero((rows.keys[1:] != rows.keys[:-1]).any(1)) + 1).tolist()
            edges = [0, *edges, end - begin]
            last = end == len(dims) and not whole
            for at, to in zip(edges, edges[1:-1] if last else edges[1:]):
                found.append(_product(rows, slice(at, to), threshold, probes))
            begin += edges[-2] if last else edges[-1]
        columns = [np.concatenate(c) if found else [] for c in zip(*found)] or [[], [], []]
        out = pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["cls", "links", "other"])
        return out, table.slice(begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            out, rest = products(table, whole=False)
            yield out
        if rest is not None:
            yield products(rest, whole=True)[0]

    return run


# --- the operator -----------------------------------------------------------------


def comparable(vector: str = "embedding", label: str = "label") -> Column:
    """A label, and finite numbers that are not all zero."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & whole, F.lit(False))


def links(
    classes: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    block: int = BLOCK,
    folder: str | None = None,
) -> DataFrame:
    """``cls, links, other`` of ``cls, label, vec, n`` rows: sums over the pairs that each
    product found first, and a member of the same component for each."""
    folder = folder or scratch(classes.sparkSession, "neardup")
    sized = classes.select("cls", "label", "n", "vec", F.size("vec").alias("dim"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in sized.dtypes)
    coded = saved(
        sized.mapInArrow(_coded(tables, hashes, probes), f"{kinds}, codes array<bigint>"),
        f"{folder}/coded",
    )
    table = F.floor(F.col("at") / probes).cast("int")
    filed = coded.select("cls", "label", "dim", F.posexplode("codes").alias("at", "code")).select(
        "cls",
        "at",
        # A short name for counting who meets whom; products go by the bucket itself.
        F.xxhash64("label", "dim", table, "code").alias("bucket"),
    )
    own = F.col("at") % probes == 0
    # Only buckets with a vector of their own and another one hold pairs.
    met = saved(
        filed.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.count_if(own).alias("owned"))
        .filter("owned > 0 AND size > 1")
        .drop("owned"),
        f"{folder}/met",
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = saved(
        filed.join(met, "bucket").select("cls", "at", own.alias("own"), blocks.alias("blocks")),
        f"{folder}/placed",
    )
    place = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least("block", other).alias("low"), F.greatest("block", other).alias("high")
        ),
    )
    work = (
        placed.join(coded, "cls")
        .withColumns(
            {"table": table, "code": F.get("codes", F.col("at")), "block": place}
        )
        .select("cls", "n", "own", "block", "vec", "codes", *_KEYS[:4], F.inline(tiles))
    )
    ordered = work.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return saved(
        ordered.mapInArrow(
            _compared(threshold, probes), "cls bigint, links bigint, other bigint"
        ),
        f"{folder}/found",
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``.

    Vectors are compared if their labels are equal and not null and they are equally long.
    Null, empty and zero vectors and those with null or non-finite numbers link with
    nothing: they are components of their own. Repeated rows are rows of their own that link
    with each other. Rows without a vec_id take part; the id of their component is the
    smallest one that is not null, and they are never kept. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    folder = scratch(spark, "neardup")
    bounded_batches(spark)
    good = comparable()
    # 128 bits name a vector.
    named = vectors.select("vec_id", "label", "embedding", good.alias("good")).select(
        "*", *[F.when(F.col("good"), F.xxhash64(F.lit(i), "embedding")).alias(f"h{i}") for i in (1, 2)]
    )
    same = ["label", "h1", "h2"]
    classes = saved(
        named.filter("good")
        .groupBy(*same)
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("vec"))
        .withColumn("cls", F.monotonically_increasing_id()),
        f"{folder}/classes",
    )
    found = links(
        classes.select("cls", "label", "n", "vec"), threshold, tables, hashes, probes, block, folder
    )
    roots = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")), folder)
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    rooted = saved(
        classes.select(*same, "cls", "id", "n")
        .join(roots.withColumnRenamed("id", "cls"), "cls", "left")
        .join(sums, "cls", "left")
        .select(
            *same,
            "id",
            F.coalesce("root", "cls").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        f"{folder}/rooted",
    )
    least = saved(rooted.groupBy("root").agg(F.min("id").alias("component_id")), f"{folder}/least")
    judged = saved(
        rooted.join(least, "root").select(*same, "n_links", "component_id"), f"{folder}/judged"
    )
    linked = named.filter("good").select("vec_id", *same).join(judged, same)
    alone = named.filter("NOT good").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return rows.withColumn("kept", kept)
