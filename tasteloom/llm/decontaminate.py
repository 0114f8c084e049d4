"""Benchmark decontamination with suffix arrays over shards of the training texts.

Every task turns its documents into shards: the words of some megabytes of text and a
suffix array over them. The suffixes of the benchmark items are binary-searched in every
shard. What they share verbatim with a document, from the window length on, is a match;
matches that go on from word to word are joined, so each reported match is the longest.

A window is ``window`` consecutive words of an item; an item of fewer words is one window.
The array of a shard holds only suffixes that begin like some benchmark suffix (its first
words), since no other can be found, and is sorted as deep as the window: longer matches
are runs of windows. There is no shuffle, and documents are read once.

The benchmark is the stated query set. It goes to the tasks in blocks of ``BLOCK_BYTES``;
with more than one block the documents pass through one scan for each.

Defined cases: a null or empty text has no words and is never contaminated; a null or empty
item has no window; repeated items count once by ``item_id``; a null ``item_id`` is written
as an empty string; every document row is judged by itself, whatever its id; other columns
are not read. Empty tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm import words as W
from tasteloom.llm.base import slices

WINDOW = 13
#: Text bytes of benchmark items that go to a task at once.
BLOCK_BYTES = 8 << 20
#: Words of a suffix that are looked up before it enters the array.
STEM = 4
#: Benchmark suffixes that are searched at once.
SEARCH_ROWS = 1 << 15

MATCHES = "doc_id bigint, item_id string, doc_pos bigint, item_pos bigint, n_words bigint"
REPORT = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "contaminated boolean"
)


@dataclass
class Suffixes:
    """Benchmark suffixes of one window length: sorted distinct windows and their places."""

    length: int
    windows: np.ndarray  # (n, length) word hashes
    stems: np.ndarray  # sorted hashes of their first words
    which: np.ndarray  # window of every place, ascending
    place: np.ndarray  # word position in the block, ascending within a window


@dataclass
class Block:
    ids: list[str]
    item: np.ndarray  # item of every word of the block
    first: np.ndarray  # first word of every item
    groups: list[Suffixes]


def _stem(length: int) -> int:
    return min(STEM, length)


def block_of(ids: list[str], texts: list[str | None], window: int) -> Block:
    found = W.words(pa.array(texts, pa.string()), W.ALPHANUMERIC)
    counts, item = found.counts(), W.row_of(found.rows)
    need = np.minimum(counts, window)[item]
    left = found.rows[1:][item] - np.arange(len(item))
    groups = []
    for length in np.unique(need):
        place = np.flatnonzero((need == length) & (left >= length))
        rows = found.hashes[place[:, None] + np.arange(length)]
        windows, which = np.unique(rows, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        stems = np.unique(W.grams(windows[:, : _stem(length)].ravel(), _stem(length))[:: _stem(length)])
        groups.append(Suffixes(int(length), windows, stems, which.ravel()[order], place[order]))
    return Block(ids, item, found.rows[:-1], groups)


class SuffixArray:
    """Suffixes of one shard that begin with a stem, in the order of their first words."""

    def __init__(self, found: W.Words, length: int, stems: np.ndarray):
        k = _stem(length)
        grams = W.grams(found.hashes, k)
        mask = np.uint64((1 << 20) - 1)
        seen = np.zeros(1 << 20, bool)
        seen[stems & mask] = True
        at = np.flatnonzero(seen[grams & mask] & W.inside_rows(found.rows, length)[: len(grams)])
        slot = np.minimum(np.searchsorted(stems, grams[at]), len(stems) - 1)
        at = at[stems[slot] == grams[at]]
        keys = found.hashes[at[:, None] + np.arange(length)]
        order = np.lexsort(keys.T[::-1])
        self.at, self.keys = at[order], keys[order]

    def _bound(self, queries: np.ndarray, after_equal: bool) -> np.ndarray:
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.at))
        rows = np.arange(len(queries))
        while (low < high).any():
            middle = np.minimum((low + high) // 2, len(self.at) - 1)
            there = self.keys[middle]
            differs = there != queries
            column = differs.argmax(1)
            equal = ~differs[rows, column]
            right = (there[rows, column] < queries[rows, column]) | (equal & after_equal)
            right &= low < high
            high = np.where(right | (low >= high), high, middle)
            low = np.where(right, middle + 1, low)
        return low

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, position in the shard) of all places where a window begins."""
        which, place = [], []
        for at in range(0, len(windows) if len(self.at) else 0, SEARCH_ROWS):
            part = windows[at : at + SEARCH_ROWS]
            low, high = self._bound(part, False), self._bound(part, True)
            n = high - low
            which.append(at + np.repeat(np.arange(len(part)), n))
            place.append(self.at[_ranges(low, n)])
        empty = np.zeros(0, np.int64)
        return (np.concatenate(which), np.concatenate(place)) if which else (empty, empty)


def _ranges(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... n[0] of them, then those of starts[1], ..."""
    before = np.cumsum(n) - n
    return np.arange(n.sum()) - np.repeat(before - starts, n)


def longest_matches(found: W.Words, block: Block) -> np.ndarray:
    """Rows (document row, item, word in the document, word in the item, words)."""
    out = []
    row = W.row_of(found.rows)
    for group in block.groups:
        array = SuffixArray(found, group.length, group.stems)
        which, at = array.search(group.windows)
        first = np.searchsorted(group.which, which, "left")
        n = np.searchsorted(group.which, which, "right") - first
        at, there = np.repeat(at, n), group.place[_ranges(first, n)]
        if not len(at):
            continue
        order = np.lexsort((at, there - at))
        at, there = at[order], there[order]
        # A window one word further on in the same item and document goes on with the match.
        begins = np.ones(len(at), bool)
        begins[1:] = (
            (np.diff(there - at) != 0)
            | (np.diff(at) != 1)
            | (np.diff(row[at]) != 0)
            | (np.diff(block.item[there]) != 0)
        )
        starts = np.flatnonzero(begins)
        length = np.diff(np.append(starts, len(at))) + group.length - 1
        at, there = at[starts], there[starts]
        item = block.item[there]
        out.append(
            np.stack([row[at], item, at - found.rows[row[at]], there - block.first[item], length], 1)
        )
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """Broadcast blocks of the benchmark; the driver holds one block at a time."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    spark = benchmark.sparkSession
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = -(-total // block_bytes) or 1
    out = []
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part
        rows = items.filter(mine).collect() if parts > 1 else items.collect()
        block = block_of([r["item"] for r in rows], [r["text"] for r in rows], window)
        out.append(spark.sparkContext.broadcast(block))
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All longest matches with their places: ``doc_id, item_id, doc_pos, item_pos, n_words``."""
    found = None
    for shared in _blocks(benchmark, window, block_bytes):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in slices(batches):
                rows = longest_matches(W.words(batch.column(1), W.ALPHANUMERIC), block)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows[:, 0])),
                        pa.array([block.ids[i] for i in rows[:, 1]], pa.string()),
                        *(pa.array(rows[:, i], pa.int64()) for i in (2, 3, 4)),
                    ],
                    ["doc_id", "item_id", "doc_pos", "item_pos", "n_words"],
                )

        part = docs.select("doc_id", "text").mapInArrow(scan, MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def _union(spans: np.ndarray) -> np.ndarray:
    """Disjoint ascending spans that cover what the given (start, end) rows cover."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], 1)


def _scanned(docs: DataFrame, shared, window: int, last: bool) -> DataFrame:
    """Add one block's spans and items to those so far; the last block makes the report."""
    kept = [f for f in docs.schema.fields if f.name != "_spans" and f.name != "_items"]
    names = [f.name for f in kept]
    state = "_spans binary, _items array<string>"
    report = REPORT.split(", ", 1)[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in slices(batches, "_text"):
            at = {name: batch.schema.get_field_index(name) for name in batch.schema.names}
            found = W.words(batch.column(at["_text"]), W.ALPHANUMERIC)
            rows = longest_matches(found, block)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            limits = np.searchsorted(rows[:, 0], np.arange(batch.num_rows + 1))
            old = batch.column(at["_spans"]).to_pylist()
            old_items = batch.column(at["_items"]).to_pylist()
            spans, items = [], []
            for i in range(batch.num_rows):
                mine = rows[limits[i] : limits[i + 1]]
                if not len(mine) and not old[i]:
                    spans.append(np.zeros((0, 2), np.int64))
                    items.append(old_items[i])
                    continue
                before = np.frombuffer(old[i], np.int64).reshape(-1, 2)
                new = np.stack([mine[:, 2], mine[:, 2] + mine[:, 4]], 1)
                spans.append(_union(np.concatenate([before, new])))
                items.append(sorted({*old_items[i], *(block.ids[j] for j in mine[:, 1])}))
            if last:
                n = found.counts()
                hit = np.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], np.int64)
                digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
                more = [
                    pa.array(n, pa.int64()),
                    pa.array(hit),
                    pa.array([len(i) for i in items], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array((hit > 0) & (20 * hit >= n)),
                ]
                named = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
            else:
                more = [
                    pa.array([s.tobytes() for s in spans], pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                ]
                named = ["_spans", "_items"]
            left = [name for name in names if not last or name != "_text"]
            out = [batch.column(at[name]) for name in left]
            named = [f"_new_{name}" for name in named] if last else named
            yield pa.record_batch(out + more, left + named)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept if not last or f.name != "_text"]
    if last:
        fields += [f"_new_{field}" for field in report.split(", ")]
    else:
        fields.append(state)
    return docs.mapInArrow(scan, ", ".join(fields))


def _scan_all(
    docs: DataFrame, benchmark: DataFrame, columns: dict[str, str], window: int, block_bytes: int
) -> DataFrame:
    """``columns`` (new name to column) are carried along beside what the scan finds."""
    out = docs.select(
        *(F.col(f"`{old}`").alias(new) for new, old in columns.items()),
        F.col("text").alias("_text"),
        F.lit(b"").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    blocks = _blocks(benchmark, window, block_bytes)
    for shared in blocks:
        out = _scanned(out, shared, window, shared is blocks[-1])
    return out


def report(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: words, hit words, items with a match and the verdict."""
    found = _scan_all(docs, benchmark, {"doc_id": "doc_id"}, window, block_bytes)
    names = [field.split(" ")[0] for field in REPORT.split(", ")[1:]]
    return found.select("doc_id", *(F.col(f"_new_{name}").alias(name) for name in names))


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    columns = {f"_c{i}": name for i, name in enumerate(docs.columns)}
    found = _scan_all(docs, benchmark, columns, window, block_bytes)
    return found.filter(~F.col("_new_contaminated")).select(
        *(F.col(new).alias(old) for new, old in columns.items())
    )
