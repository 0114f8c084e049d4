"""Incremental, reversible line dedup: cuckoo filters over exact reference counts.

The state has two tables in a shared folder, both cut into shards by line key:

* ``refs``: how many documents hold each line key (exact);
* ``filters``: one cuckoo filter per shard of the keys that ``min_docs`` or more documents
  hold.

``insert`` and ``delete`` add and take away the lines of documents. Keys that cross the
limit on the way enter the filter of their shard or leave it, which cuckoo filters can do;
so deleting what was inserted gives the former state back. ``screen`` asks the filters
about the lines of documents, checks the hits in ``refs`` and drops the lines found.

A line key is the line without white space at its ends, A-Z as a-z, held as two 64-bit
hashes. Empty keys are never counted or dropped.

Every state is a new version in a new folder; earlier versions stay as they were, so a lost
executor or a failed update loses nothing. Work on a shard is cut into groups of
``GROUP_ROWS`` rows by document, so a line that is everywhere fills many groups.

Defined cases: a null or empty text is one empty line; every document row counts as a
document, repeated rows too; rows with a null or repeated ``doc_id`` are each screened by
their own lines; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.llm.base import arrow_map, saved, scratch

MIN_DOCS = 10
#: Keys that a shard's filter is made for when the state is built.
SHARD_KEYS = 100_000
#: Lines of one shard that are looked up in one group.
GROUP_ROWS = 200_000
SPACES = b" \t\n\x0b\x0c\r"
SLOTS = 4


class FilterFull(RuntimeError):
    """A shard has outgrown its filter; it is built anew from the exact counts."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; an entry is in one of two buckets."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for ``keys`` entries at a load of at most 0.8."""
        buckets = 1 << max(4, int(keys / (0.8 * SLOTS)).bit_length())
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def loaded(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def dumped(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (h2.astype(np.uint64) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)
        size = np.uint64(len(self.table) - 1)
        first = (h1.astype(np.uint64) >> np.uint64(20)) & size
        return mark, first.astype(np.int64), self._other(first.astype(np.int64), mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        jump = mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)
        return bucket ^ (jump & np.uint64(len(self.table) - 1)).astype(np.int64)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(h1, h2)
        mark = mark[:, None]
        return (self.table[first] == mark).any(1) | (self.table[second] == mark).any(1)

    def _placed(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put entries into free slots of their buckets; which of them found one."""
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_bucket, sorted_bucket)
        free = self.table[sorted_bucket] == 0
        fits = rank < free.sum(1)
        slot = (np.cumsum(free, 1) == (rank + 1)[:, None]).argmax(1)
        self.table[sorted_bucket[fits], slot[fits]] = mark[order][fits]
        out = np.zeros(len(mark), bool)
        out[order[fits]] = True
        return out

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> None:
        mark, bucket, second = self._places(h1, h2)
        left = ~self._placed(mark, bucket)
        mark, bucket = mark[left], second[left]
        draw = np.random.default_rng(7)
        for _ in range(500):
            left = ~self._placed(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return
            # One entry per full bucket takes a slot; the entry it drives out moves on.
            _, one = np.unique(bucket, return_index=True)
            slot = draw.integers(0, SLOTS, len(one))
            driven = self.table[bucket[one], slot]
            self.table[bucket[one], slot] = mark[one]
            mark[one] = driven
            bucket[one] = self._other(bucket[one], driven)
        raise FilterFull

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        mark, first, second = self._places(h1, h2)
        for m, a, b in zip(mark, first, second, strict=True):
            for bucket in (a, b):
                slots = np.flatnonzero(self.table[bucket] == m)
                if len(slots):
                    self.table[bucket, slots[0]] = 0
                    break


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def key_hashes(key: bytes) -> tuple[int, int]:
    one, two = xxhash.xxh64_intdigest(key, 0), xxhash.xxh64_intdigest(key, 1)
    return one - (1 << 64) * (one >> 63), two - (1 << 64) * (two >> 63)


def _lines(docs: DataFrame) -> DataFrame:
    """``_doc, h1, h2``: the distinct line keys of every document row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, ones, twos = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            keys = {line_key(line) for line in (text or "").encode().split(b"\n")}
            keys.discard(b"")
            for key in keys:
                one, two = key_hashes(key)
                rows.append(i)
                ones.append(one)
                twos.append(two)
        at = pa.array(rows, pa.int64())
        return pa.record_batch(
            [batch.column(0).take(at), pa.array(ones, pa.int64()), pa.array(twos, pa.int64())],
            ["_doc", "h1", "h2"],
        )

    picked = docs.select(F.col("doc_id").alias("_doc"), "text")
    return arrow_map(picked, step, "_doc bigint, h1 bigint, h2 bigint")


@dataclass(frozen=True)
class LineIndex:
    """One version of the state; updates give a new one."""

    folder: str
    version: int
    shards: int
    min_docs: int

    @classmethod
    def empty(cls, spark: SparkSession, min_docs: int = MIN_DOCS) -> LineIndex:
        return cls(scratch(spark, "lines"), 0, 1, min_docs)

    def _path(self, table: str) -> str:
        return f"{self.folder}/v{self.version}/{table}"

    def refs(self, spark: SparkSession) -> DataFrame:
        schema = "h1 bigint, h2 bigint, n bigint"
        if self.version == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._path("refs"))

    def filters(self, spark: SparkSession) -> DataFrame:
        schema = "shard int, keys bigint, filter binary"
        if self.version == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._path("filters"))

    def _shard(self):
        return F.pmod(F.col("h1"), F.lit(self.shards)).cast("int")

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._updated(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take the lines of documents away that were inserted before."""
        return self._updated(docs, -1)

    def _updated(self, docs: DataFrame, sign: int) -> LineIndex:
        spark = docs.sparkSession
        new = replace(self, version=self.version + 1)
        change = _lines(docs).groupBy("h1", "h2").agg((F.count("*") * sign).alias("change"))
        # Both sides have one row per key, so no key is hot here.
        merged = saved(
            self.refs(spark)
            .select("h1", "h2", "n", F.lit(0).cast("bigint").alias("change"))
            .unionByName(change.select("h1", "h2", F.lit(0).cast("bigint").alias("n"), "change"))
            .groupBy("h1", "h2")
            .agg(F.sum("n").alias("before"), (F.sum("n") + F.sum("change")).alias("n")),
            new._path("merged"),
        )
        merged.filter("n > 0").select("h1", "h2", "n").write.parquet(new._path("refs"))
        limit = self.min_docs
        crossed = merged.filter(f"(before >= {limit}) <> (n >= {limit})").select(
            "h1", "h2", (F.col("n") >= limit).alias("enters")
        )
        sizes = new.refs(spark).filter(F.col("n") >= limit).groupBy(new._shard().alias("s")).count()
        most = sizes.agg(F.max("count")).first()[0] or 0
        if self.version == 0 or most > SHARD_KEYS * 2:
            return new._rebuilt(spark)
        try:
            new._write_filters(crossed, self.filters(spark))
        except Exception as error:
            if FilterFull.__name__ not in str(error):
                raise
            return replace(new, folder=new.folder)._rebuilt(spark, again=True)
        return new

    def _rebuilt(self, spark: SparkSession, again: bool = False) -> LineIndex:
        """Filters from the exact counts, with as many shards as the keys need."""
        keys = self.refs(spark).filter(F.col("n") >= self.min_docs)
        new = replace(self, shards=-(-keys.count() // SHARD_KEYS) or 1)
        if again:
            new = replace(new, version=self.version + 1)
            self.refs(spark).write.parquet(new._path("refs"))
        new._write_filters(keys.select("h1", "h2", F.lit(True).alias("enters")), None)
        return new

    def _write_filters(self, crossed: DataFrame, old: DataFrame | None) -> None:
        spark = crossed.sparkSession

        def step(keys: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
            if len(before):
                state, held = CuckooFilter.loaded(before["filter"].iloc[0]), before["keys"].iloc[0]
                shard = before["shard"].iloc[0]
            else:
                state, held, shard = CuckooFilter.sized(len(keys)), 0, keys["shard"].iloc[0]
            h1, h2 = keys["h1"].to_numpy(np.int64), keys["h2"].to_numpy(np.int64)
            enters = keys["enters"].to_numpy(bool)
            state.delete(h1[~enters], h2[~enters])
            state.insert(h1[enters], h2[enters])
            held = held + enters.sum() - (~enters).sum()
            return pd.DataFrame({"shard": [shard], "keys": [held], "filter": [state.dumped()]})

        schema = "shard int, keys bigint, filter binary"
        before = spark.createDataFrame([], schema) if old is None else old
        keyed = crossed.withColumn("shard", self._shard())
        (
            keyed.groupBy("shard")
            .cogroup(before.groupBy("shard"))
            .applyInPandas(step, schema)
            .write.parquet(self._path("filters"))
        )

    def found(self, docs: DataFrame) -> DataFrame:
        """``_doc, h1, h2``: the line keys of documents that ``min_docs`` documents hold."""
        spark = docs.sparkSession
        sizes = self.refs(spark).groupBy(self._shard().alias("shard")).agg(F.sum("n").alias("rows"))
        groups = saved(
            self.filters(spark)
            .select("shard")
            .join(sizes, "shard")
            .select("shard", F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("groups")),
            f"{self._path('groups')}-{scratch(spark, 'g').rpartition('-')[2]}",
        )
        asked = (
            _lines(docs)
            .withColumn("shard", self._shard())
            .join(groups, "shard")
            .select(
                "_doc",
                "h1",
                "h2",
                "shard",
                F.pmod(F.xxhash64("_doc"), F.col("groups")).cast("int").alias("part"),
            )
        )
        filters = (
            self.filters(spark)
            .join(groups, "shard")
            .select("shard", "filter", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
        )

        def step(lines: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            if not len(lines) or not len(state):
                return lines[["_doc", "h1", "h2"]].iloc[:0]
            has = CuckooFilter.loaded(state["filter"].iloc[0]).has(
                lines["h1"].to_numpy(np.int64), lines["h2"].to_numpy(np.int64)
            )
            return lines.loc[has, ["_doc", "h1", "h2"]]

        hits = (
            asked.groupBy("shard", "part")
            .cogroup(filters.groupBy("shard", "part"))
            .applyInPandas(step, "_doc bigint, h1 bigint, h2 bigint")
        )
        exact = self.refs(spark).filter(F.col("n") >= self.min_docs).select("h1", "h2")
        return hits.join(exact, ["h1", "h2"], "left_semi")

    def screen(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_lines, n_dropped, kept`` with the text that is left."""
        drops = self.found(docs).groupBy("_doc").agg(
            F.collect_set(F.struct("h1", "h2")).alias("_drops")
        )
        joined = docs.select("doc_id", "text").join(
            drops, F.col("doc_id").eqNullSafe(F.col("_doc")), "left"
        )

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines, dropped, kept = [], [], []
            for text, drops in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows = (text or "").encode().split(b"\n")
                lines.append(len(rows))
                if drops:
                    gone = {(d["h1"], d["h2"]) for d in drops}
                    rows = [r for r in rows if key_hashes(line_key(r)) not in gone]
                dropped.append(lines[-1] - len(rows))
                kept.append(b"\n".join(rows).decode())
            return pa.record_batch(
                [
                    batch.column(0),
                    pa.array(lines, pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

        return arrow_map(
            joined.select("doc_id", "text", "_drops"),
            step,
            "doc_id bigint, n_lines bigint, n_dropped bigint, kept string",
        )


def digest(screened: DataFrame) -> DataFrame:
    return screened.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


