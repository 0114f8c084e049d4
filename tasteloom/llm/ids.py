"""A fixed-size filter of ids, to move only the texts that a later join can need."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2 MB, whatever the number of ids. When ids outgrow it, it lets more
#: rows through; the exact join that follows decides.
BITS = 1 << 24


def _slot(column: Column | str, size: int = BITS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(size))


def id_filter(ids: DataFrame, column: str, size: int = BITS):
    """Broadcast ``size`` bits of all ids; the driver gets at most size / 64 rows."""
    slot = _slot(column, size)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
    rows = (
        ids.select(F.floor(slot / 64).cast("int").alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(size // 64, np.int64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def with_slot(docs: DataFrame, column: str) -> DataFrame:
    return docs.withColumn("_slot", _slot(column))


def passing(shared, passes: bool = True) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """For batches ``with_slot``: the rows whose id may be in the filter, or surely is not."""

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = shared.value
        slot = batch.column(batch.num_columns - 1).to_numpy()
        inside = bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == int(passes)
        named = pa.record_batch(batch.columns[:-1], batch.schema.names[:-1])
        return named.filter(pa.array(inside))

    return kept


def rows_passing(docs: DataFrame, column: str, shared, passes: bool = True) -> DataFrame:
    """The rows whose id may be in the filter, or surely is not, before a shuffle."""
    keep = passing(shared, passes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(keep, batches)

    slotted = docs.withColumn("_slot", _slot(column, shared.value.size * 64))
    return slotted.mapInArrow(run, docs.schema)


def rows_passing_any(docs: DataFrame, columns: list[str], shared) -> DataFrame:
    """The rows of which one id at least may be in the filter."""
    size = shared.value.size * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = np.zeros(batch.num_rows, bool)
            for column in batch.columns[-len(columns) :]:
                slot = column.to_numpy()
                inside |= shared.value[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == 1
            own = batch.columns[: -len(columns)]
            yield pa.record_batch(own, batch.schema.names[: len(own)]).filter(pa.array(inside))

    slots = [_slot(column, size).alias(f"_slot{i}") for i, column in enumerate(columns)]
    return docs.select("*", *slots).mapInArrow(run, docs.schema)


def rows_passing_all(docs: DataFrame, tests: list[tuple]) -> DataFrame:
    """The rows that meet every ``(column, filter, passes)``, in one pass through Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            for column, (_, shared, passes) in zip(batch.columns[-len(tests) :], tests, strict=True):
                slot = column.to_numpy()
                bit = shared.value[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)
                kept &= bit == int(passes)
            own = batch.columns[: -len(tests)]
            yield pa.record_batch(own, batch.schema.names[: len(own)]).filter(pa.array(kept))

    slots = [_slot(column, shared.value.size * 64).alias(f"_slot{i}") for i, (column, shared, _) in enumerate(tests)]
    return docs.select("*", *slots).mapInArrow(run, docs.schema)
