"""What the operators share: scratch tables, word tables and Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tasteloom.plans.session import checkpoint_folder

#: Text bytes that one slice of an Arrow batch may hold; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bytes of rows that Spark may put into one Arrow batch; its own limit counts rows.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit for Arrow batches if it is higher than texts allow."""
    if int(spark.conf.get(_BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the folder that all executors share."""
    bounded_batches(spark)
    return f"{checkpoint_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and go on from the files: the steps above run once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece stay under ``most`` bytes."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = utf8(column)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; a null row is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def arrow_map(
    df: DataFrame,
    step: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    text: str = "text",
    first: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """``mapInArrow`` over pieces of bounded size; ``first`` is done to whole batches before."""

    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(map(first, batches) if first else batches, text):
            yield step(piece)

    return df.mapInArrow(run, schema)
