"""Mixing sources to target weights by repeating documents.

The words of every source are summed and its target found; target over size is the
repetition rate of the source. A document is emitted floor(rate) times, and once more if a
draw seeded by its id falls under the rest of the rate. The draw is the same in every run.

Targets: the sources, in code point order with null last, weigh 5, 2, 1, 5, 2, ... and share
the sum of all sizes. No target may pass ``MOST`` times its source's size; what is over is
shared by weight among the others until none is over. That is done on exact sums in rounds,
each a small aggregate, so the number of sources is not limited by one task: they are
numbered by range partitions.

Defined cases: a null or empty text has size 0; a null source is a source of its own;
repeated rows each count, and rows of one ``doc_id`` share their draw; sources without
words get target 0; an empty table gives an empty mix. Other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasteloom.llm import words as W
from tasteloom.llm.base import arrow_map, saved, scratch

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
#: Digits of the draw: 13 hex digits are 52 bits, exact in a double.
_HEX = 13


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the key alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("double") / float(16**_HEX)


def sizes(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, source, size`` of every document row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = W.words(batch.column(2), W.SPACED).counts() if batch.num_rows else np.zeros(0)
        return pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "size"]
        )

    return arrow_map(
        docs.select("doc_id", "source", "text"), step, "doc_id bigint, source string, size bigint"
    )


def _numbered(sources: DataFrame, folder: str) -> DataFrame:
    """Add ``number``, from 0, in code point order of the source, null last."""
    parts = saved(
        sources.withColumn("_last", F.col("source").isNull())
        .repartitionByRange(F.col("_last"), F.col("source"))
        .sortWithinPartitions("_last", "source")
        .withColumn("_part", F.spark_partition_id()),
        f"{folder}/ranges",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy("_last", "source")
    return (
        parts.withColumn("_at", F.row_number().over(inside))
        .join(offsets, "_part")
        .select("source", "source_size", (F.col("_offset") + F.col("_at") - 1).alias("number"))
    )


def targets(sized: DataFrame, folder: str, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, target, rate``, one row per source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")
    )
    sources = saved(
        _numbered(by_source, folder).withColumn("weight", weight.cast("bigint")), f"{folder}/sources"
    )
    limit = MOST * F.col("source_size")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    rest, share = total, None
    while True:
        # What is left goes by weight to the sources whose limit it does not pass.
        over = F.lit(False) if share is None else limit * F.lit(share) < F.lit(rest) * F.col("weight")
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("share"),
        ).first()
        if (total - row["full"], row["share"]) == (rest, share):
            break
        rest, share = total - row["full"], row["share"]
    open_target = F.lit(rest) * F.col("weight") / F.lit(max(share, 1))
    return sources.withColumn(
        "target", F.when(over, limit.cast("double")).otherwise(open_target.cast("double"))
    ).withColumn(
        "rate",
        F.when(over, F.lit(float(MOST)))
        .when(F.col("source_size") == 0, F.lit(0.0))
        .otherwise(F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))),
    )


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(key, seed) < rate - whole).cast("bigint")).cast("bigint")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per document row: its size, its source's size and target, and the words taken."""
    folder = scratch(docs.sparkSession, "mix")
    sized = saved(sizes(docs), f"{folder}/sizes")
    known = saved(targets(sized, folder, weights), f"{folder}/targets").withColumnRenamed("source", "_s")
    joined = sized.join(known, F.col("source").eqNullSafe(F.col("_s")))
    n = copies(F.col("rate"), F.col("doc_id"))
    return joined.select(
        "doc_id", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix: every document as often as it is taken, with the columns it had."""
    folder = scratch(docs.sparkSession, "mix")
    known = saved(targets(sizes(docs), folder, weights), f"{folder}/targets").select(
        F.col("source").alias("_s"), F.col("rate").alias("_rate")
    )
    n = copies(F.col("_rate"), F.col("_doc"))
    columns = {f"_c{i}": name for i, name in enumerate(docs.columns)}
    held = docs.select(
        *(F.col(f"`{old}`").alias(new) for new, old in columns.items()),
        F.col("doc_id").alias("_doc"),
        F.col("source").alias("_source"),
    )
    taken = held.join(known, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_n", n)
    repeated = taken.filter("_n > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
    )
    return repeated.select(*(F.col(new).alias(old) for new, old in columns.items()))
