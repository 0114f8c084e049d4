"""Top-k per group, positions inside groups and nested result lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.schemas import DEFAULTS

# Ids of one chunk lie within a range of this many integers, so no group of
# distinct ids is larger than this inside one chunk.
CHUNK_WIDTH = 1 << 16


def ranked(
    df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column], k: int | None = None
) -> DataFrame:
    """Add ``rank`` (1 = first) inside each key; with ``k`` keep the first ``k`` rows.

    ``row_number() <= k`` lets Spark cut every group to ``k`` rows before the
    shuffle (WindowGroupLimit), so a hot key costs no more than any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return out if k is None else out.filter(F.col("rank") <= k)


def top_per_key(
    df: DataFrame, key: str, k: int | None, score: str = "score", item: str = "mid"
) -> DataFrame:
    """Highest scores first; equal scores in ascending item order."""
    return ranked(df, key, [F.desc(score), F.asc(item)], k)


def newest_per_user(events: DataFrame) -> DataFrame:
    """One event per user: the newest; at the same second the one that stands last in the
    source if the events say where (``partition``, ``offset``), else the lowest item.

    An aggregate rather than a window: each task sends one row per user, however
    many events the user has.
    """
    event = F.struct("mid", "score", "timestamp")
    place = [F.col(name) for name in ("offset", "partition") if name in events.columns]
    order = F.struct(F.col("timestamp"), *place, -F.col("mid"), F.col("score"))
    return (
        events.groupBy("uid")
        .agg(F.max_by(event, order).alias("e"))
        .select("uid", "e.mid", "e.score", "e.timestamp")
    )


def recent(ratings: DataFrame, k: int = DEFAULTS.recent_ratings) -> DataFrame:
    """The ``k`` newest ratings of every user; ``pos`` 0 is the newest."""
    newest = [F.desc("timestamp"), F.asc("mid"), F.desc("score")]
    return ranked(ratings, "uid", newest, k).select(
        "uid", (F.col("rank") - 1).alias("pos"), "mid", "score", "timestamp"
    )


def chunk_of(item: Column | str) -> Column:
    item = F.col(item) if isinstance(item, str) else item
    return F.floor(item / CHUNK_WIDTH)


def positions(members: DataFrame, group: str = "cls", item: str = "mid") -> DataFrame:
    """Number the distinct items of every group from 1, in ascending item order.

    A group may hold a large share of all rows, so it is never sorted in one task:
    items are numbered within chunks of the id range, and a running sum over the
    (few) chunks of a group gives every chunk its offset.
    """
    chunked = members.withColumn("chunk", chunk_of(item))
    before = (
        Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        chunked.groupBy(group, "chunk")
        .agg(F.count("*").alias("_n"))
        .select(group, "chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(group, "chunk").orderBy(item)
    return (
        chunked.withColumn("_at", F.row_number().over(inside))
        .join(offsets, [group, "chunk"])
        .withColumn("pos", F.col("_offset") + F.col("_at"))
        .drop("_offset", "_at", "chunk")
    )


def as_recs(
    ranked_rows: DataFrame, key: str, item: str = "mid", score: str = "score"
) -> DataFrame:
    """Nest rows that carry ``rank`` into ``key, recs ARRAY<STRUCT<mid, score>>``.

    For rows already cut to a top-k; every list is at most k long.
    """
    entry = F.struct("rank", F.col(item).alias("mid"), F.col(score).alias("score"))
    nested = ranked_rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_recs"))
    return nested.select(key, without_rank("_recs").alias("recs"))


def without_rank(recs: str) -> Column:
    return F.transform(
        recs, lambda r: F.struct(r["mid"].alias("mid"), r["score"].alias("score"))
    )


def from_recs(nested: DataFrame, key: str = "mid", item: str = "sim_mid") -> DataFrame:
    """Nested lists back to ``key, item, score`` rows."""
    return nested.select(key, F.inline("recs").alias(item, "score"))
