"""Tag roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_tags(tags: DataFrame) -> DataFrame:
    """The distinct tags of each item, in byte order, joined with ``|``.

    Duplicates go first, by ``(mid, tag)``: that grouping spreads an item with very
    many tag rows over all tasks, and only its distinct tags reach the second one.
    """
    distinct = tags.select("mid", "tag").distinct()
    return distinct.groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_list("tag"))).alias("tags")
    )


def items_with_tags(items: DataFrame, tags: DataFrame) -> DataFrame:
    """Items with their tag text; null where an item has none."""
    return items.join(item_tags(tags), "mid", "left")
