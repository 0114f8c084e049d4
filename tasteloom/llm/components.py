"""Connected components of a graph that is as large as the corpus, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.base import saved


def components(links: DataFrame, folder: str) -> DataFrame:
    """``id, root`` of every end of the ``a, b`` links; the root is the smallest id.

    Large-star and small-star rounds: every node is hung under the smallest neighbour,
    until all links point at roots. The number of rounds grows with the logarithm of the
    longest path. Minima are aggregates, so a node with very many links is no hot spot;
    every round is written.
    """
    edges = saved(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        f"{folder}/edges",
    )
    before, step = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before, step = state, step + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        large = (
            both.filter("v > u")
            .join(least, F.col("u") == F.col("_u"))
            .select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))
            .distinct()
        )
        large = saved(large, f"{folder}/large{step}")
        least = large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        small = large.join(least, F.col("u") == F.col("_u")).select("u", "v", "_m")
        edges = saved(
            small.select("u", F.col("_m").alias("v"))
            .unionByName(small.filter("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v")))
            .distinct(),
            f"{folder}/round{step}",
        )
