"""Popularity, averages and top lists per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.functions import register_change_date, yearmonth
from tasteloom.operators.ranking import as_recs, top_per_key
from tasteloom.schemas import DEFAULT_GENRES, DEFAULTS


def rate_more(ratings: DataFrame) -> DataFrame:
    """How often each item was rated."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def monthly(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """``mid, score, yearmonth`` of every rating."""
    return ratings.select("mid", "score", yearmonth("timestamp", zone).alias("yearmonth"))


def rate_more_recently(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Ratings per item and month, newest month first, then by count."""
    return (
        monthly(ratings, zone)
        .groupBy("yearmonth", "mid")
        .agg(F.count("mid").alias("count"))
        .select("mid", "count", "yearmonth")
        .orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid"))
    )


def average(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def matching_genres(genres: Sequence[str], text: Column | str = "genres") -> Column:
    """The categories that occur, in any case, as a substring of the text.

    The category list is short program data, so the pairing needs no join: it is an
    expression on the item row. A null text matches nothing.
    """
    text = F.col(text) if isinstance(text, str) else text
    lowered = F.lower(F.coalesce(text, F.lit("")))
    wanted = F.array(*[F.lit(g) for g in genres])
    return F.filter(wanted, lambda g: lowered.contains(F.lower(g)))


def genre_matches(items: DataFrame, genres: Sequence[str] = DEFAULT_GENRES) -> DataFrame:
    """One row per item and category it belongs to."""
    return items.select("mid", F.explode(matching_genres(genres)).alias("genre"))


def genres_top(
    items: DataFrame,
    ratings: DataFrame,
    genres: Sequence[str] = DEFAULT_GENRES,
    k: int = DEFAULTS.genre_top,
) -> DataFrame:
    """The ``k`` best rated items of each category: ``genre, rank, mid, avg``."""
    scored = items.select("mid", "genres").join(average(ratings), "mid")
    matched = scored.select("mid", "avg", F.explode(matching_genres(genres)).alias("genre"))
    return top_per_key(matched, "genre", k, score="avg").select("genre", "rank", "mid", "avg")


def genre_recs(top: DataFrame) -> DataFrame:
    """The same lists nested: ``genres, recs``."""
    return as_recs(top, "genre", score="avg").withColumnRenamed("genre", "genres")


# The same statistics as SQL text over registered views.
SQL = {
    "rate_more": "SELECT mid, count(mid) AS count FROM {ratings} GROUP BY mid",
    "monthly": (
        "SELECT mid, score, change_date(timestamp) AS yearmonth FROM {ratings}"
    ),
    "rate_more_recently": (
        "SELECT mid, count(mid) AS count, yearmonth FROM ({monthly}) "
        "GROUP BY yearmonth, mid ORDER BY yearmonth DESC, count DESC, mid"
    ),
    "average": "SELECT mid, avg(score) AS avg FROM {ratings} GROUP BY mid",
}


def by_sql(spark: SparkSession, statistic: str, ratings_view: str = "ratings") -> DataFrame:
    """Run one of the ``SQL`` statistics over a registered ratings view."""
    register_change_date(spark)
    month_rows = SQL["monthly"].format(ratings=ratings_view)
    return spark.sql(SQL[statistic].format(ratings=ratings_view, monthly=month_rows))
