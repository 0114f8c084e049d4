import pytest
from pyspark.sql import functions as F

from tasteloom.operators import statistics as S
from tasteloom.operators.tags import item_tags, items_with_tags
from tasteloom.schemas import DEFAULT_GENRES
from tests.helpers import plan_of, rows


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(
        [(1, "Action|War"), (2, "Science Fiction"), (3, "warfare"), (4, "Drama"), (5, None)],
        "mid int, genres string",
    )


@pytest.fixture()
def ratings(spark):
    data = [(1, 1, 4), (2, 1, 2), (1, 2, 5), (1, 3, 3), (1, 5, 5), (1, 99, 5)]
    return spark.createDataFrame(
        [(u, m, float(s), 1260759144 + 86400 * 31 * u) for u, m, s in data],
        "uid int, mid int, score double, timestamp bigint",
    )


def test_genre_top_golden(items, ratings):
    top = S.genres_top(items, ratings)
    assert rows(top, "genre", "rank", "mid", "avg") == [
        ("Action", 1, 1, 3.0),
        ("Science", 1, 2, 5.0),
        ("War", 1, 1, 3.0),
        ("War", 2, 3, 3.0),
    ]
    nested = {r["genres"]: [tuple(e) for e in r["recs"]] for r in S.genre_recs(top).collect()}
    assert nested["War"] == [(1, 3.0), (3, 3.0)] and "Drama" not in nested


def test_genre_top_cuts_groups_before_the_shuffle(items, ratings):
    plan = plan_of(S.genres_top(items, ratings))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_counts_and_averages(ratings):
    assert rows(S.rate_more(ratings), "mid", "count") == [(1, 2), (2, 1), (3, 1), (5, 1), (99, 1)]
    assert rows(S.average(ratings), "mid", "avg")[0] == (1, 3.0)
    recently = [tuple(r) for r in S.rate_more_recently(ratings).collect()]
    assert recently == [
        (1, 1, 201002),
        (1, 1, 201001),
        (2, 1, 201001),
        (3, 1, 201001),
        (5, 1, 201001),
        (99, 1, 201001),
    ]


@pytest.mark.parametrize("name", ["rate_more", "rate_more_recently", "average"])
def test_sql_equals_dataframe(spark, ratings, name):
    ratings.createOrReplaceTempView("some_ratings")
    by_sql = S.by_sql(spark, name, "some_ratings")
    by_frame = getattr(S, name)(ratings)
    assert [tuple(r) for r in by_sql.select(*by_frame.columns).collect()] == [
        tuple(r) for r in by_frame.collect()
    ] or rows(by_sql, *by_frame.columns) == rows(by_frame, *by_frame.columns)
    assert "Python" not in plan_of(by_sql)


def test_default_genres():
    assert len(DEFAULT_GENRES) == 20 and len(set(DEFAULT_GENRES)) == 20


def test_tags_keep_case_and_sort_bytewise(spark, items):
    tags = spark.createDataFrame(
        [
            (1, 1, "space"), (2, 1, "Science Fiction"), (3, 1, "science fiction"),
            (4, 1, "space"), (5, 2, None),
        ],
        "uid int, mid int, tag string",
    )
    assert rows(item_tags(tags), "mid", "tags") == [
        (1, "Science Fiction|science fiction|space"),
        (2, ""),
    ]
    joined = {r["mid"]: r["tags"] for r in items_with_tags(items, tags).collect()}
    assert joined[3] is None and joined[2] == "" and len(joined) == 5


def test_hot_item_shuffles_distinct_tags_only(spark):
    tags = spark.range(1000).select(
        F.lit(1).alias("mid"), (F.col("id") % 3).cast("string").alias("tag")
    )
    assert item_tags(tags).first()["tags"] == "0|1|2"
