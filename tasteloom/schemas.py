"""Table layouts, product names and the default settings of every job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _text_columns(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


ITEM = T.StructType(
    [T.StructField("mid", T.IntegerType(), False)]
    + _text_columns(
        "name", "descri", "timelong", "issue", "shoot", "language", "genres", "actors", "directors"
    )
)

RATING = T.StructType(
    [
        T.StructField("uid", T.IntegerType(), True),
        T.StructField("mid", T.IntegerType(), True),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

TAG = T.StructType(
    [
        T.StructField("uid", T.IntegerType(), True),
        T.StructField("mid", T.IntegerType(), True),
        T.StructField("tag", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

RECOMMENDATION = T.StructType(
    [T.StructField("mid", T.IntegerType(), True), T.StructField("score", T.DoubleType(), True)]
)

GENRE_RECS = T.StructType(
    [
        T.StructField("genres", T.StringType(), True),
        T.StructField("recs", T.ArrayType(RECOMMENDATION), True),
    ]
)
ITEM_RECS = T.StructType(
    [
        T.StructField("mid", T.IntegerType(), True),
        T.StructField("recs", T.ArrayType(RECOMMENDATION), True),
    ]
)
USER_RECS = T.StructType(
    [
        T.StructField("uid", T.IntegerType(), True),
        T.StructField("recs", T.ArrayType(RECOMMENDATION), True),
    ]
)

# What the scoring of a user looks up.
RATED = T.StructType(
    [T.StructField("uid", T.IntegerType(), True), T.StructField("mid", T.IntegerType(), True)]
)
RECENT = T.StructType(
    [
        T.StructField("uid", T.IntegerType(), True),
        T.StructField("pos", T.IntegerType(), True),
        T.StructField("mid", T.IntegerType(), True),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("timestamp", T.LongType(), True),
    ]
)

# The two tables that together hold a similarity product (operators/similarity.py).
MEMBERS = T.StructType(
    [
        T.StructField("mid", T.IntegerType(), True),
        T.StructField("cls", T.IntegerType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)
LINKS = T.StructType(
    [
        T.StructField("cls", T.IntegerType(), True),
        T.StructField("sim_cls", T.IntegerType(), True),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)

# Names of the stored tables.
ITEM_TABLE = "Movie"
RATING_TABLE = "Rating"
TAG_TABLE = "Tag"
SEARCH_TABLE = "MovieWithTags"
RATE_MORE = "RateMoreMovies"
RATE_MORE_RECENTLY = "RateMoreRecentlyMovies"
AVERAGE = "AverageMovies"
GENRES_TOP = "GenresTopMovies"
CONTENT_RECS = "ContentMovieRecs"
USER_RECS_TABLE = "UserRecs"
ITEM_RECS_TABLE = "MovieRecs"
STREAM_RECS = "StreamRecs"

# The categories a top list is made for.
DEFAULT_GENRES = (
    "Action",
    "Adventure",
    "Animation",
    "Comedy",
    "Crime",
    "Documentary",
    "Drama",
    "Family",
    "Fantasy",
    "Foreign",
    "History",
    "Horror",
    "Music",
    "Mystery",
    "Romance",
    "Science",
    "Tv",
    "Thriller",
    "War",
    "Western",
)

# The log marker and the key of the messages cut out of the log.
LOG_PREFIX = "MOVIE_RATING_PREFIX:"
LOG_KEY = "logProcessor"


@dataclass(frozen=True)
class Params:
    """Default settings; a job run without options uses exactly these."""

    genre_top: int = 10
    hash_features: int = 50
    similarity_threshold: float = 0.6
    rank: int = 200
    iterations: int = 5
    regularisation: float = 0.1
    user_recs: int = 20
    grid_ranks: tuple[int, ...] = (50, 100, 200, 300)
    grid_regs: tuple[float, ...] = (0.01, 0.1, 1.0)
    train_ratio: float = 0.8
    recent_ratings: int = 20
    candidates: int = 20
    pair_similarity: float = 0.7
    liked_above: float = 3.0
    trigger_seconds: int = 2
    source_topic: str = "log"
    rating_topic: str = "recommender"
    seed: int = 42
    key_buckets: int = 256
    # Rows that a look-up in a snapshot reads at most for a key, and the limit of that.
    bucket_rows: int = 50_000
    most_buckets: int = 4096
    # Blocks of the factor model. They decide its start values, so the number is fixed: the
    # same data and seed give the same model on every cluster. Raise it with the data.
    als_blocks: int = 10


DEFAULTS = Params()
