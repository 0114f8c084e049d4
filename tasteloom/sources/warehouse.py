"""A star-schema warehouse seen as ratings, items, tags and events.

``part`` is the catalogue, an order line is a customer's rating of a part, and the
``events`` table gives tags, rating messages and log lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.functions import epoch_seconds
from tasteloom.operators.ranking import newest_per_user
from tasteloom.schemas import LOG_PREFIX
from tasteloom.sources.text import parse_rating_events

# Categories of the catalogue, the part types and the words of part names.
CATALOGUE_GENRES = (
    "ECONOMY",
    "LARGE",
    "MEDIUM",
    "PROMO",
    "SMALL",
    "STANDARD",
    "anvil",
    "blue",
    "bolt",
    "cold",
    "gear",
    "gizmo",
    "hot",
    "new",
    "old",
    "plate",
    "red",
    "ring",
    "rod",
    "widget",
)


# Layout of the tables read here; no schema is inferred from files.
LAYOUT = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUT[name]).parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_seconds("o_orderdate").alias("timestamp"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", F.translate("p_name", " ", "|")).alias("genres"),
    )


def _event_item(spark: SparkSession, folder: str):
    catalogue_size = table(spark, folder, "part").agg(F.count("*")).scalar()
    return F.pmod(F.col("event_id"), catalogue_size).cast("int")


def tags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _event_item(spark, folder).alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").alias("timestamp"),
    )


def _event_text(spark: SparkSession, folder: str):
    score = (F.ceil(F.least("value", F.lit(100)) / 10) / 2).cast("double")
    return F.concat_ws(
        "|",
        F.col("user_id").cast("int").cast("string"),
        _event_item(spark, folder).cast("string"),
        score.cast("string"),
        epoch_seconds("ts").cast("string"),
    )


def rating_messages(spark: SparkSession, folder: str) -> DataFrame:
    """``UID|MID|SCORE|TIMESTAMP`` texts."""
    return table(spark, folder, "events").select(_event_text(spark, folder).alias("value"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same texts as log lines: views and purchases carry the rating marker."""
    text = _event_text(spark, folder)
    marked = F.col("event_type").isin("view", "purchase")
    return table(spark, folder, "events").select(
        F.when(marked, F.concat(F.lit(LOG_PREFIX), text)).otherwise(text).alias("value")
    )


def rating_events(spark: SparkSession, folder: str) -> DataFrame:
    """Typed rating events."""
    good, _ = parse_rating_events(rating_messages(spark, folder))
    return good


def last_events(spark: SparkSession, folder: str) -> DataFrame:
    return newest_per_user(rating_events(spark, folder))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", "embedding")
