import math

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from tasteloom.functions import (
    cosine,
    delimited,
    dot,
    epoch_seconds,
    l2_norm,
    liked_adjustment,
    log_base,
    register_change_date,
    score_in,
    strip_controls,
    whitespace_tokens,
    yearmonth,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "seconds, month",
    [(1260759144, 200912), (1193435061, 200710), (0, 197001), (1583020799, 202002), (-1, 196912)],
)
def test_yearmonth_is_utc_in_any_session_zone(spark, seconds, month):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, yearmonth(F.lit(seconds))) == month
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_yearmonth_in_another_zone(spark):
    # 2020-02-29 23:59:59 UTC is already March in Tokyo.
    assert one(spark, yearmonth(F.lit(1583020799), "Asia/Tokyo")) == 202003


def test_change_date_in_sql(spark):
    register_change_date(spark)
    assert spark.sql("SELECT change_date(1193435061) AS x").first()["x"] == 200710


def test_epoch_seconds_of_ntz(spark):
    moment = F.expr("TIMESTAMP_NTZ '2007-10-26 21:44:21.9'")
    assert one(spark, epoch_seconds(moment)) == 1193435061


def test_strip_takes_every_control_character(spark):
    assert one(spark, strip_controls(F.lit("\t \x00a b \x1f\n "))) == "a b "
    assert one(spark, strip_controls(F.lit(" \t"))) == ""


def test_delimited_is_literal(spark):
    assert one(spark, delimited(F.lit("a^b^^"), "^")) == ["a", "b", "", ""]
    assert one(spark, delimited(F.lit("1|2"), "|")) == ["1", "2"]


def test_tokens_equal_the_ml_tokenizer(spark):
    texts = ["", " ", "  ", "A b", "Science  Fiction", " a", "a ", "a\t\nb  ", "a b", "İx y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = Tokenizer(inputCol="t", outputCol="ml").transform(df).select(
        "t", "ml", whitespace_tokens("t").alias("own")
    )
    for row in both.collect():
        assert row["own"] == row["ml"], repr(row["t"])


def test_logs(spark):
    assert one(spark, log_base(F.lit(100.0))) == pytest.approx(2)
    assert one(spark, log_base(F.lit(8.0), 2.0)) == pytest.approx(3)
    assert one(spark, liked_adjustment(F.lit(20), F.lit(0))) == pytest.approx(math.log10(20))
    assert one(spark, liked_adjustment(F.lit(0), F.lit(0))) == 0


def test_vectors(spark):
    a = F.array(F.lit(3.0), F.lit(4.0))
    b = F.array(F.lit(4.0), F.lit(3.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, dot(a, b)) == 24
    assert one(spark, l2_norm(a)) == 5
    assert one(spark, cosine(a, b)) == pytest.approx(0.96)
    assert one(spark, cosine(a, zero)) is None


def test_score_in_a_map(spark):
    scores = F.create_map(F.lit(1), F.lit(0.5))
    assert one(spark, score_in(scores, F.lit(1))) == 0.5
    assert one(spark, score_in(scores, F.lit(2))) == 0.0
    assert one(spark, score_in(F.lit(None).cast("map<int,double>"), F.lit(2))) == 0.0
