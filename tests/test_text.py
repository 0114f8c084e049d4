import pytest
from pyspark.sql import functions as F

from tasteloom.sources import text
from tests.helpers import rows

ITEM_LINE = (
    "260^ Star Wars: Episode IV - A New Hope (1977)\t^Princess Leia^121 minutes^"
    "September 21, 2004^1977^English^Action|Adventure|Sci-Fi^Mark Hamill|Harrison Ford^{last}"
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_items_are_trimmed_and_a_last_empty_field_is_legal(spark):
    got = text.parse_items(
        lines(spark, ITEM_LINE.format(last=" George Lucas "), ITEM_LINE.format(last=""))
    ).collect()
    assert got[0]["name"] == "Star Wars: Episode IV - A New Hope (1977)"
    assert got[0]["genres"] == "Action|Adventure|Sci-Fi"
    assert [r["directors"] for r in got] == ["George Lucas", ""]
    assert text.parse_items(lines(spark, ITEM_LINE)).schema.simpleString().startswith(
        "struct<mid:int,name:string"
    )


@pytest.mark.parametrize("bad", ["1,2,3", "x,2,3.5,4", "1,2,,4", "", "1,2,3.5,4e"])
def test_strict_stops_and_quarantine_sorts_out(spark, bad):
    given = lines(spark, "1,31,2.5,1260759144", bad, " 7,8, 3 ,9,extra")
    with pytest.raises(Exception, match="bad input line"):
        text.parse_ratings(given).count()
    good, rejected = text.parse_ratings(given, text.QUARANTINE)
    assert rows(good, "uid", "mid", "score", "timestamp") == [
        (1, 31, 2.5, 1260759144),
        (7, 8, 3.0, 9),
    ]
    assert rows(rejected, "value") == [(bad,)]


def test_nine_item_fields_are_bad(spark):
    nine = "^".join(["1"] + ["x"] * 8)
    good, rejected = text.parse_items(lines(spark, nine, "no^" + "^".join("x" * 9)), "quarantine")
    assert good.count() == 0 and rejected.count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "tags.csv").write_text("15,1955, dentist ,1193435061\n16,260,sci-fi,1\n")
    got = text.read_tags(spark, str(tmp_path / "tags.csv"))
    assert rows(got, "uid", "mid", "tag", "timestamp") == [
        (15, 1955, "dentist", 1193435061),
        (16, 260, "sci-fi", 1),
    ]


def test_events_and_recent_entries(spark):
    good, bad = text.parse_rating_events(lines(spark, "1|2|4.5|1000", "INFO 1|2|4.5|1000"))
    assert rows(good, "uid", "mid", "score", "timestamp") == [(1, 2, 4.5, 1000)]
    assert bad.count() == 1
    entries = spark.createDataFrame([(1, 0, " 5 : 4.0 ")], "uid int, pos int, value string")
    assert rows(text.parse_recent_entries(entries), "uid", "pos", "mid", "score") == [(1, 0, 5, 4.0)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        text.parse_ratings(lines(spark, "1"), "lenient")


def test_late_timestamps(spark):
    got = text.parse_ratings(lines(spark, "1,2,3,4102444800")).select(F.max("timestamp"))
    assert got.first()[0] == 4102444800
