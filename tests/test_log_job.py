"""The log job from a source to a sink, and the order that a source gives to a user's events."""

import pytest

from tasteloom.operators.ranking import newest_per_user
from tasteloom.sources.streams import FolderSink, KafkaSink, file_lines
from tasteloom.sources.text import parse_rating_events
from tasteloom.streaming import logs
from tasteloom.streaming import recommend as R
from tests.helpers import rows

PREFIX = "MOVIE_RATING_PREFIX:"


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_folder_to_folder(spark, tmp_path, fmt):
    source = tmp_path / "in"
    source.mkdir()
    sink, progress = FolderSink(str(tmp_path / "out"), fmt), str(tmp_path / "progress")

    def run():
        lines = file_lines(spark, str(source), maxFilesPerTrigger="1")
        logs.start_topology(lines, sink, progress, availableNow=True).awaitTermination()
        return rows(sink.read(spark), "key", "value")

    (source / "1.txt").write_text(f"x {PREFIX}1|2|3.0|4\nnothing\n")
    assert run() == [("logProcessor", "1|2|3.0|4")]
    # A file that a failed attempt has left is no message: the sink's log doesn't name it.
    stray = spark.createDataFrame([("logProcessor", "stray")], "key string, value string")
    stray.write.format(fmt).mode("append").save(str(tmp_path / "stray"))
    for part in (tmp_path / "stray").glob("part-*"):
        (tmp_path / "out" / f"stray-{part.name}").write_bytes(part.read_bytes())
    (source / "2.txt").write_text(f"{PREFIX}5|6|1.0|7\n")
    (source / "3.txt").write_text(f"{PREFIX}5|6|1.0|8\n")
    assert run() == [("logProcessor", v) for v in ("1|2|3.0|4", "5|6|1.0|7", "5|6|1.0|8")]


def test_kafka_form_is_only_put_together(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    messages = logs.extract_ratings(file_lines(spark, str(source)))
    writer = KafkaSink("nowhere:9092", options={"kafka.acks": "all"}).writer(messages, "unused")
    assert type(writer).__name__ == "DataStreamWriter"


def test_equal_times_are_settled_by_the_place_in_the_source(spark):
    lines = spark.createDataFrame(
        [("1|5|4.0|9", 0, 7), ("1|2|1.0|9", 0, 8), ("1|9|3.0|9", 0, 6), ("2|1|1.0|5", 1, 1), ("bad", 0, 9)],
        "value string, partition int, offset bigint",
    )
    good, bad = parse_rating_events(lines)
    assert good.columns == ["partition", "offset", "uid", "mid", "score", "timestamp"]
    assert rows(bad, "value") == [("bad",)]
    assert rows(newest_per_user(R.typed_events(lines)), "uid", "mid") == [(1, 2), (2, 1)]
    # A later time still comes first, and without places the lowest item does.
    later = lines.union(spark.createDataFrame([("1|8|4.0|10", 0, 1)], lines.schema))
    assert rows(newest_per_user(R.typed_events(later)), "uid", "mid") == [(1, 8), (2, 1)]
    plain = lines.select("value").filter("value <> '1|2|1.0|9'")
    assert rows(newest_per_user(R.typed_events(plain)), "uid", "mid") == [(1, 5), (2, 1)]
