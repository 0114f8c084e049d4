"""Rating messages out of a log stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tasteloom.functions import strip_controls
from tasteloom.schemas import LOG_KEY, LOG_PREFIX
from tasteloom.sources.streams import MessageSink


def extract_ratings(lines: DataFrame, prefix: str = LOG_PREFIX) -> DataFrame:
    """``key, value`` messages from the lines that carry the marker.

    The value is the text after the first marker, up to the next one if there is
    another. Lines with nothing after the marker give no message. Works on batch and
    streaming input, and on binary values.
    """
    line = F.col("value").cast("string")
    after = strip_controls(F.get(F.split(line, re.escape(prefix)), F.lit(1)))
    return (
        lines.filter(line.contains(prefix))
        .select(F.lit(LOG_KEY).alias("key"), after.alias("value"))
        .filter("value <> ''")
    )


def start_extraction(
    lines: DataFrame,
    checkpoint: str,
    path: str,
    fmt: str = "parquet",
    prefix: str = LOG_PREFIX,
    **trigger,
):
    """Run the extraction into a file sink; ``sources.streams.kafka_writer`` is the other one."""
    return (
        extract_ratings(lines, prefix)
        .writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_topology(
    lines: DataFrame,
    sink: MessageSink,
    checkpoint: str,
    prefix: str = LOG_PREFIX,
    **trigger,
) -> StreamingQuery:
    """The whole log job: any stream of lines, the extraction, any message sink.

    ``start_topology(kafka_lines(spark, servers, "log"), KafkaSink(servers), ...)`` goes from
    topic to topic; with ``file_lines`` and ``FolderSink`` the same job goes from folder to
    folder. A batch as soon as there are lines, unless a trigger is given.
    """
    writer = sink.writer(extract_ratings(lines, prefix), checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
