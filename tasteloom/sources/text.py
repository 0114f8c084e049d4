"""Delimited text to typed rows.

``parse_*`` work on any DataFrame with a ``value`` column, batch or streaming;
``read_*`` put a text scan under them. ``strict`` stops the job at the first bad
line, ``quarantine`` returns the good rows and, separately, the bad lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteloom.functions import delimited, strip_controls
from tasteloom.schemas import ITEM, RATING, TAG

#: Where a message stands in its source.
POSITION = ("partition", "offset")
STRICT = "strict"
QUARANTINE = "quarantine"


def _field(parts: Column, position: int, field: T.StructField) -> Column:
    raw = F.get(parts, F.lit(position))
    if isinstance(field.dataType, T.StringType):
        return strip_controls(raw)
    # Casting a text to a number skips blanks around it.
    return raw.try_cast(field.dataType)


def _typed(mark: str, schema: T.StructType) -> Column:
    """The line as an array of one typed row, so that it is cut and cast only once."""
    return F.transform(
        F.array(delimited("value", mark)),
        lambda parts: F.struct(
            *[_field(parts, i, f).alias(f.name) for i, f in enumerate(schema.fields)]
        ),
    )


def _is_bad(row: Column, schema: T.StructType) -> Column:
    """A field is null exactly when it is missing or its cast failed."""
    bad = row.isNull()
    for field in schema.fields:
        bad = bad | row[field.name].isNull()
    return bad


def parse(
    lines: DataFrame,
    mark: str,
    schema: T.StructType,
    mode: str = STRICT,
    keep: Sequence[str] = (),
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Typed rows; ``keep`` names columns of the lines that the good rows carry on."""
    rows = _typed(mark, schema)
    if mode == STRICT:
        text = F.coalesce("value", F.lit("null"))
        stop = F.raise_error(F.concat(F.lit("bad input line: "), text)).cast("boolean")
        checked = F.filter(rows, lambda r: F.when(_is_bad(r, schema), stop).otherwise(F.lit(True)))
        return lines.select(*keep, F.inline(checked))
    if mode == QUARANTINE:
        good = lines.select(*keep, F.inline(F.filter(rows, lambda r: ~_is_bad(r, schema))))
        # Not a filter: that would be pushed below the text and build it a second time.
        rejected = F.when(F.exists(rows, lambda r: _is_bad(r, schema)), F.array("value"))
        return good, lines.select(F.explode(rejected).alias("value"))
    raise ValueError(f"mode must be '{STRICT}' or '{QUARANTINE}', not {mode!r}")


def parse_items(lines: DataFrame, mode: str = STRICT):
    return parse(lines, "^", ITEM, mode)


def parse_ratings(lines: DataFrame, mode: str = STRICT):
    return parse(lines, ",", RATING, mode)


def parse_tags(lines: DataFrame, mode: str = STRICT):
    return parse(lines, ",", TAG, mode)


def parse_rating_events(lines: DataFrame, mode: str = QUARANTINE):
    """``UID|MID|SCORE|TIMESTAMP`` messages.

    Where the lines say their place in the source (``partition``, ``offset``), the events do.
    """
    place = [name for name in POSITION if name in lines.columns]
    return parse(lines, "|", RATING, mode, place)


def parse_recent_entries(entries: DataFrame) -> DataFrame:
    """``uid, pos, value='MID:SCORE'`` list entries to ``uid, pos, mid, score``."""
    parts = delimited("value", ":")
    return entries.select(
        "uid",
        "pos",
        strip_controls(F.get(parts, F.lit(0))).cast("int").alias("mid"),
        strip_controls(F.get(parts, F.lit(1))).cast("double").alias("score"),
    )


def read_items(spark: SparkSession, path: str, mode: str = STRICT):
    return parse_items(spark.read.text(path), mode)


def read_ratings(spark: SparkSession, path: str, mode: str = STRICT):
    return parse_ratings(spark.read.text(path), mode)


def read_tags(spark: SparkSession, path: str, mode: str = STRICT):
    return parse_tags(spark.read.text(path), mode)
