"""Calendar columns from epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def yearmonth(seconds: Column | str, zone: str = "UTC") -> Column:
    """``yyyyMM`` as an INT.

    In UTC the month follows from the day number alone, so the result does not
    depend on the time zone of the session that runs it.
    """
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    if zone.upper() == "UTC":
        day = F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
    else:
        origin = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        utc = origin + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
        day = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    return F.year(day) * 100 + F.month(day)


def epoch_seconds(moment: Column | str) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ read as UTC, in any session time zone."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    day = F.unix_date(F.to_date(moment)).cast("bigint")
    return day * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def register_change_date(spark: SparkSession, name: str = "change_date") -> None:
    """Register the month function for SQL text; Catalyst inlines its body."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(seconds BIGINT) RETURNS INT RETURN "
        "year(date_from_unix_date(CAST(floor(seconds / 86400) AS INT))) * 100"
        " + month(date_from_unix_date(CAST(floor(seconds / 86400) AS INT)))"
    )
