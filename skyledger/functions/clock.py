"""Date and time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_path(ts: Column) -> Column:
    """``2024/01/05``: the day folder of a timestamp."""
    return F.date_format(ts, "yyyy/MM/dd")


def time_digits(ts: Column) -> Column:
    """``235959``: the time part used in file names."""
    return F.date_format(ts, "HHmmss")


def iso_text(ts: Column) -> Column:
    """ISO-8601 text without a zone; the fraction appears only when it is not zero."""
    micros = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def utc_iso_now() -> Column:
    """The query's start time in UTC as ISO text, whatever the session zone is."""
    return iso_text(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
