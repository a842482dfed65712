"""Naive local time: parsing, fallback, age and display."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberwatch.constants import NO_TIME_TEXT

# Spark also reads a bare clock time as "today"; a reading always carries its date.
_STARTS_WITH_YEAR = r"^\s*\d{4}"
_NAMES_ZONE = r"(?i):\d+(?:\.\d+)?\s*(?:[a-z][a-z/_+:0-9]*|[+-]\d{1,2}:?\d{0,2}(?::\d{2})?)\s*$"
_MICROS_PER_SECOND = 1e6


def parse_time(column):
    """Timestamp without zone from text; text that is not a time becomes null."""
    text = column.cast("string")
    # text that names a zone is an instant; only that goes through the zone of the session
    zoned = F.when(text.rlike(_NAMES_ZONE), text.try_cast("timestamp").cast("timestamp_ntz")).otherwise(text.try_cast("timestamp_ntz"))
    return F.when(text.rlike(_STARTS_WITH_YEAR), zoned)


def as_time(frame, name):
    """Column ``name`` of ``frame`` as a timestamp without zone, parsing only if it is text."""
    kind = frame.schema[name].dataType.typeName()
    if kind in ("timestamp_ntz", "timestamp"):
        return F.col(name).cast("timestamp_ntz")
    return parse_time(F.col(name))


def now_column(now=None):
    """``now`` as a column: a column, a datetime, text, or the current time if not given."""
    if now is None:
        return F.localtimestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, datetime.datetime):
        now = now.isoformat(sep=" ")
    return F.lit(now).cast("timestamp_ntz")


def data_time(created_at, timestamp):
    """Store time, else sensor time."""
    return F.coalesce(created_at, timestamp)


def data_time_web(created_at, timestamp):
    """As ``data_time`` on raw text, but a present and empty store time hides the sensor time."""
    return parse_time(F.coalesce(created_at, timestamp))


def age_seconds(time, now=None):
    """Seconds from ``time`` to ``now``, with their fraction."""
    return F.timestamp_diff("MICROSECOND", time, now_column(now)) / F.lit(_MICROS_PER_SECOND)


def format_time(time, missing=NO_TIME_TEXT):
    """``yyyy-MM-dd HH:mm:ss``; null becomes ``missing`` (or stays null if that is None)."""
    text = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
    return text if missing is None else F.coalesce(text, F.lit(missing))
