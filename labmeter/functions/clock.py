"""The explicit clock, and whole-second time arithmetic that ignores the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DISPLAY_FORMAT = "yyyy/MM/dd HH:mm:ss"
EPOCH = "1970-01-01 00:00:00"


def moment(value: Column | datetime | str) -> Column:
    """A TIMESTAMP_NTZ column from a column, a datetime or a text.

    Literals go through text, so the Python process time zone plays no part.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("give the clock as a naive UTC datetime")
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def moment_of_epoch(seconds: int) -> Column:
    """The instant that lies `seconds` after the epoch, as TIMESTAMP_NTZ in UTC."""
    return F.timestamp_add("SECOND", F.lit(seconds), moment(EPOCH))


def epoch_of(ts: Column) -> Column:
    """Whole seconds since the epoch."""
    return F.timestamp_diff("SECOND", moment(EPOCH), ts)


def whole_second(ts: Column) -> Column:
    """Cut to the one-second resolution the event and reservation tables are defined with."""
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def display(ts: Column) -> Column:
    return F.date_format(ts, DISPLAY_FORMAT)


def clipped_end(end: Column, now: Column | datetime | str) -> Column:
    """The earlier of `end` and `now`; NULL when `end` is NULL (so `least` would be wrong)."""
    return F.when(moment(now) < end, moment(now)).otherwise(end)
