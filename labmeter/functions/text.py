"""Durations and percentages as text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from labmeter.functions.clock import moment
from labmeter.functions.numbers import floor_div, int_div

DAY, HOUR, MINUTE = 86_400, 3_600, 60


def duration_text(seconds: Column, compact: bool = False) -> Column:
    """`D days H hours M minutes S seconds`; compact leaves out the last space."""
    return F.concat(
        floor_div(seconds, DAY), F.lit(" days "),
        floor_div(seconds % DAY, HOUR), F.lit(" hours "),
        floor_div(seconds % HOUR, MINUTE), F.lit(" minutes "),
        seconds % MINUTE, F.lit("seconds" if compact else " seconds"),
    )


def elapsed_text(ts: Column, now: Column | datetime | str) -> Column:
    """Distance between `ts` and `now` as `D:H:M:S`, parts not padded."""
    gap = F.abs(F.timestamp_diff("SECOND", ts, moment(now)))
    return F.concat_ws(
        ":", int_div(gap, DAY), int_div(gap % DAY, HOUR), int_div(gap % HOUR, MINUTE), gap % MINUTE
    )


def pct_text(part: Column, whole: Column) -> Column:
    """`part / whole` as a percentage with one digit, exact half-up; NULL when undefined.

    Integers throughout: no floating-point tie can round the wrong way.
    """
    part, whole = part.cast("long"), whole.cast("long")
    size = F.abs(whole)
    tenths = int_div(F.abs(part) * 2000 + size, size * 2)
    minus = F.when(((part < 0) != (whole < 0)) & (tenths > 0), "-").otherwise("")
    return F.concat(minus, int_div(tenths, 10), F.lit("."), tenths % 10, F.lit("%"))
