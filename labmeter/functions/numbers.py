"""Exact integer helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Integral division, truncating toward zero; NULL when `b` is zero."""
    if isinstance(b, int):
        return F.call_function("div", a, F.lit(b))
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def floor_div(a: Column, b: int) -> Column:
    """Integral division, rounding toward minus infinity."""
    return int_div(a - F.pmod(a, F.lit(b)), b)
