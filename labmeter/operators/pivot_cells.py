"""Reservation pivots of any time range from a table of cells, without reading reservations again.

A cell holds, for one mail address, lab bucket and calendar cell (32768, 1024, 32 and single days, hours, minutes,
seconds), how many reservations start in it and the last of them. A range is tiled by cells as large as
possible: a few hundred at most, whatever its length, given as at most 13 runs of neighbouring cells. So a report reads, of each
address, the cells of these runs only. Cells of several tables of reservations add up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import epoch_of
from labmeter.functions.numbers import floor_div
from labmeter.operators.attribution import CELL_UNITS
from labmeter.operators.pivots import Buckets, _in_bucket

ALL = "*"  # the bucket of every reservation


def tiles(low: int, high: int) -> list[tuple[int, int, int]]:
    """(unit, first, end): runs of whole cells that tile the seconds from low to high, both included."""
    runs, inner = [], None
    for unit in CELL_UNITS:
        first, end = -(-low // unit), (high + 1) // unit
        if inner is None:
            runs.append((unit, first, end))
        else:
            ratio = inner[0] // unit
            runs += [(unit, first, inner[1] * ratio), (unit, inner[2] * ratio, end)]
        if first < end:
            inner = (unit, first, end)
    return [run for run in runs if run[1] < run[2]]


def pivot_cells(reservations: DataFrame, buckets: Buckets) -> DataFrame:
    """(email, bucket, unit, cell, n, last_ts), one row per address, bucket and cell. Rows combine map-side.

    Reservations without an address belong to no bucket but ALL, those without a start to no cell.
    """
    listed = [F.when(_in_bucket(F.col("lab"), labs) & F.col("email").isNotNull(), name) for name, labs in buckets.items()]
    of = F.filter(F.array(F.lit(ALL), *listed), lambda name: name.isNotNull())
    started = reservations.filter(F.col("start_ts").isNotNull()).select(
        "email", "start_ts", epoch_of(F.col("start_ts")).alias("at"), F.explode(of).alias("bucket")
    )
    cells = [F.struct(F.lit(unit).cast("long").alias("unit"), floor_div(F.col("at"), unit).cast("long").alias("cell")) for unit in CELL_UNITS]
    return started.select("email", "bucket", "start_ts", F.inline(F.array(*cells))).groupBy("email", "bucket", "unit", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("start_ts").alias("last_ts")
    )


def merged_cells(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The cells of several tables of reservations as one table."""
    return reduce(DataFrame.unionByName, others, first).groupBy("email", "bucket", "unit", "cell").agg(
        F.sum("n").alias("n"), F.max("last_ts").alias("last_ts")
    )


def _inside(low: int, high: int) -> Column:
    none = F.lit(False)
    return reduce(
        lambda a, b: a | b,
        [(F.col("unit") == unit) & F.col("cell").between(first, end - 1) for unit, first, end in tiles(low, high)], none,
    )


def totals_in_range(cells: DataFrame, buckets: Buckets, low: int, high: int, last_all_time: bool = False) -> DataFrame:
    """One row per address for `pivots.pivot_report`: total, and count and last start per bucket, for starts in [low, high]."""
    ranged, anywhere = _inside(low, high), F.col("unit") == CELL_UNITS[0]
    wanted = cells.filter(ranged | anywhere if last_all_time else ranged)
    last = anywhere if last_all_time else ranged
    columns = []
    for name in buckets:
        mine = F.col("bucket") == name
        columns += [
            F.coalesce(F.sum(F.when(mine & ranged, F.col("n"))), F.lit(0)).alias(f"{name}_count"),
            F.max(F.when(mine & last, F.col("last_ts"))).alias(f"{name}_last"),
        ]
    total = F.coalesce(F.sum(F.when((F.col("bucket") == ALL) & ranged, F.col("n"))), F.lit(0)).alias("total_count")
    return wanted.groupBy("email").agg(total, *columns)
