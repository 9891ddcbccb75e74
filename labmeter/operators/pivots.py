"""Reservation counts and last reservations per person and lab, in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import display
from labmeter.functions.status import started_between, yes_no

Buckets = Mapping[str, Sequence[str]]


def _in_bucket(lab: Column, names: Sequence[str]) -> Column:
    return F.lower(lab).isin(*[n.lower() for n in names])


def lab_bucket(lab: Column, buckets: Buckets) -> Column:
    """Name of the bucket that lists a lab, or NULL."""
    bucket = F.lit(None).cast("string")
    for name, labs in reversed(list(buckets.items())):
        bucket = F.when(_in_bucket(lab, labs), name).otherwise(bucket)
    return bucket


def _per_email(
    reservations: DataFrame, buckets: Buckets, counted: Column, last: Column
) -> DataFrame:
    """One row per mail address: total, and count and last start per bucket.

    Every column is a conditional aggregate of the same pass, and all of them
    combine map-side: a busy address costs one row per task. A NULL address has a
    total but belongs to no bucket: buckets are looked up by address.
    """
    per_bucket = []
    for name, labs in buckets.items():
        member = _in_bucket(F.col("lab"), labs) & F.col("email").isNotNull()
        per_bucket += [
            F.count_if(member & counted).alias(f"{name}_count"),
            F.max(F.when(member & last, F.col("start_ts"))).alias(f"{name}_last"),
        ]
    total = F.count_if(counted).alias("total_count")
    return reservations.groupBy("email").agg(total, *per_bucket)


def _bucket_columns(buckets: Buckets) -> list[Column]:
    """Counts default to 0 and last reservations to empty text."""
    columns = []
    for name in buckets:
        columns += [
            F.coalesce(f"{name}_count", F.lit(0)).alias(f"{name}_count"),
            F.coalesce(display(F.col(f"{name}_last")), F.lit("")).alias(f"{name}_last"),
        ]
    return columns


def reservation_pivot(
    reservations: DataFrame,
    employees: DataFrame,
    buckets: Buckets,
    low: int,
    high: int,
    last_all_time: bool = False,
    keep_all: bool = False,
) -> DataFrame:
    """Reservations per person, with a count and a last start per lab bucket.

    Counts cover starts in [low, high] (epoch seconds). By default the last start
    does too and only people with a reservation in the range appear, employees or
    not. `last_all_time` takes the last start from all time. `keep_all` gives a
    row to every employee, and only to them.
    """
    ranged = started_between(F.col("start_ts"), low, high)
    if not (last_all_time or keep_all):
        reservations = reservations.filter(ranged)
    last = F.lit(True) if last_all_time else ranged
    return pivot_report(_per_email(reservations, buckets, ranged, last), employees, buckets, keep_all)


def pivot_report(totals: DataFrame, employees: DataFrame, buckets: Buckets, keep_all: bool = False) -> DataFrame:
    """The report's columns from totals per mail address, taken directly or from cells (`pivot_cells`)."""
    total = F.coalesce("total_count", F.lit(0)).alias("total_count")

    if not keep_all:
        joined = totals.filter("total_count > 0").join(employees, "email", "left")
        return joined.select(
            "full_name", "manager", "region", "location", "department",
            yes_no(F.col("ase")).alias("ase"), total, *_bucket_columns(buckets),
        )
    # Employees without a reservation who look alike in every shown column are one group.
    groups = totals.withColumnRenamed("email", "reserved_by")
    joined = employees.join(groups, F.col("email") == F.col("reserved_by"), "left")
    shown = ["full_name", "manager", "region", "location"]
    rows = joined.select(*shown, "reserved_by", total, *_bucket_columns(buckets))
    return rows.distinct().drop("reserved_by")


def reservation_summary(
    reservations: DataFrame, employees: DataFrame, low: int, high: int
) -> DataFrame:
    """Reservation count and last start per person and lab, for starts in [low, high].

    Reservations shrink to one row per address and lab before they meet employees. Labs that differ in
    case are one lab, shown in its first spelling by code points.
    """
    ranged = reservations.filter(started_between(F.col("start_ts"), low, high))
    small = ranged.groupBy("email", F.lower("lab").alias("folded_lab")).agg(
        F.min("lab").alias("lab"), F.count("vm_name").alias("n"), F.max("start_ts").alias("last_ts")
    )
    keys = ["full_name", "manager", "region", "location", "department", "folded_lab", "email", "ase"]
    shown = ["full_name", "manager", "region", "location", "department", "lab", "email"]
    return (
        small.join(employees, "email", "left").groupBy(*keys)
        .agg(F.min("lab").alias("lab"), F.sum("n").alias("reservations_count"), F.max("last_ts").alias("last_ts"))
        .select(
            *shown, "reservations_count", display(F.col("last_ts")).alias("last_reservation"),
            yes_no(F.col("ase")).alias("ase"),
        )
    )
