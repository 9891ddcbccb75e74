"""Incremental extract of reservations that changed in an open time window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import moment
from labmeter.functions.names import lab_kind, vm_reserved_ts
from labmeter.operators.lifetimes import deletions, with_employee

EMPLOYEE_COLUMNS = [
    "full_name", "business_title", "region", "location", "manager", "business_unit",
    "department", "ase",
]


def extract_changes(
    reservations: DataFrame,
    employees: DataFrame,
    power_log: DataFrame,
    low: Column | datetime | str,
    now: Column | datetime | str,
    only: str | None = None,
) -> DataFrame:
    """Reservations with their employee and `modified`, for low < modified < now.

    `modified` is the time of a power-log row, or the time in the VM name where
    there is none; a VM appears once per log row. `only="deleted"` reads
    deletions only and leaves out the operation.
    """
    log = deletions(power_log) if only == "deleted" else power_log
    # Two parts of one left join. Logged changes are an inner join, which skew
    # handling can split on the log side and whose time bound reaches the scan;
    # the rest needs only the names that occur in the log.
    recent = F.col("log_ts").isNull() | _within(F.col("log_ts"), low, now)
    untouched = reservations.join(log.select("vm_name").distinct(), "vm_name", "left_anti")
    both = logged_changes(reservations, log.filter(recent)).unionByName(
        first_changes(untouched), allowMissingColumns=True
    )
    changes = describe_changes(both.filter(_within(F.col("modified"), low, now)), employees)
    return changes.drop("operation") if only == "deleted" else changes


def logged_changes(reservations: DataFrame, log: DataFrame) -> DataFrame:
    """One change per log row, modified at its time."""
    modified = F.coalesce("log_ts", "reserve_time")
    return _with_reserve_time(reservations).join(log, "vm_name").withColumn(
        "modified", modified
    ).drop("log_ts")


def first_changes(reservations: DataFrame) -> DataFrame:
    """One change per reservation, modified when it was made."""
    return _with_reserve_time(reservations).withColumn("modified", F.col("reserve_time"))


def describe_changes(changes: DataFrame, employees: DataFrame) -> DataFrame:
    """Changes with the kind of lab and its owner's employee columns; `modified` last."""
    described = with_employee(
        changes.withColumn("lab_type", lab_kind(F.col("vm_name"))),
        employees.select("email", *EMPLOYEE_COLUMNS),
    )
    return described.select(*[c for c in described.columns if c != "modified"], "modified")


def _with_reserve_time(reservations: DataFrame) -> DataFrame:
    return reservations.withColumn("reserve_time", vm_reserved_ts(F.col("vm_name")))


def _within(ts: Column, low: Column | datetime | str, now: Column | datetime | str) -> Column:
    return (ts > moment(low)) & (ts < moment(now))


def latest_changes(changes: DataFrame) -> DataFrame:
    """The newest change of each VM: what an upsert keyed by `vm_name` leaves."""
    others = [c for c in changes.columns if c not in ("vm_name", "modified")]
    newest = F.max(F.struct("modified", *others)).alias("newest")
    return changes.groupBy("vm_name").agg(newest).select("vm_name", "newest.*")
