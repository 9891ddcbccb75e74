"""Lists: raw events, sessions, labs by user and by region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import display
from labmeter.functions.names import lab_kind, vm_created_text, vm_lab_prefix, vm_owner
from labmeter.functions.status import (
    LOGIN_CODE,
    LOGOUT_CODE,
    flag_filter,
    is_active,
    lab_status,
    op_code,
    report_filter,
)
from labmeter.operators.lifetimes import with_employee
from labmeter.operators.ordered import cut_blocks, spread_group, unfold_blocks
from labmeter.operators.sessions import KIND_KEYS, login_timeline, power_timeline, session_pairs

Clock = Column | datetime | str
Filters = Mapping[str, Sequence[str]]

# The order each report is read in, for `sorted_report`. The timeline sorts itself.
REPORT_ORDER = {
    "first_last_seen": [("vm_name", "asc")],
    "usage_persistent": [("state", "asc"), ("created_text", "desc")],
    "usage_regular": [("state", "asc"), ("start_ts", "desc")],
    "session_list": [("vm_name", "asc"), ("login_time", "asc")],
    "extract_changes": [("modified", "asc")],
}


def sorted_report(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Order rows by (column, "asc" or "desc") pairs; NULL sorts low, as in the original.

    A range sort cannot split equal keys. So equal rows are counted first and
    unfold after the sort, and ties are broken by a hash of the row.
    """
    order = {"asc": Column.asc_nulls_first, "desc": Column.desc_nulls_last}
    wanted = [order[direction](F.col(f"key.{name}")) for name, direction in spec]
    counted = spread_group(df, *map(F.col, df.columns)).agg(F.count(F.lit(1)).alias("times"))
    ordered = cut_blocks(counted, "times").orderBy(*wanted, F.xxhash64("key"), "block")
    return unfold_blocks(ordered, "times", "copy").select("key.*")


def _labelled(reservations: DataFrame, now: Clock) -> DataFrame:
    return reservations.withColumn("state", lab_status(F.col("end_ts"), now)).withColumn(
        "kind", lab_kind(F.col("vm_name"))
    )


def coded_events(logins: DataFrame, logouts: DataFrame, power_log: DataFrame) -> DataFrame:
    """(vm_name, ts, operation, op_code) of all three event tables."""

    def coded(df: DataFrame, ts: str, operation: Column, code: Column) -> DataFrame:
        return df.select(
            "vm_name", F.col(ts).alias("ts"), operation.alias("operation"), code.alias("op_code")
        )

    operation = F.col("operation")
    return (
        coded(logins, "login_ts", F.lit("Login"), F.lit(LOGIN_CODE))
        .unionByName(coded(logouts, "logout_ts", F.lit("Logout"), F.lit(LOGOUT_CODE)))
        .unionByName(coded(power_log, "log_ts", operation, op_code(operation)))
    )


def event_timeline(
    logins: DataFrame,
    logouts: DataFrame,
    power_log: DataFrame,
    reservations: DataFrame,
    now: Clock,
    filters: Filters | None = None,
) -> DataFrame:
    """Every event of the chosen labs, newest first."""
    labs = report_filter(_labelled(reservations, now), **(filters or {}))
    events = coded_events(logins, logouts, power_log)
    rows = events.join(labs.select("vm_name", "state", "kind"), "vm_name")
    vm = F.col("vm_name")
    return sorted_report(rows, [("ts", "desc")]).select(
        vm_owner(vm).alias("owner"), vm_lab_prefix(vm).alias("lab"), "state", "kind",
        vm_created_text(vm).alias("created_text"), display(F.col("ts")).alias("timestamp"),
        "operation", "op_code",
    )


def session_list(
    logins: DataFrame,
    logouts: DataFrame,
    power_log: DataFrame,
    reservations: DataFrame,
    filters: Filters | None = None,
) -> DataFrame:
    """Sessions of logins and of power events as text, for the chosen labs.

    Nothing is closed at the present time, so a session may lack its end.
    """
    events = login_timeline(logins, logouts).unionByName(power_timeline(power_log))
    labs = report_filter(reservations, **(filters or {})).select("vm_name")
    pairs = session_pairs(events.join(labs, "vm_name", "left_semi"), KIND_KEYS)
    return pairs.select(
        "vm_name", display(F.col("login_ts")).alias("login_time"),
        display(F.col("logout_ts")).alias("logout_time"),
    )


def _labs_with_employees(
    reservations: DataFrame,
    employees: DataFrame,
    now: Clock,
    filters: Filters | None,
    flag_mode: int,
) -> DataFrame:
    """Labs of known employees. The flag filter drops the rest, which makes the join inner."""
    joined = with_employee(_labelled(reservations, now), employees)
    chosen = report_filter(joined, **(filters or {})).filter(flag_filter(F.col("ase"), flag_mode))
    gone = F.when(is_active(F.col("end_ts"), now), F.lit(None)).otherwise(F.col("end_ts"))
    return chosen.withColumn("deleted_ts", gone).withColumn(
        "deleted_text",
        F.when(is_active(F.col("end_ts"), now), "").otherwise(
            F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss")
        ),
    ).withColumn("created_text", vm_created_text(F.col("vm_name")))


def labs_by_user(
    reservations: DataFrame,
    employees: DataFrame,
    now: Clock,
    filters: Filters | None = None,
    flag_mode: int = 2,
) -> DataFrame:
    """Labs with their owner's place in the company.

    An active lab has no deletion time: NULL in `deleted_ts`, empty in `deleted_text`.
    """
    return _labs_with_employees(reservations, employees, now, filters, flag_mode).select(
        "full_name", "lab", "created_text", "deleted_ts", "deleted_text", "state", "kind",
        "region", "location", "manager", F.col("business_unit").alias("group"),
    )


def labs_by_region(
    reservations: DataFrame,
    employees: DataFrame,
    now: Clock,
    filters: Filters | None = None,
    flag_mode: int = 2,
) -> DataFrame:
    """Lab lifetimes, state and kind by region."""
    return _labs_with_employees(reservations, employees, now, filters, flag_mode).select(
        "region", "location", "start_ts", "deleted_ts", "deleted_text", "state", "kind"
    )
