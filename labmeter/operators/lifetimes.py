"""When a lab began and ended, and who owns it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import clipped_end
from labmeter.functions.names import is_persistent, vm_created_text, vm_created_ts
from labmeter.functions.status import lab_status
from labmeter.functions.text import duration_text


def first_last_seen(logins: DataFrame, logouts: DataFrame) -> DataFrame:
    """First login and last logout of each VM."""
    none = F.lit(None).cast("timestamp_ntz")
    seen = logins.select("vm_name", "login_ts", none.alias("logout_ts")).unionByName(
        logouts.select("vm_name", none.alias("login_ts"), "logout_ts")
    )
    return seen.groupBy("vm_name").agg(
        F.min("login_ts").alias("login_time"), F.max("logout_ts").alias("logout_time")
    )


def deletions(power_log: DataFrame) -> DataFrame:
    return power_log.filter(F.lower("operation") == "deleted")


def last_deletion(power_log: DataFrame) -> DataFrame:
    """(vm_name, deleted_ts), one row per VM, so a join with it cannot fan out."""
    return deletions(power_log).groupBy("vm_name").agg(F.max("log_ts").alias("deleted_ts"))


def with_real_end(reservations: DataFrame, power_log: DataFrame) -> DataFrame:
    """Reservations with `real_end`: the last deletion if any, else the planned end."""
    joined = reservations.join(last_deletion(power_log), "vm_name", "left")
    return joined.withColumn("real_end", F.coalesce("deleted_ts", "end_ts")).drop("deleted_ts")


def effective_end(
    reservations: DataFrame, power_log: DataFrame, now: Column | datetime | str
) -> DataFrame:
    """Persistent labs with state and end: planned while active, else the deletion if logged."""
    persistent = reservations.filter(is_persistent(F.col("vm_name")))
    joined = persistent.join(last_deletion(power_log), "vm_name", "left")
    state = lab_status(F.col("end_ts"), now)
    return joined.select(
        "vm_name", vm_created_text(F.col("vm_name")).alias("created_text"),
        F.when(state == "Active", F.col("end_ts")).otherwise(F.col("deleted_ts")).alias("end_ts"),
        state.alias("state"), "lab", "email",
    )


def lifetime_seconds(start: Column, end: Column, now: Column | datetime | str) -> Column:
    return F.timestamp_diff("SECOND", start, clipped_end(end, now))


def created_lifetimes(
    reservations: DataFrame, power_log: DataFrame, now: Column | datetime | str
) -> DataFrame:
    """Reservations with `life_seconds` from the time in the VM name to the real end or `now`."""
    ended = with_real_end(reservations, power_log)
    life = lifetime_seconds(vm_created_ts(F.col("vm_name")), F.col("real_end"), now)
    return ended.withColumn("life_seconds", life).drop("real_end")


def elapsed_breakdown(reservations: DataFrame, now: Column | datetime | str) -> DataFrame:
    """Planned lifetime of every reservation up to `now`, in words."""
    start, end = F.col("start_ts"), F.col("end_ts")
    return reservations.select(
        "vm_name", start.alias("departure"), clipped_end(end, now).alias("arrival"),
        duration_text(lifetime_seconds(start, end, now)).alias("difference"),
    )


def with_employee(reservations: DataFrame, employees: DataFrame) -> DataFrame:
    """Employee columns beside each reservation; Spark picks the join by measured size."""
    return reservations.join(employees, "email", "left")
