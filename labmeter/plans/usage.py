"""Usage percentages per lab."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.names import is_persistent, vm_created_text, vm_owner
from labmeter.functions.status import lab_status, report_filter
from labmeter.functions.text import duration_text, pct_text
from labmeter.operators.lifetimes import created_lifetimes, lifetime_seconds
from labmeter.operators.sessions import (
    LOGIN,
    POWER,
    login_timeline,
    power_timeline,
    session_totals,
    totals_by_kind,
    with_closing,
)

Clock = Column | datetime | str
Filters = Mapping[str, Sequence[str]]


def _chosen_labs(reservations: DataFrame, now: Clock, filters: Filters | None) -> DataFrame:
    labs = reservations.withColumn("state", lab_status(F.col("end_ts"), now))
    return report_filter(labs, **(filters or {}))


def _events_of(labs: DataFrame, events: DataFrame, filters: Filters | None) -> DataFrame:
    """Drop events of labs the report leaves out, before they are shuffled.

    Without filters the report shows every lab, and the join would cost more than it saves.
    """
    return events.join(labs.select("vm_name"), "vm_name", "left_semi") if filters else events


def usage_persistent(
    reservations: DataFrame,
    logins: DataFrame,
    logouts: DataFrame,
    power_log: DataFrame,
    now: Clock,
    filters: Filters | None = None,
) -> DataFrame:
    """Persistent labs: lifetime, share of it powered on, share of that logged in.

    Lifetime runs from the time in the VM name to the last deletion, else the
    planned end, at most `now`. A lab without logins counts 0 seconds; a lab
    without power events is left out.
    """
    persistent = reservations.filter(is_persistent(F.col("vm_name")))
    labs = _chosen_labs(persistent, now, filters)
    timeline = login_timeline(logins, logouts).unionByName(power_timeline(power_log))
    timeline = _events_of(labs, timeline.filter(is_persistent(F.col("vm_name"))), filters)
    totals = totals_by_kind(with_closing(timeline, labs, now)).filter(f"has_{POWER}").select(
        "vm_name", F.coalesce("login_total", F.lit(0)).alias("login_total"), "power_total"
    )
    vm, life = F.col("vm_name"), F.col("life_seconds")
    return created_lifetimes(labs, power_log, now).join(totals, "vm_name").select(
        "vm_name", vm_owner(vm).alias("owner"), "lab", vm_created_text(vm).alias("created_text"),
        "state", duration_text(life, compact=True).alias("total_duration"),
        pct_text(F.col("power_total"), life).alias("powered_on_pct"),
        pct_text(F.col("login_total"), F.col("power_total")).alias("login_powered_on_pct"),
    )


def usage_regular(
    reservations: DataFrame,
    logins: DataFrame,
    logouts: DataFrame,
    now: Clock,
    filters: Filters | None = None,
) -> DataFrame:
    """Regular labs with a login event: lifetime from the planned start, and share logged in."""
    regular = reservations.filter(~is_persistent(F.col("vm_name")))
    labs = _chosen_labs(regular, now, filters)
    timeline = login_timeline(logins, logouts).filter(~is_persistent(F.col("vm_name")))
    timeline = _events_of(labs, timeline, filters)
    totals = session_totals(with_closing(timeline, labs, now))
    vm = F.col("vm_name")
    life = lifetime_seconds(F.col("start_ts"), F.col("end_ts"), now)
    return labs.join(totals, "vm_name").select(
        "vm_name", vm_owner(vm).alias("owner"), "lab", vm_created_text(vm).alias("created_text"),
        "start_ts", "state", duration_text(life).alias("total_duration"),
        pct_text(F.col("total"), life).alias("active_pct"),
    )


def usage_ratio_minutes(
    reservations: DataFrame,
    logins: DataFrame,
    logouts: DataFrame,
    power_log: DataFrame,
    now: Clock,
) -> DataFrame:
    """Active labs with both kinds of events: login minutes against powered-on minutes.

    Logouts and closings of persistent labs only, so the ratio of others is NULL.
    """
    persistent = is_persistent(F.col("vm_name"))
    login_events = login_timeline(logins, logouts.filter(persistent))
    login_events = with_closing(login_events, reservations.filter(persistent), now)
    power_events = with_closing(power_timeline(power_log), reservations, now)
    totals = totals_by_kind(login_events.unionByName(power_events), "MINUTE")
    labs = reservations.withColumn("active", lab_status(F.col("end_ts"), now, ("Active", "Inactive")))
    return (
        totals.filter(f"has_{LOGIN} and has_{POWER}")
        .join(labs.filter(F.col("active") == "Active"), "vm_name")
        .select("vm_name", "active",
                pct_text(F.col("login_total"), F.col("power_total")).alias("percent"))
    )
