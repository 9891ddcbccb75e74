"""Every operator and report as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.functions import names, status, text
from labmeter.operators import (
    attribution,
    changes,
    fold_store,
    lifetimes,
    pivot_cells,
    pivots,
    sessions,
    uptime,
)
from labmeter.operators.cell_index import CellIndex
from labmeter.plans import listings, usage
from labmeter.sources import sinks
from labmeter.sources.folders import own_folder
from labmeter.sources.samples import NOW, OddTables, SampleTables

Query = Callable[[SparkSession, str], DataFrame]

LOW = "2024-01-10 00:00:00"
MIDDLE = "2024-01-15 00:00:00"
RANGE_LOW, RANGE_HIGH = 883_612_800, 946_684_799
BUCKETS = {
    "urgent": ["1-URGENT"], "high": ["2-HIGH"], "medium": ["3-MEDIUM"],
    "rest": ["4-NOT SPECIFIED", "5-LOW"],
}
USAGE_FILTERS = {
    "labs": ["Lab 0", "Lab 1", "Lab 2", "Lab 3"],
    "owners": [f"user{i}" for i in range(0, 24)],
    "states": ["Active", "Deleted"],
}
EMPLOYEE_FILTERS = {
    "regions": ["AFRICA", "AMERICA", "ASIA", "EUROPE"],
    "managers": [f"Manager {i}" for i in range(6)],
    "labs": ["Lab 0", "Lab 1", "Lab 2", "Lab 3"],
    "states": ["Active", "Deleted"],
    "kinds": ["Customized", "On-Demand"],
}
HOSTS = {"10.240.0": "site-a", "10.240.1": "site-b", "10.240.2": "site-c"}
OVERRIDES = {"10.240.1.15": "TEST LAB"}


def _usage_tables(t: SampleTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t.logins, t.logouts, t.power_log


def _login_events(t: SampleTables) -> DataFrame:
    events = sessions.login_timeline(t.logins, t.logouts)
    return events.drop("kind")


def _closed_login_events(t: SampleTables) -> DataFrame:
    return sessions.with_closing(_login_events(t), t.reservations, NOW)


def _closed_power_events(t: SampleTables) -> DataFrame:
    timeline = sessions.power_timeline(t.power_log)
    return sessions.with_closing(timeline, t.reservations, NOW).drop("kind")


def _addressed(t: SampleTables) -> DataFrame:
    return t.address_events.select(
        "event_id", "ts", "action", names.extract_address(F.col("config_text")).alias("address")
    )


# Scans ---------------------------------------------------------------------


def scan_reservations(t: SampleTables) -> DataFrame:
    return t.reservations


def scan_power_log(t: SampleTables) -> DataFrame:
    return t.power_log


def scan_employees(t: SampleTables) -> DataFrame:
    return t.employees


# Functions and filters -----------------------------------------------------


def vm_fields(t: SampleTables) -> DataFrame:
    vm = F.col("vm_name")
    return t.reservations.select(
        "vm_name", names.vm_owner(vm).alias("owner"), names.vm_lab_prefix(vm).alias("lab_prefix"),
        names.vm_created_text(vm).alias("created_text"),
        names.vm_created_ts(vm).alias("created_ts"), names.vm_reserved_ts(vm).alias("reserved_ts"),
    )


def lab_kind(t: SampleTables) -> DataFrame:
    vm = F.col("vm_name")
    return t.reservations.select(
        "vm_name", names.lab_kind(vm).alias("kind"), names.is_persistent(vm).alias("persistent")
    )


def lab_status(t: SampleTables) -> DataFrame:
    end = F.col("end_ts")
    return t.reservations.select(
        "vm_name", "end_ts", status.lab_status(end, NOW).alias("state"),
        status.lab_status(end, NOW, ("Active", "Inactive")).alias("activity"),
    )


def op_codes(t: SampleTables) -> DataFrame:
    return listings.coded_events(*_usage_tables(t))


def ops_to_log(t: SampleTables) -> DataFrame:
    ops = t.power_ops.unionByName(
        uptime.creation_ops(t.reservations)
    )
    return uptime.ops_to_log(ops)


def flag_filter(t: SampleTables) -> DataFrame:
    staff = t.employees.select("email", "ase")
    kept = [
        staff.filter(status.flag_filter(F.col("ase"), mode)).withColumn("mode", F.lit(mode))
        for mode in (0, 1, 2)
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


def reservations_in_range(t: SampleTables) -> DataFrame:
    inside = status.started_between(F.col("start_ts"), RANGE_LOW, RANGE_HIGH)
    return t.order_reservations.filter(inside)


def duration_text(t: SampleTables) -> DataFrame:
    life = lifetimes.lifetime_seconds(F.col("start_ts"), F.col("end_ts"), NOW)
    return t.reservations.select(
        "vm_name", life.alias("seconds"), text.duration_text(life).alias("spaced"),
        text.duration_text(life, compact=True).alias("compact"),
    )


def elapsed_text(t: SampleTables) -> DataFrame:
    return t.reservations.select(
        "vm_name", text.elapsed_text(F.col("start_ts"), NOW).alias("since_start"),
        text.elapsed_text(F.col("end_ts"), NOW).alias("from_end"),
    )


def elapsed_breakdown(t: SampleTables) -> DataFrame:
    return lifetimes.elapsed_breakdown(t.reservations, NOW)


def pct_text(t: SampleTables) -> DataFrame:
    """Share of logins among the events of each lab, and a share of nothing."""
    coded = listings.coded_events(*_usage_tables(t))
    counts = coded.groupBy("vm_name").agg(
        F.count_if(F.col("op_code") == 0).alias("n_login"),
        F.count_if(F.col("op_code") == 2).alias("n_created"), F.count(F.lit(1)).alias("n"),
    )
    return counts.select(
        "vm_name", text.pct_text(F.col("n_login"), F.col("n")).alias("login_pct"),
        text.pct_text(F.col("n_login"), F.col("n_created")).alias("undefined_pct"),
        text.pct_text(F.col("n_created") - F.col("n_login"), F.col("n")).alias("negative_pct"),
    )


def extract_address(t: SampleTables) -> DataFrame:
    return t.address_events.select(
        "event_id", names.extract_address(F.col("config_text")).alias("address")
    )


def after_marker(t: SampleTables) -> DataFrame:
    return t.address_events.select(
        "event_id", names.after_marker(F.col("router_text")).alias("address")
    )


def lab_buckets(t: SampleTables) -> DataFrame:
    return t.order_reservations.select(
        "vm_name", "lab", pivots.lab_bucket(F.col("lab"), BUCKETS).alias("bucket")
    )


# Sessions and uptime -------------------------------------------------------


def closing_events(t: SampleTables) -> DataFrame:
    logins = sessions.tag_events(t.logins, "login_ts", "in")
    return sessions.closing_events(logins, t.reservations, NOW)


def session_numbers(t: SampleTables) -> DataFrame:
    return sessions.number_sessions(_closed_login_events(t))


def session_pairs(t: SampleTables) -> DataFrame:
    pairs = sessions.session_pairs(_closed_login_events(t))
    length = F.timestamp_diff("SECOND", F.col("login_ts"), F.col("logout_ts"))
    return pairs.withColumn("seconds", length)


def login_totals(t: SampleTables) -> DataFrame:
    totals = sessions.session_totals(_closed_login_events(t))
    return totals.withColumnRenamed("total", "total_seconds")


def login_totals_filled(t: SampleTables) -> DataFrame:
    totals = sessions.session_totals(_login_events(t))
    filled = sessions.zero_fill(totals, t.power_log)
    return filled.withColumnRenamed("total", "total_seconds")


def uptime_totals(t: SampleTables) -> DataFrame:
    totals = sessions.session_totals(_closed_power_events(t))
    return totals.withColumnRenamed("total", "total_seconds")


def uptime_intervals(t: SampleTables) -> DataFrame:
    return uptime.uptime_intervals(t.power_ops)


def _stored(t: SampleTables, events: DataFrame, fold: fold_store.Fold) -> DataFrame:
    """The second half of the events comes first, as late as can be."""
    spark = events.sparkSession
    store = fold_store.FoldStore(spark, own_folder(spark, "fold"), fold)
    late = F.col(fold.ts) < F.lit(MIDDLE).cast("timestamp_ntz")
    store.merge(events.filter(~late), 0)
    store.merge(events.filter(late), 1)
    return store.table()


def session_pairs_stored(t: SampleTables) -> DataFrame:
    pairs = _stored(t, _closed_login_events(t), fold_store.SESSIONS)
    return pairs.withColumn("seconds", F.timestamp_diff("SECOND", F.col("login_ts"), F.col("logout_ts")))


def uptime_intervals_stored(t: SampleTables) -> DataFrame:
    return _stored(t, t.power_ops, fold_store.UPTIME)


def latest_interval(t: SampleTables) -> DataFrame:
    return uptime.latest_interval(uptime_intervals(t))


def creation_ops(t: SampleTables) -> DataFrame:
    return uptime.creation_ops(t.reservations)


def first_last_seen(t: SampleTables) -> DataFrame:
    return lifetimes.first_last_seen(t.logins, t.logouts)


def effective_end(t: SampleTables) -> DataFrame:
    return lifetimes.effective_end(t.reservations, t.power_log, NOW)


# Attribution and routing ---------------------------------------------------


def attribute_events(t: SampleTables) -> DataFrame:
    return attribution.attribute_events(
        _addressed(t), t.reservations, overrides=OVERRIDES
    )


def attribute_events_exact(t: SampleTables) -> DataFrame:
    return attribution.attribute_events(
        _addressed(t), t.reservations, exact=True
    )


def attribute_indexed(t: SampleTables) -> DataFrame:
    """By a stored index whose first batch knows some reservations with an end that the second corrects."""
    labs = t.reservations
    index = CellIndex(labs.sparkSession, own_folder(labs.sparkSession, "cell-index"))
    early = F.col("lab").isin("Lab 0", "Lab 1")
    index.merge(labs.withColumn("end_ts", F.when(early, F.col("start_ts")).otherwise(F.col("end_ts"))), 0)
    index.merge(labs.filter(early), 1, changed=True)
    return index.attribute(_addressed(t), overrides=OVERRIDES, scratch=own_folder(labs.sparkSession, "lookup"))


def attribute_events_now(t: SampleTables) -> DataFrame:
    return attribution.attribute_events(
        _addressed(t), t.reservations, now=NOW
    )


def rejected_events(t: SampleTables) -> DataFrame:
    return attribution.rejected(attribute_events_now(t)).drop("vm_name")


def lookup_first(t: SampleTables) -> DataFrame:
    labs = t.reservations
    persistent = names.is_persistent(F.col("vm_name"))
    return attribution.lookup_first(
        _addressed(t), [labs.filter(persistent), labs.filter(~persistent)]
    )


def route_by_prefix(t: SampleTables) -> DataFrame:
    return attribution.route_by_prefix(_addressed(t), "address", HOSTS)


def route_events(t: SampleTables) -> DataFrame:
    stored = attribution.accepted(attribute_events(t))
    return stored.select("vm_name", "ts", sinks.target_table(F.col("action")).alias("target"))


def orphan_events(t: SampleTables) -> DataFrame:
    active = t.reservations.filter(status.is_active(F.col("end_ts"), NOW))
    return attribution.orphan_events(t.power_log, active)


# Reports -------------------------------------------------------------------


def usage_persistent(t: SampleTables) -> DataFrame:
    return usage.usage_persistent(
        t.reservations, *_usage_tables(t), NOW, USAGE_FILTERS
    )


def usage_persistent_all(t: SampleTables) -> DataFrame:
    return usage.usage_persistent(t.reservations, *_usage_tables(t), NOW)


def usage_regular(t: SampleTables) -> DataFrame:
    logins, logouts, _ = _usage_tables(t)
    return usage.usage_regular(
        t.reservations, logins, logouts, NOW, USAGE_FILTERS
    )


def usage_ratio_minutes(t: SampleTables) -> DataFrame:
    return usage.usage_ratio_minutes(
        t.reservations, *_usage_tables(t), NOW
    )


def event_timeline(t: SampleTables) -> DataFrame:
    return listings.event_timeline(
        *_usage_tables(t), t.reservations, NOW,
        {"labs": ["Lab 0", "lab 1"], "kinds": ["Customized"]},
    )


def session_list(t: SampleTables) -> DataFrame:
    return listings.session_list(
        *_usage_tables(t), t.reservations, {"labs": ["Lab 0", "Lab 1"]}
    )


def labs_by_user(t: SampleTables) -> DataFrame:
    return listings.labs_by_user(
        t.reservations, t.employees, NOW, EMPLOYEE_FILTERS
    )


def labs_by_region(t: SampleTables) -> DataFrame:
    return listings.labs_by_region(
        t.reservations, t.employees, NOW, EMPLOYEE_FILTERS,
        flag_mode=0,
    )


def reservation_summary(t: SampleTables) -> DataFrame:
    return pivots.reservation_summary(
        t.order_reservations, t.employees, RANGE_LOW, RANGE_HIGH
    )


def reservation_pivot(t: SampleTables) -> DataFrame:
    return pivots.reservation_pivot(
        t.order_reservations, t.employees, BUCKETS,
        RANGE_LOW, RANGE_HIGH,
    )


def reservation_pivot_all(t: SampleTables) -> DataFrame:
    return pivots.reservation_pivot(
        t.order_reservations, t.employees, BUCKETS,
        RANGE_LOW, RANGE_HIGH, last_all_time=True, keep_all=True,
    )


def reservation_pivot_cells(t: SampleTables) -> DataFrame:
    cells = pivot_cells.pivot_cells(t.order_reservations, BUCKETS)
    totals = pivot_cells.totals_in_range(cells, BUCKETS, RANGE_LOW, RANGE_HIGH)
    return pivots.pivot_report(totals, t.employees, BUCKETS)


def reservation_pivot_all_cells(t: SampleTables) -> DataFrame:
    cells = pivot_cells.pivot_cells(t.order_reservations, BUCKETS)
    totals = pivot_cells.totals_in_range(cells, BUCKETS, RANGE_LOW, RANGE_HIGH, last_all_time=True)
    return pivots.pivot_report(totals, t.employees, BUCKETS, keep_all=True)


def upserted_changes(t: SampleTables) -> DataFrame:
    """All changes first, the deletions again after them, out of order."""
    spark = t.reservations.sparkSession
    path, pulled = own_folder(spark, "changes"), extract_changes_deleted(t)
    middle = F.col("modified") < F.lit(MIDDLE).cast("timestamp_ntz")
    for part in (pulled.filter(~middle), pulled.filter(middle), pulled):
        sinks.upsert_changes(part, path, buckets=8)
    return sinks.stored_changes(spark, path)


def _changes(t: SampleTables, only: str | None) -> DataFrame:
    return changes.extract_changes(
        t.reservations, t.employees, t.power_log,
        LOW, NOW, only,
    )


def extract_changes_all(t: SampleTables) -> DataFrame:
    return _changes(t, None)


def extract_changes_deleted(t: SampleTables) -> DataFrame:
    return _changes(t, "deleted")


def latest_changes(t: SampleTables) -> DataFrame:
    return changes.latest_changes(extract_changes_deleted(t))


def _registered(build: Callable[[SampleTables], DataFrame], tables: type[SampleTables] = SampleTables) -> Query:
    return lambda spark, sf_dir: build(tables(spark, sf_dir))


ALL: dict[str, Query] = {
    build.__name__: _registered(build)
    for build in (
        scan_reservations, scan_power_log, scan_employees,
        vm_fields, lab_kind, lab_status, op_codes, ops_to_log, flag_filter,
        reservations_in_range, duration_text, elapsed_text, elapsed_breakdown, pct_text,
        extract_address, after_marker, lab_buckets,
        closing_events, session_numbers, session_pairs, login_totals, login_totals_filled,
        uptime_totals, uptime_intervals, latest_interval, creation_ops, first_last_seen,
        session_pairs_stored, uptime_intervals_stored,
        effective_end,
        attribute_events, attribute_events_exact, attribute_indexed, attribute_events_now, rejected_events,
        lookup_first, route_by_prefix, route_events, orphan_events,
        usage_persistent, usage_persistent_all, usage_regular, usage_ratio_minutes,
        event_timeline, session_list, labs_by_user, labs_by_region,
        reservation_summary, reservation_pivot, reservation_pivot_all,
        reservation_pivot_cells, reservation_pivot_all_cells,
        extract_changes_all, extract_changes_deleted, latest_changes, upserted_changes,
    )
}

# Again over tables with missing values, shared addresses and names in any case.
ODD = (
    scan_power_log, lab_status, op_codes, closing_events, session_pairs, login_totals_filled, uptime_totals,
    uptime_intervals, first_last_seen, effective_end, attribute_events, lookup_first, rejected_events,
    usage_persistent, usage_regular, usage_ratio_minutes, event_timeline, session_list, labs_by_user, labs_by_region,
    reservation_summary, reservation_pivot, reservation_pivot_all, extract_changes_all, latest_changes,
)
ALL |= {f"{build.__name__}_odd": _registered(build, OddTables) for build in ODD}
