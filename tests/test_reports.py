"""Reports: rules that the sample tables do not reach, and the shape of the plans."""

from datetime import datetime

import __spark_entry__ as entry_points
from labmeter.catalog.queries import ALL
from labmeter.operators import changes, lifetimes, ordered, pivots
from labmeter.plans import listings, usage
from tests.helpers import NOW, at, employees, plan_of, reservations, rows

DIR = "/root/testdata/sf0.001"
MADE = "2024-01-01-08:00:00:000001"
P, R = f"Lab A-Persistent-(ann)-{MADE}", f"Lab B-(bob)-{MADE}"


def table(spark, names, data):
    return spark.createDataFrame(data, names)


def logins(spark, *data):
    return table(spark, "vm_name string, login_ts timestamp_ntz", list(data))


def logouts(spark, *data):
    return table(spark, "vm_name string, logout_ts timestamp_ntz", list(data))


def power(spark, *data):
    return table(spark, "vm_name string, log_ts timestamp_ntz, operation string", list(data))


def labs(spark, **changed):
    both = {"start_ts": at("08:00"), "end_ts": at("23:00"), **changed}
    return reservations(spark, [
        {"vm_name": P, "lab": "Lab A", "email": "ann@x", **both},
        {"vm_name": R, "lab": "Lab B", "email": "bob@x", **both},
    ])


def test_usage_persistent(spark):
    log = power(spark, (P, at("09:00"), "powered-on"), (P, at("10:00"), "Suspended"),
                (P, at("11:00"), "Created"))
    report = usage.usage_persistent(
        labs(spark), logins(spark, (P, at("11:30"))), logouts(spark), log, NOW
    )
    assert [tuple(r) for r in report.collect()] == [
        (P, "ann", "Lab A", MADE, "Active", "0 days 4 hours 0 minutes 0seconds", "50.0%", "25.0%")
    ]
    # A deletion ends the lifetime; no uptime makes both shares undefined.
    gone = power(spark, (P, at("09:00"), "Deleted"), (P, at("09:30"), "deleted"))
    report = usage.usage_persistent(
        labs(spark, end_ts=at("11:00")), logins(spark), logouts(spark), gone, NOW,
        {"labs": ["lab a"], "owners": ["ann"], "states": ["Deleted"]},
    )
    assert [tuple(r)[4:] for r in report.collect()] == [
        ("Deleted", "0 days 1 hours 30 minutes 0seconds", None, None)
    ]
    without_power = usage.usage_persistent(
        labs(spark), logins(spark, (P, at("11:30"))), logouts(spark), power(spark), NOW)
    assert without_power.count() == 0


def test_usage_regular(spark):
    report = usage.usage_regular(
        labs(spark), logins(spark, (R, at("09:00")), (P, at("09:00"))),
        logouts(spark, (R, at("10:00"))), NOW)
    assert [tuple(r)[1:] for r in report.collect()] == [
        ("bob", "Lab B", MADE, at("08:00"), "Active", "0 days 4 hours 0 minutes 0 seconds", "25.0%")
    ]
    endless = usage.usage_regular(
        labs(spark, end_ts=None), logins(spark, (R, at("09:00"))), logouts(spark), NOW)
    assert [(r.state, r.total_duration, r.active_pct) for r in endless.collect()] == [
        ("Deleted", None, None)
    ]
    assert usage.usage_regular(labs(spark), logins(spark), logouts(spark), NOW).count() == 0


def test_usage_ratio_ignores_regular_logouts(spark):
    on = power(spark, (P, at("10:00"), "Powered-On"), (R, at("10:00"), "Powered-On"))
    report = usage.usage_ratio_minutes(
        labs(spark), logins(spark, (P, at("11:00")), (R, at("11:00"))),
        logouts(spark, (R, at("11:30")), (P, at("11:30"))), on, NOW)
    assert rows(report) == {(P, "Active", "25.0%"): 1, (R, "Active", None): 1}


def test_timeline_is_newest_first(spark):
    report = listings.event_timeline(
        logins(spark, (P, at("09:00"))), logouts(spark, (P, at("11:00"))),
        power(spark, (P, at("10:00"), None), (P, at("08:00"), "powered-on")),
        labs(spark), NOW, {"kinds": ["Customized"]})
    assert [(r.timestamp, r.operation, r.op_code) for r in report.collect()] == [
        ("2024/01/01 11:00:00", "Logout", 1), ("2024/01/01 10:00:00", None, 5),
        ("2024/01/01 09:00:00", "Login", 0), ("2024/01/01 08:00:00", "powered-on", 3),
    ]


def test_sorted_report(spark):
    df = table(spark, "a int, b int", [(1, 1), (None, 2), (1, 3)])
    ordered = listings.sorted_report(df, [("a", "asc"), ("b", "desc")])
    assert [tuple(r) for r in ordered.collect()] == [(None, 2), (1, 3), (1, 1)]


def test_labs_by_user_and_region(spark):
    staff = employees(spark, [
        {"email": "ann@x", "full_name": "Ann", "region": "R1", "manager": "M", "ase": True},
        {"email": "bob@x", "full_name": "Bob", "region": "R1", "manager": "M", "ase": None},
    ])
    known = listings.labs_by_user(labs(spark), staff, NOW, {"regions": ["r1"]})
    assert [(r.full_name, r.deleted_ts, r.deleted_text) for r in known.collect()] == [
        ("Ann", None, "")]
    ended = listings.labs_by_region(labs(spark, end_ts=at("11:00")), staff, NOW, flag_mode=1)
    assert [(r.region, r.deleted_ts, r.deleted_text, r.state) for r in ended.collect()] == [
        ("R1", at("11:00"), "2024-01-01 11:00:00", "Deleted")]


def test_effective_end(spark):
    log = power(spark, (P, at("09:00"), "Deleted"), (P, at("10:00"), "DELETED"))
    assert [r.end_ts for r in lifetimes.effective_end(labs(spark), log, NOW).collect()] == [
        at("23:00")]
    over = labs(spark, end_ts=at("11:00"))
    assert [r.end_ts for r in lifetimes.effective_end(over, log, NOW).collect()] == [at("10:00")]
    unlogged = lifetimes.effective_end(over, power(spark), NOW)
    assert [r.end_ts for r in unlogged.collect()] == [None]


def epoch(ts):
    return int((ts - datetime(1970, 1, 1)).total_seconds())


def test_pivots(spark):
    staff = employees(spark, [
        {"email": "ann@x", "full_name": "Ann"}, {"email": "bob@x", "full_name": "Bob"},
        {"email": "cat@x", "full_name": "Twin"}, {"email": "dan@x", "full_name": "Twin"},
    ])
    data = [("ann@x", "a1", "08:00"), ("ann@x", "A2", "09:00"), ("ann@x", "b", "10:00"),
            ("bob@x", "b", "06:00"), ("eve@x", "a1", "08:30"), (None, "b", "08:30")]
    res = reservations(spark, [
        {"vm_name": f"v{i}", "email": e, "lab": lab, "start_ts": at(t)}
        for i, (e, lab, t) in enumerate(data)
    ])
    buckets = {"a": ["a1", "a2"], "b": ["b"]}
    low, high = epoch(at("08:00")), epoch(at("09:00"))
    ranged = pivots.reservation_pivot(res, staff, buckets, low, high)
    columns = ("full_name", "total_count", "a_count", "a_last", "b_count", "b_last")
    day = "2024/01/01"
    assert rows(ranged.select(*columns)) == {
        ("Ann", 2, 2, f"{day} 09:00:00", 0, ""): 1, (None, 1, 1, f"{day} 08:30:00", 0, ""): 1,
        (None, 1, 0, "", 0, ""): 1,
    }
    everyone = pivots.reservation_pivot(
        res, staff, buckets, low, high, last_all_time=True, keep_all=True)
    assert rows(everyone.select(*columns)) == {
        ("Ann", 2, 2, f"{day} 09:00:00", 0, f"{day} 10:00:00"): 1,
        ("Bob", 0, 0, "", 0, f"{day} 06:00:00"): 1, ("Twin", 0, 0, "", 0, ""): 1,
    }
    summary = pivots.reservation_summary(res, staff, low, high)
    assert rows(summary.select("full_name", "lab", "email", "reservations_count")) == {
        ("Ann", "a1", "ann@x", 1): 1, ("Ann", "A2", "ann@x", 1): 1,
        (None, "a1", "eve@x", 1): 1, (None, "b", None, 1): 1,
    }


def test_change_window_is_open(spark):
    staff = employees(spark, [{"email": "ann@x", "full_name": "Ann"}])
    log = power(spark, *[(P, at(t), "Deleted") for t in ("09:00", "09:30", "12:00")],
                (P, at("10:00"), "Suspended"), (R, None, "Deleted"))

    def modified(only, low):
        feed = changes.extract_changes(labs(spark), staff, log, at(low), NOW, only)
        return sorted((r.vm_name == P, r.modified) for r in feed.collect())

    assert modified("deleted", "09:00") == [(True, at("09:30"))]
    assert modified(None, "09:00") == [(True, at("09:30")), (True, at("10:00"))]
    # A log row without a time counts by the time in the name.
    assert modified("deleted", "07:00") == [
        (False, at("08:00")), (True, at("09:00")), (True, at("09:30"))]
    feed = changes.extract_changes(labs(spark), staff, log, at("07:00"), NOW, "deleted")
    newest = {r.vm_name: r.modified for r in changes.latest_changes(feed).collect()}
    assert newest == {P: at("09:30"), R: at("08:00")}


def test_unparsable_name_needs_a_log(spark):
    odd = reservations(spark, [{"vm_name": "odd", "email": "ann@x"}])
    staff = employees(spark, [])
    assert changes.extract_changes(odd, staff, power(spark), at("07:00"), NOW).count() == 0
    log = power(spark, ("odd", at("09:00"), "Suspended"))
    assert changes.extract_changes(odd, staff, log, at("07:00"), NOW).count() == 1


def test_pivots_scan_reservations_once(spark):
    for name in ("reservation_pivot", "reservation_pivot_all", "reservation_summary"):
        plan = plan_of(entry_points.queries()[name](spark, DIR))
        assert plan.count("orders.parquet") == 1, name


def test_no_query_plans_a_nested_loop_or_product(spark):
    for name, query in ALL.items():
        plan = plan_of(query(spark, DIR))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_ranges_reach_the_scan(spark):
    queries = entry_points.queries()
    for name in ("reservations_in_range", "reservation_pivot", "reservation_summary"):
        assert "GreaterThanOrEqual(o_orderdate" in plan_of(queries[name](spark, DIR)), name


def test_windows_work_on_slices_and_share_one_shuffle(spark):
    df = entry_points.queries()["login_totals"](spark, DIR)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    windows = [line for line in final.splitlines() if " Window [" in line]
    assert windows and all("slice" in line for line in windows)
    assert "ReusedExchange [vm_name" in final


def test_no_stage_keeps_a_busy_lab_whole(spark, tmp_path):
    """Over stored tables too large to broadcast, work on raw events follows an exchange by
    VM and second, so a join before it can be split and copies shrink before they move."""
    for name, df in {"in": logins(spark), "out": logouts(spark), "log": power(spark),
                     "res": labs(spark)}.items():
        df.write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("res", "in", "out", "log")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(usage.usage_persistent(*stored, NOW, {"labs": ["Lab A"]}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    steps = [line.split("#")[0] for line in plan.splitlines() if "Exchange" in line]
    assert any("_groupingexpression" in step for step in steps), steps
    for line in plan.splitlines():
        if " Window [" in line:
            keys = line.rsplit("], [", 2)[1]
            assert "slice" in line and keys.startswith("vm_name"), line
    assert "SortMergeJoin [vm_name" in plan and "slice" in plan


def test_sorted_report_keeps_copies(spark, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_BLOCK", 3)
    df = table(spark, "a int, b string", [(1, "x")] * 10 + [(2, "y")] + [(2, None)] * 4)
    found = [tuple(r) for r in listings.sorted_report(df, [("a", "desc"), ("b", "asc")]).collect()]
    assert found == [(2, None)] * 4 + [(2, "y")] + [(1, "x")] * 10


def test_report_orders_name_real_columns(spark):
    queries = entry_points.queries()
    for name, order in listings.REPORT_ORDER.items():
        query = queries["extract_changes_all" if name == "extract_changes" else name]
        report = listings.sorted_report(query(spark, DIR), order)
        found = [tuple(r) for r in report.select(*[c for c, _ in order]).collect()]
        column, direction = order[0]
        first = [row[0] for row in found]
        assert first == sorted(first, reverse=direction == "desc"), name
        assert len(found) == query(spark, DIR).count()
