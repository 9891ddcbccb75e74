"""Attribution against brute force, with the cases that make it hard."""

import random
from datetime import datetime, timedelta

import pytest

from labmeter.operators import attribution
from tests.helpers import at, plan_of, reservations, rows

EVENTS = "event_id bigint, ts timestamp_ntz, address string"


def attribute(spark, events, labs, **options):
    df = attribution.attribute_events(
        spark.createDataFrame(events, EVENTS), reservations(spark, labs), **options
    )
    return {r.event_id: (r.vm_name, r.match_count) for r in df.collect()}


def lab(vm, rdp, start, end):
    return {"vm_name": vm, "rdp": rdp, "start_ts": start, "end_ts": end}


def brute_force(events, labs, exact=False):
    found = {}
    for event_id, ts, address in events:
        hits = [
            row for row in labs
            if address is not None and row["rdp"] is not None
            and row["start_ts"] is not None and row["end_ts"] is not None
            and (row["rdp"] == address if exact else row["rdp"] in address)
            and row["start_ts"] <= ts <= row["end_ts"]
        ]
        latest = max((row["start_ts"] for row in hits), default=None)
        name = min((row["vm_name"] for row in hits if row["start_ts"] == latest), default=None)
        found[event_id] = (name, len(hits))
    return found


def test_golden(spark):
    labs = [lab("one", "10.240.1.1", at("08:00"), at("10:00")),
            lab("b-late", "10.240.1.15", at("09:00"), at("10:00")),
            lab("a-late", "10.240.1.15", at("09:00"), at("10:00")),
            lab("endless", "10.240.9.9", at("08:00"), None)]
    events = [(1, at("08:00"), "10.240.1.1"), (2, at("10:00"), "10.240.1.15"),
              (3, at("10:00:01"), "10.240.1.15"), (4, at("09:00"), "10.240.9.9"),
              (5, at("09:00"), None), (6, at("09:30"), "10.248.0.1")]
    assert attribute(spark, events, labs) == {
        1: ("one", 1), 2: ("a-late", 3), 3: (None, 0), 4: (None, 0), 5: (None, 0), 6: (None, 0),
    }
    assert attribute(spark, events[:2], labs, exact=True) == {1: ("one", 1), 2: ("a-late", 2)}
    assert attribute(spark, events[2:3], labs, now=at("09:30")) == {3: ("a-late", 3)}
    assert attribute(spark, events[5:], labs, overrides={"10.248.0": "TEST", "10.2": "x"}) == {
        6: ("TEST", 1)
    }


@pytest.mark.parametrize("exact", [False, True])
def test_brute_force(spark, exact):
    rng, zero = random.Random(3), datetime(2024, 2, 27, 23, 58, 30)
    texts = ["10.1", "10.1.1", "10.1.12", "0", "", "10.1.1.1", "10.2.1.1", None]
    labs = []
    for i in range(300):
        start = zero + timedelta(seconds=rng.choice([0, 1, 59, 60, 61, 3599, 90_000, 400_000]))
        length = rng.choice([-5, 0, 1, 59, 60, 119, 3600, 7300, 86_400, 200_001, 9_000_000])
        labs.append(lab(f"vm{i:03}", rng.choice(texts), start, start + timedelta(seconds=length)))
    labs += [lab("no end", "10.1", zero, None), lab("no start", "10.1", None, zero)]
    events = [
        (i, zero + timedelta(seconds=rng.randrange(-10, 500_000) if i % 3 else rng.randrange(130)),
         rng.choice(["10.1.1.1", "10.1.12", "10.2.1.1", "99", "", None]))
        for i in range(600)
    ]
    assert attribute(spark, events, labs, exact=exact) == brute_force(events, labs, exact)


def test_copies_need_no_id(spark):
    labs = [lab("one", "10.240.1.1", at("08:00"), at("10:00"))]
    events = spark.createDataFrame(
        [(at("09:00"), "10.240.1.1")] * 3 + [(at("09:00"), "10.9.9.9")] * 2 + [(None, None)],
        "ts timestamp_ntz, address string")
    assert rows(attribution.attribute_events(events, reservations(spark, labs))) == {
        (at("09:00"), "10.240.1.1", "one", 1): 3, (at("09:00"), "10.9.9.9", None, 0): 2,
        (None, None, None, 0): 1,
    }
    assert attribution.lookup_first(events, [reservations(spark, labs)]).count() == 3


def test_first_source_wins(spark):
    main = reservations(spark, [lab("main", "10.240.1.1", at("08:00"), at("10:00"))])
    dev = reservations(spark, [lab("dev", "10.240.1.1", at("09:00"), at("11:00")),
                               lab("dev2", "10.240.1.1", at("09:00"), at("11:00"))])
    events = spark.createDataFrame(
        [(1, at("09:30"), "10.240.1.1"), (2, at("10:30"), "10.240.1.1"),
         (3, at("12:00"), "10.240.1.1")], EVENTS)
    found = attribution.lookup_first(events, [main, dev])
    assert {r.event_id: (r.source, r.vm_name, r.match_count) for r in found.collect()} == {
        1: (0, "main", 1), 2: (1, "dev", 2),
    }


def test_plan_has_no_nested_loop_and_no_pair_blow_up(spark):
    """A third of all events and reservations on one address: rows stay per event and cell."""
    labs = [lab(f"vm{i}", "10.240.1.1", at("08:00"), at("11:00")) for i in range(400)]
    events = [(i, at("09:00"), "10.240.1.1") for i in range(400)]
    df = attribution.attribute_events(
        spark.createDataFrame(events, EVENTS), reservations(spark, labs))
    assert {(r.vm_name, r.match_count) for r in df.collect()} == {("vm0", 400)}
    plan = plan_of(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    cells = attribution.reservation_cells(reservations(spark, labs))
    assert cells.count() == 4  # 08, 09, 10 o'clock and the last second


def test_routing_and_orphans(spark):
    df = spark.createDataFrame([(1, "10.10.1.1"), (2, "10.11.1.1"), (3, "10.12.1.1"), (4, None)],
                               "id int, address string")
    routed = attribution.route_by_prefix(df, "address", {"10.10": "a", "10.11": "b", "10.1": "b"})
    assert {r.id: r.host for r in routed.collect()} == {1: "a", 2: "b", 3: "b"}
    labs = reservations(spark, [{"vm_name": "known"}])
    log = spark.createDataFrame([("known", 1), ("lost", 2), (None, 3)], "vm_name string, n int")
    assert rows(attribution.orphan_events(log, labs)) == {("lost", 2): 1, (None, 3): 1}


def test_accepted_and_rejected(spark):
    df = spark.createDataFrame([("a", 1), (None, 0)], "vm_name string, match_count int")
    assert attribution.accepted(df).count() == attribution.rejected(df).count() == 1


def test_a_far_end_gives_a_few_hundred_cells(spark):
    res = reservations(spark, [lab("vm", "10.1.1.1", at("08:00"), datetime(9999, 12, 31))])
    assert attribution.reservation_cells(res).count() < 600


def test_only_asked_addresses_and_times_are_cut(spark):
    res = reservations(spark, [
        lab("vm", "10.1.1.1", at("08:00"), datetime(9999, 12, 31)),
        lab("other", "10.9.9.9", at("08:00"), datetime(9999, 12, 31)),
    ])
    asked = spark.createDataFrame([("10.1.1.1", at("09:00"))], "rdp string, ts timestamp_ntz")
    cells = attribution.reservation_cells(res, asked)
    assert [(r.rdp, r.unit) for r in cells.collect()] == [("10.1.1.1", 1)]
    assert len(attribution.CELL_UNITS) <= 8
