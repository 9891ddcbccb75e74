"""Golden cases of the power-state fold, and an emulation of the procedure."""

import random
from collections import Counter
from datetime import datetime, timedelta

from labmeter.operators import ordered, uptime
from tests.helpers import at, reservations, rows

GOLDEN = {
    "off first": ([("09:00", 1), ("10:00", 2)], []),
    "two ons": ([("09:00", 0), ("10:00", 0), ("11:00", 2)],
                [("09:00", None), ("10:00", "11:00")]),
    "late suspend": ([("09:00", 0), ("10:00", 1), ("11:00", 1)],
                     [("09:00", "10:00"), (None, "11:00")]),
    "late delete": ([("09:00", 0), ("10:00", 2), ("11:00", 2)], [("09:00", "10:00")]),
    "created": ([("09:00", 3), ("10:00", 0)], [("10:00", None)]),
    "restart": ([("09:00", 0), ("10:00", 1), ("10:00", 0), ("11:00", 1)],
                [("09:00", "10:00"), ("10:00", "11:00")]),
}


def ops(spark, data):
    return spark.createDataFrame(data, "vm_name string, ts timestamp_ntz, op int")


def test_golden(spark):
    log = ops(spark, [(vm, at(t), op) for vm, (evs, _) in GOLDEN.items() for t, op in evs])
    wanted = Counter((vm, at(i), at(o)) for vm, (_, ivs) in GOLDEN.items() for i, o in ivs)
    intervals = uptime.uptime_intervals(log)
    assert rows(intervals) == wanted
    assert rows(uptime.latest_interval(intervals)) == Counter([
        ("two ons", at("10:00"), at("11:00")), ("late suspend", at("09:00"), at("10:00")),
        ("late delete", at("09:00"), at("10:00")), ("created", at("10:00"), None),
        ("restart", at("10:00"), at("11:00")),
    ])


def emulate(log):
    """Apply the operations of each VM one by one; a list per VM stands for the table."""
    table = {}
    for vm, ts, op in sorted(log, key=lambda r: (r[0], r[1], r[2] == 0, r[2])):
        mine = table.setdefault(vm, [])
        opened = [row for row in mine if row[0] is not None]
        if op == 0:
            mine.append([ts, None])
        elif op in (1, 2) and opened:
            if opened[-1][1] is None:
                opened[-1][1] = ts
            elif op == 1:
                mine.append([None, ts])
    return Counter((vm, *row) for vm, mine in table.items() for row in mine)


def test_emulation_agrees(spark, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_BLOCK", 3)
    rng, start = random.Random(5), datetime(2024, 1, 1)
    log = [
        (rng.choice("abbb"),
         start + timedelta(days=rng.randrange(40), seconds=rng.randrange(20)),
         rng.choice([0, 1, 1, 2, 3]))
        for _ in range(2000)
    ]
    log += [("b", datetime(2024, 1, 9), op) for op in (0, 1, 2) for _ in range(200)]
    assert rows(uptime.uptime_intervals(ops(spark, log))) == emulate(log)


def test_log_rows_and_creation(spark):
    log = ops(spark, [("a", at("09:00"), op) for op in (0, 1, 2, 3, 7)])
    assert rows(uptime.ops_to_log(log)) == Counter(
        ("a", at("09:00"), name) for name in ("Powered-On", "Suspended", "Deleted")
    )
    labs = reservations(spark, [{"vm_name": "L-Persistent-(u)-x", "start_ts": at("09:00")},
                                {"vm_name": "L-(u)-x", "start_ts": at("09:00")}])
    assert rows(uptime.creation_ops(labs)) == Counter([("L-Persistent-(u)-x", at("09:00"), 3)])
