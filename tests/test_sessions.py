"""Golden cases of session pairing, and a row-by-row emulation on random logs."""

import random
from collections import Counter
from datetime import datetime, timedelta

from labmeter.operators import ordered, sessions
from tests.helpers import NOW, at, events, reservations, rows

GOLDEN = {
    "out only": ([("09:00", "out")], [(None, "09:00")], None),
    "in in out": ([("09:00", "in"), ("10:00", "in"), ("11:00", "out")],
                  [("09:00", None), ("10:00", "11:00")], 3600),
    "in out out": ([("09:00", "in"), ("10:00", "out"), ("11:00", "out")],
                   [("09:00", "10:00")], 3600),
    "reconnect": ([("09:00", "in"), ("10:00", "in"), ("10:00", "out")],
                  [("09:00", "10:00"), ("10:00", None)], 3600),
    "two at once": ([("09:00", "in"), ("09:00", "in"), ("10:00", "out")],
                    [("09:00", None), ("09:00", "10:00")], 3600),
    "never closed": ([("09:00", "in")], [("09:00", None)], None),
    "no time": ([(None, "in"), ("10:00", "out")], [(None, "10:00")], None),
}


def test_golden_pairs_and_totals(spark):
    log = events(spark, [(vm, t, a) for vm, (evs, _, _) in GOLDEN.items() for t, a in evs])
    pairs = Counter((vm, at(i), at(o)) for vm, (_, ps, _) in GOLDEN.items() for i, o in ps)
    assert rows(sessions.session_pairs(log)) == pairs
    assert dict(sessions.session_totals(log).collect()) == {v: t for v, (_, _, t) in GOLDEN.items()}


def test_minutes_are_cut_before_the_sum(spark):
    log = events(spark, [("a", "09:00:00", "in"), ("a", "09:00:59", "out"),
                         ("a", "09:10:00", "in"), ("a", "09:10:59", "out")])
    assert sessions.session_totals(log, unit="MINUTE").collect() == [("a", 0)]
    assert sessions.session_totals(log).collect() == [("a", 118)]


def test_open_session_closes_only_while_the_lab_is_active(spark):
    log = events(spark, [("active", "09:00", "in"), ("ended", "09:00", "in"),
                         ("quiet", "09:00", "out")])
    labs = reservations(spark, [
        {"vm_name": "active", "end_ts": at("23:00")}, {"vm_name": "ended", "end_ts": at("11:00")},
        {"vm_name": "quiet", "end_ts": at("23:00")}, {"vm_name": "unused", "end_ts": at("23:00")},
    ])
    assert rows(sessions.closing_events(log.filter("action = 'in'"), labs, NOW)) == Counter(
        [("active", datetime.fromisoformat(NOW), "out")]
    )
    totals = sessions.session_totals(sessions.with_closing(log, labs, NOW))
    assert dict(totals.collect()) == {"active": 3 * 3600, "ended": None, "quiet": None}
    keys = spark.createDataFrame([("ended",), ("power only",), ("ended",)], "vm_name string")
    assert dict(sessions.zero_fill(totals, keys).collect()) == {
        "active": 3 * 3600, "ended": 0, "quiet": None, "power only": 0,
    }


def test_numbers_start_at_zero_for_a_leading_out(spark):
    log = events(spark, [("a", "08:00", "out"), ("a", "09:00", "in"), ("a", "09:00", "in"),
                         ("a", "10:00", "out"), ("b", "08:00", "in")])
    assert rows(sessions.number_sessions(log)) == Counter([
        ("a", at("08:00"), "out", 0), ("a", at("09:00"), "in", 1), ("a", at("09:00"), "in", 2),
        ("a", at("10:00"), "out", 2), ("b", at("08:00"), "in", 1),
    ])


def emulate(log):
    """Number rows as the running variables do, then pair by number."""
    numbered, pairs = [], {}
    number, current = 0, None
    for vm, dt, action in sorted(log, key=lambda r: (r[0], r[1], r[2] == "in")):
        if vm != current:
            number, current = 0, vm
        number += action == "in"
        numbered.append((vm, dt, action, number))
        login, logout = pairs.get((vm, number), (None, None))
        if action == "in":
            login = dt
        elif logout is None:
            logout = dt
        pairs[vm, number] = (login, logout)
    return Counter(numbered), Counter((vm, *pair) for (vm, _), pair in pairs.items())


def random_log(seed, vms, size, span):
    """Times fall on few seconds of each day, so copies and ties are common."""
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    return [
        (rng.choice(vms), start + timedelta(days=rng.randrange(span), seconds=rng.randrange(40)),
         rng.choice(["in", "out"]))
        for _ in range(size)
    ]


def test_emulation_agrees_across_slices_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_BLOCK", 3)
    for seed, span in ((1, 1), (2, 60)):
        log = random_log(seed, ["a", "b", "b", "b", "c"], 1500, span)
        # One lab, one second, many copies.
        log += [("b", datetime(2024, 1, 20), "in")] * 400 + [("b", datetime(2024, 1, 20), "out")] * 9
        numbered, pairs = emulate(log)
        df = spark.createDataFrame(log, "vm_name string, dt timestamp_ntz, action string")
        assert rows(sessions.number_sessions(df)) == numbered
        assert rows(sessions.session_pairs(df)) == pairs
