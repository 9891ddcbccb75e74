"""Ranges answered from cells against the direct pivot and a plain count."""

import random
from datetime import datetime, timedelta

import pytest

from labmeter.operators import pivot_cells, pivots
from tests.helpers import employees, reservations, rows

BUCKETS = {"one": ["L1"], "both": ["l1", "L2"]}
ZERO = datetime(2024, 1, 1)
SECOND = int((ZERO - datetime(1970, 1, 1)).total_seconds())


def test_tiles_cover_each_second_once():
    rng = random.Random(3)
    for _ in range(300):
        low = rng.randrange(-100_000, 100_000)
        high = low + rng.choice([-1, 0, 59, 3600, 86_399, 200_000])
        seen = [s for unit, first, end in pivot_cells.tiles(low, high) for c in range(first, end) for s in range(c * unit, (c + 1) * unit)]
        assert sorted(seen) == list(range(low, high + 1))
    far = pivot_cells.tiles(-(10**11), 10**11 + 7)
    assert len(far) <= 13 and sum(end - first for _, first, end in far) < 600


@pytest.mark.parametrize("all_time", [False, True])
def test_many_ranges_equal_the_direct_pivot(spark, all_time):
    rng = random.Random(4)
    labs = [
        {"vm_name": f"v{i}", "email": rng.choice(["a@x", "b@x", "c@x", None]), "lab": rng.choice(["L1", "l1", "l2", "L3", None]),
         "start_ts": rng.choice([None, *[ZERO + timedelta(seconds=rng.randrange(400_000))] * 9])}
        for i in range(200)
    ]
    staff = employees(spark, [{"email": "a@x", "full_name": "A"}, {"email": "d@x", "full_name": "D"}])
    table = reservations(spark, labs)
    cells = pivot_cells.merged_cells(
        pivot_cells.pivot_cells(reservations(spark, labs[:90]), BUCKETS), pivot_cells.pivot_cells(reservations(spark, labs[90:]), BUCKETS)
    ).persist()
    for low, high in [(0, 10**10), (SECOND, SECOND + 86_400), (SECOND + 3601, SECOND + 3601), (SECOND + 77, SECOND + 300_001), (5, 4)]:
        for keep_all in (False, True):
            direct = pivots.reservation_pivot(table, staff, BUCKETS, low, high, all_time, keep_all)
            totals = pivot_cells.totals_in_range(cells, BUCKETS, low, high, all_time)
            assert rows(pivots.pivot_report(totals, staff, BUCKETS, keep_all)) == rows(direct)
    cells.unpersist()
