"""Which reservation held an address at a moment.

An event's address contains the reservation's RDP text, and its time lies in
the reservation. Neither half becomes a nested loop or a list of pairs:
- RDP texts stand in an index under their rarest q-gram; distinct addresses look up their
  own q-grams (`contains`);
- reservations are cut, only inside the time that is asked for, into calendar cells (32768, 1024, 32 and single days, hours, minutes,
  seconds): a few hundred at most, however far off an end lies. Cells of one RDP are
  merged into one row with the number of reservations and the best of them. An event
  asks for one cell per unit, so its work does not grow with the number of
  reservations that share an RDP.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import epoch_of, moment
from labmeter.functions.text import DAY, HOUR, MINUTE
from labmeter.operators.contains import containing
from labmeter.operators.ordered import spread_group

CELL_UNITS = (32768 * DAY, 1024 * DAY, 32 * DAY, DAY, HOUR, MINUTE, 1)
MOMENT = ["address", "ts"]


def _floor(value: str, unit: int) -> str:
    return f"({value} - pmod({value}, {unit})) div {unit}"


def _runs(intervals: DataFrame, *keys: str, units: Sequence[int] = CELL_UNITS) -> DataFrame:
    """(rdp, *keys, rank, unit, first, end): runs of calendar cells, from `first` up to but not `end`,
    that tile [start, stop) in epoch seconds with cells as large as possible.

    Where a coarse unit fits at all, a finer one only has to fill the two edges.
    """
    bounds, runs = [], []
    coarser: int | None = None
    for unit in units:
        low, high = f"low_{unit}", f"high_{unit}"
        bounds += [f"-({_floor('-start', unit)}) AS {low}", f"{_floor('stop', unit)} AS {high}"]
        if coarser is None:
            runs.append(f"struct({unit} AS unit, {low} AS first, {high} AS end)")
        else:
            fits = f"low_{coarser} < high_{coarser}"
            left = f"if({fits}, low_{coarser} * {coarser // unit}, {high})"
            right = f"if({fits}, high_{coarser} * {coarser // unit}, {high})"
            runs.append(f"struct({unit} AS unit, {low} AS first, {left} AS end)")
            runs.append(f"struct({unit} AS unit, {right} AS first, {high} AS end)")
        coarser = unit
    return (
        intervals.selectExpr("rdp", *keys, "rank", *bounds)
        .selectExpr("rdp", *keys, "rank", f"inline(array({', '.join(runs)}))")
        .filter("first < end")
    )


def ranked_intervals(reservations: DataFrame) -> DataFrame:
    """(rdp, rank, start, stop): RDP texts in lower case, seconds from start up to but not stop; `rank` orders by latest
    start, then by name."""
    valid = reservations.filter("rdp IS NOT NULL AND start_ts <= end_ts").select(
        F.lower("rdp").alias("rdp"),
        epoch_of(F.col("start_ts")).alias("start"), (epoch_of(F.col("end_ts")) + 1).alias("stop"),
        "vm_name",
    )
    return valid.selectExpr("rdp", "struct(-start AS age, vm_name) AS rank", "start", "stop")


def _clipped(intervals: DataFrame, times: DataFrame) -> DataFrame:
    """What of the intervals lies between the first and the last of the times (ts)."""
    at = epoch_of(F.col("ts"))
    bounds = times.agg(F.struct(F.min(at).alias("low"), F.max(at).alias("high")).alias("at")).scalar()
    return intervals.withColumns({
        "start": F.greatest("start", bounds["low"]), "stop": F.least("stop", bounds["high"] + 1),
    }).filter("start < stop")


def interval_cells(intervals: DataFrame, *keys: str, units: Sequence[int] = CELL_UNITS) -> DataFrame:
    """(rdp, *keys, unit, cell, n, best): how many intervals cover a calendar cell entirely, and the first by rank."""
    tiles = _runs(intervals, *keys, units=units).selectExpr(
        "rdp", *keys, "rank", "unit", "explode(sequence(first, end - 1)) AS cell"
    )
    return tiles.groupBy("rdp", *keys, "unit", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("best")
    )


def reservation_cells(reservations: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(rdp, unit, cell, n, best): reservations that cover a calendar cell entirely.

    `best` orders by latest start, then by name. One row per RDP and cell; the
    merge combines map-side. `asked` (rdp, ts) leaves out RDPs and times that no
    moment lies in.
    """
    ranked = ranked_intervals(reservations)
    if asked is not None:
        ranked = _clipped(ranked, asked).join(asked.select("rdp").distinct(), "rdp", "left_semi")
    return interval_cells(ranked)


def probes(moments: DataFrame, *keys: str, units: Sequence[int] = CELL_UNITS) -> DataFrame:
    """(address, ts, rdp, *keys, unit, cell): the cells each moment lies in, one per unit."""
    asked = ", ".join(f"struct({u} AS unit, {_floor('at', u)} AS cell)" for u in units)
    timed = moments.withColumn("at", epoch_of(F.col("ts")))
    return timed.selectExpr(*MOMENT, "rdp", *keys, f"inline(array({asked}))")


def distinct_moments(events: DataFrame) -> DataFrame:
    """Distinct (address, ts): what an attribution depends on. Copies shrink before they move."""
    known = events.filter(F.col("address").isNotNull() & F.col("ts").isNotNull())
    return spread_group(known, F.col("address"), F.col("ts")).count().select("key.*")


def best_of(hits: DataFrame, n_sources: int = 1) -> DataFrame:
    """(address, ts, source, vm_name, match_count) of cells met by a moment; of several sources the first counts."""
    best = F.expr("min(struct(source, best.age, best.vm_name)) AS top")
    counts = [F.expr(f"sum(n) FILTER (WHERE source = {i}) AS n_{i}") for i in range(n_sources)]
    cases = " ".join(f"WHEN {i} THEN n_{i}" for i in range(n_sources))
    return hits.groupBy(*MOMENT).agg(best, *counts).selectExpr(
        *MOMENT, "top.source AS source", "top.vm_name AS vm_name",
        f"CASE top.source {cases} END AS match_count",
    )


def _lookup(events: DataFrame, sources: Sequence[DataFrame], exact: bool) -> DataFrame:
    """(address, ts, source, vm_name, match_count) for moments of the events that some source covers.

    All sources are cut into cells together, inside the range of the events' own times. Where a few events
    meet many reservations, a stored index reads less: see `cell_index`.
    """
    moments = distinct_moments(events)
    intervals = reduce(DataFrame.unionByName, [
        ranked_intervals(source).withColumn("source", F.lit(i)) for i, source in enumerate(sources)
    ])
    if exact:
        located = moments.withColumn("rdp", F.lower("address"))
    else:
        located = moments.join(containing(moments, "address", intervals), "address")
    cells = interval_cells(_clipped(intervals, events), "source")
    hits = probes(located).join(cells, ["rdp", "unit", "cell"])
    return best_of(hits, len(sources))


def attribute_events(
    events: DataFrame,
    reservations: DataFrame,
    now: Column | datetime | str | None = None,
    exact: bool = False,
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """Events (address, ts, ...) with `vm_name` and `match_count`.

    Without a match `vm_name` is NULL and `match_count` 0: see `rejected`. With
    several the latest start wins, then the name. `now` asks for one moment in
    place of each event's time; `exact` wants the whole address equal to the RDP
    text. `overrides` gives fixed names to addresses that contain a text, before
    any lookup.
    """
    return attributed(events, lambda asked: _lookup(asked, [reservations], exact), now, overrides)


def attributed(
    events: DataFrame,
    lookup: Callable[[DataFrame], DataFrame],
    now: Column | datetime | str | None = None,
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """`attribute_events` by a lookup of one's own, from events to (address, ts, vm_name, match_count)."""
    fixed = F.lit(None).cast("string")
    for part, name in reversed(list((overrides or {}).items())):
        fixed = F.when(F.col("address").contains(part), name).otherwise(fixed)
    asked = events.withColumn("fixed_name", fixed)
    looked_up = asked.filter(F.col("fixed_name").isNull())
    keys = MOMENT
    if now is not None:
        looked_up, keys = looked_up.withColumn("ts", moment(now)), ["address"]
    found = lookup(looked_up).select(
        *keys, F.col("vm_name").alias("found_name"), F.col("match_count").alias("found")
    )
    matches = F.when(F.col("fixed_name").isNotNull(), 1).otherwise(F.coalesce("found", F.lit(0)))
    return asked.join(found, keys, "left").select(
        *events.columns, F.coalesce("fixed_name", "found_name").alias("vm_name"),
        matches.alias("match_count"),
    )


def accepted(attributed: DataFrame) -> DataFrame:
    return attributed.filter(F.col("vm_name").isNotNull())


def rejected(attributed: DataFrame) -> DataFrame:
    return attributed.filter(F.col("vm_name").isNull())


def lookup_first(
    events: DataFrame, sources: Sequence[DataFrame], exact: bool = False
) -> DataFrame:
    """Attributed events from the first source that matches; unmatched ones are left out.

    Adds `source`, the position in `sources`, to the columns of `attribute_events`.
    """
    found = _lookup(events, sources, exact)
    return events.join(found, MOMENT).select(*events.columns, "source", "vm_name", "match_count")


def route_by_prefix(
    df: DataFrame, address: str, mapping: Mapping[str, str], target: str = "host"
) -> DataFrame:
    """Add the host whose prefix an address starts with; rows without one are left out."""
    host = F.lit(None).cast("string")
    for prefix, name in reversed(list(mapping.items())):
        host = F.when(F.col(address).startswith(prefix), name).otherwise(host)
    return df.withColumn(target, host).filter(F.col(target).isNotNull())


def orphan_events(events: DataFrame, reservations: DataFrame) -> DataFrame:
    """Events whose VM has no reservation."""
    return events.join(reservations.select("vm_name"), "vm_name", "left_anti")
