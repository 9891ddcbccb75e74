"""Sessions: an `in` paired with the first `out` before the next `in`.

At equal times an `out` comes before an `in`, so a reconnect closes the old
session first. Then the partner of an `in`, if it has one, is always the very
next event, and pairing only has to look at the neighbouring instant.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.clock import moment
from labmeter.functions.status import is_active, power_action
from labmeter.operators.ordered import (
    collapse,
    known_time,
    repeat_rows,
    spread_group,
    with_neighbours,
)

KEYS = ("vm_name",)
KIND_KEYS = ("vm_name", "kind")
SESSION_COUNTS = ["n_in", "n_out"]
LOGIN, POWER = "login", "power"


def tag_events(df: DataFrame, ts: str, action: str | Column) -> DataFrame:
    """(vm_name, dt, action) rows of one event table."""
    tag = F.lit(action) if isinstance(action, str) else action
    return df.select("vm_name", F.col(ts).alias("dt"), tag.alias("action"))


def login_timeline(logins: DataFrame, logouts: DataFrame) -> DataFrame:
    events = tag_events(logins, "login_ts", "in").unionByName(
        tag_events(logouts, "logout_ts", "out")
    )
    return events.withColumn("kind", F.lit(LOGIN))


def power_timeline(power_log: DataFrame) -> DataFrame:
    events = tag_events(power_log, "log_ts", power_action(F.col("operation")))
    return events.withColumn("kind", F.lit(POWER))


def closing_events(
    timeline: DataFrame, reservations: DataFrame, now: Column | datetime | str
) -> DataFrame:
    """An `out` at `now` for each VM in `timeline` whose reservation is still active."""
    active = reservations.filter(is_active(F.col("end_ts"), now)).select("vm_name")
    keys = [c for c in timeline.columns if c in KIND_KEYS]
    return (
        spread_group(timeline, *map(F.col, keys)).count().select("key.*")
        .join(active, "vm_name", "left_semi")
        .withColumn("dt", moment(now)).withColumn("action", F.lit("out"))
    )


def with_closing(
    timeline: DataFrame, reservations: DataFrame, now: Column | datetime | str
) -> DataFrame:
    """Close what is still open at `now` while the reservation is active.

    Any power event makes a VM eligible, but only a login does on the login side.
    """
    eligible = timeline
    if "kind" in timeline.columns:
        eligible = timeline.filter((F.col("kind") == POWER) | (F.col("action") == "in"))
    else:
        eligible = timeline.filter(F.col("action") == "in")
    return timeline.unionByName(closing_events(eligible, reservations, now))


def session_instants(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return collapse(
        events, keys, "dt",
        n_in=F.col("action") == "in", n_out=F.col("action") == "out",
    )


def _openings(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per instant: `login_ts`, `logout_ts` of its last session, and `starts_orphan`,
    true where a VM's log begins with an `out`."""
    return openings_of(with_neighbours(session_instants(events, keys), keys, "dt", SESSION_COUNTS, []), keys)


def openings_of(near: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`_openings` of instants that know their neighbours."""
    opens = F.col("n_in") > 0
    return near.select(
        *keys, known_time(F.col("dt")).alias("dt"), "n_in",
        F.when(opens, known_time(F.col("dt"))).alias("login_ts"),
        F.when(opens & (F.col("next_n_out") > 0), F.col("next_dt")).alias("logout_ts"),
        (F.col("prev_n_out").isNull() & (F.col("n_out") > 0)).alias("starts_orphan"),
    )


def number_sessions(events: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every event with the number of its session: +1 at each `in`, per key.

    An `out` before the first `in` has number 0.
    """
    near = with_neighbours(session_instants(events, keys), keys, "dt", ["n_in", "n_out"], ["n_in"])
    per_action = near.select(
        *keys, known_time(F.col("dt")).alias("dt"), F.col("before_n_in").alias("base"),
        F.inline(F.array(
            F.struct(F.lit("out").alias("action"), F.col("n_out").alias("n")),
            F.struct(F.lit("in").alias("action"), F.col("n_in").alias("n")),
        )),
    )
    rows = repeat_rows(per_action, F.col("n"))
    number = F.when(F.col("action") == "in", F.col("base") + F.col("copy")).otherwise(F.col("base"))
    return rows.select(*keys, "dt", "action", number.alias("session"))


def session_pairs(events: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, login_ts, logout_ts), one row per session.

    A session without an `out` has no logout; of several logins in one second
    all but the last are cut off so. A log that begins with an `out` gives one
    row without a login.
    """
    rows = session_rows(_openings(events, keys), keys)
    return repeat_rows(rows, F.col("times")).select(*keys, "login_ts", "logout_ts")


def session_rows(openings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, login_ts, logout_ts, times): the sessions of each instant, equal ones as one row."""
    none = F.lit(None).cast("timestamp_ntz")

    def row(login: Column, logout: Column, times: Column) -> Column:
        return F.struct(
            login.alias("login_ts"), logout.alias("logout_ts"), times.cast("long").alias("times")
        )

    login, logout, n_in = F.col("login_ts"), F.col("logout_ts"), F.col("n_in")
    return openings.select(
        *keys,
        F.inline(F.array(
            row(login, logout, F.least(n_in, F.lit(1))),
            row(login, none, n_in - 1),
            row(none, F.col("dt"), F.col("starts_orphan").cast("int")),
        )),
    )


_LENGTH = "timestampdiff({}, login_ts, logout_ts)"


def session_totals(events: DataFrame, unit: str = "SECOND") -> DataFrame:
    """(vm_name, total): whole units per session, cut before they are summed.

    A VM without a finished session has a NULL total.
    """
    return _openings(events, KEYS).groupBy("vm_name").agg(
        F.expr(f"sum({_LENGTH.format(unit)})").alias("total")
    )


def totals_by_kind(events: DataFrame, unit: str = "SECOND") -> DataFrame:
    """(vm_name, <kind>_total, has_<kind>) for logins and power, from one pass over both."""
    measures = []
    for kind in (LOGIN, POWER):
        mine = f"FILTER (WHERE kind = '{kind}')"
        measures += [
            F.expr(f"sum({_LENGTH.format(unit)}) {mine}").alias(f"{kind}_total"),
            F.expr(f"count(*) {mine} > 0").alias(f"has_{kind}"),
        ]
    return _openings(events, KIND_KEYS).groupBy("vm_name").agg(*measures)


def zero_fill(totals: DataFrame, keys: DataFrame) -> DataFrame:
    """Totals of every VM in `keys`, 0 where there is none, and of VMs outside it as they are."""
    known = keys.select("vm_name").distinct().withColumn("floor", F.lit(0).cast("long"))
    return totals.join(known, "vm_name", "full_outer").select(
        "vm_name", F.coalesce("total", "floor").alias("total")
    )
