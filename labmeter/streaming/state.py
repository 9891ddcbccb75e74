"""Keyed state: session pairing and the power-state machine over streams.

Events first collapse to one row per VM and second in an aggregation under a
watermark. It releases a second once no more events of it can come, so seconds
reach the state in order, late events within the delay find their place, and
later ones are dropped. The state of a VM is a few numbers, and what a VM can
bring in one trigger is bounded by the seconds its watermark moved.

The session must keep its state in RocksDB: set
`spark.sql.streaming.stateStore.providerClass` to `STATE_STORE`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from labmeter.functions.clock import whole_second
from labmeter.functions.status import DELETE, POWER_ON, SUSPEND
from labmeter.operators.ordered import unfold

ROWS = "vm_name string, opened bigint, closed bigint, first bigint, times bigint"
STATE = "pending bigint, seen boolean"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _instants(events: DataFrame, ts: str, delay: str, **counted: Column) -> DataFrame:
    """(vm_name, sec, counts): like the batch `collapse`, for a stream. Times are cut to seconds."""
    counts = [F.count_if(condition).alias(name) for name, condition in counted.items()]
    timed = events.withColumn("at", whole_second(F.col(ts)).cast("timestamp")).withWatermark("at", delay)
    return timed.groupBy("vm_name", "at").agg(*counts).select(
        "vm_name", F.unix_seconds("at").alias("sec"), *counted
    )


class _Fold(StatefulProcessor):
    """Folds the instants of a VM, in order, into rows of (opened, closed, first, times).

    `pending` is the start that waits for its end; `seen` says whether the log
    (sessions) or the first interval (uptime) has begun. After an instant with a start
    that start is pending, after any other none is: what was pending before an instant
    is known from the instant before it, so a trigger's instants are folded as whole columns.
    """

    starts: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("fold", STATE)

    def handleInputRows(
        self, key: tuple[str], rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        now = pd.concat(list(rows)).sort_values("sec", ignore_index=True)
        pending, seen = self._state.get() if self._state.exists() else (None, False)
        now["sec"] = now["sec"].astype("Int64")
        after = now["sec"].where(now[self.starts] > 0)
        before = after.shift()
        before.iloc[0] = pd.NA if pending is None else pending
        ends, seen = self.ends(now, before, seen)
        opens = now[now[self.starts] > 0]
        frame = pd.concat([
            *ends,
            _rows(opens["sec"], None, 1, 1),
            _rows(opens["sec"], None, 2, opens[self.starts] - 1),
        ]).query("times > 0").astype("Int64")
        last = after.iloc[-1]
        self._state.update((None if pd.isna(last) else int(last), bool(seen)))
        frame.insert(0, "vm_name", key[0])
        yield frame

    def ends(
        self, now: pd.DataFrame, before: pd.Series, seen: bool
    ) -> tuple[list[pd.DataFrame], bool]:
        """Rows of ends, and `seen` after these instants."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def _rows(opened: Any, closed: Any, first: int, times: Any) -> pd.DataFrame:
    frame = pd.DataFrame({"opened": opened, "closed": closed}, dtype="Int64")
    return frame.assign(first=first, times=times)


class _PairSessions(_Fold):
    starts = "n_in"

    def ends(
        self, now: pd.DataFrame, before: pd.Series, seen: bool
    ) -> tuple[list[pd.DataFrame], bool]:
        begins_log = (now.index == 0) & (not seen)
        chosen = (now["n_out"] > 0) & (before.notna() | begins_log)
        return [_rows(before[chosen], now["sec"][chosen], 1, 1)], True


class _FoldPower(_Fold):
    starts = "n_on"

    def ends(
        self, now: pd.DataFrame, before: pd.Series, seen: bool
    ) -> tuple[list[pd.DataFrame], bool]:
        started = now["n_on"].cumsum()
        known = (started - now["n_on"] > 0) | seen
        chosen = known & before.notna() & (now["n_suspend"] + now["n_delete"] > 0)
        late = (now["n_suspend"] - chosen).clip(lower=0).where(known, 0)
        lone = pd.Series(pd.NA, now.index, "Int64")
        return [
            _rows(before[chosen], now["sec"][chosen], 1, 1), _rows(lone, now["sec"], 1, late),
        ], seen or bool(started.iloc[-1] > 0)


def _stateful(instants: DataFrame, fold: _Fold, opened: str, closed: str) -> DataFrame:
    rows = instants.groupBy("vm_name").transformWithStateInPandas(
        statefulProcessor=fold, outputStructType=ROWS, outputMode="append", timeMode="None"
    )

    def time(column: str) -> Column:
        return F.timestamp_seconds(column).cast("timestamp_ntz")

    return unfold(rows, "times", "copy").select(
        "vm_name", time("opened").alias(opened), time("closed").alias(closed),
        (F.col("copy") + F.col("first") - 1).alias("copy"),
    )


def latest_rows(stored: DataFrame, opened: str, closed: str) -> DataFrame:
    """(vm_name, opened, closed) as they stand: a row that was stored open and then closed
    appears closed. What an upsert keyed by (vm_name, opened, copy) leaves."""
    lone = F.when(F.col(opened).isNull(), F.col(closed)).alias("lone")
    keys = F.struct("vm_name", opened, "copy", lone).alias("key")
    return stored.groupBy(keys).agg(F.max(closed).alias(closed)).select(
        "key.vm_name", f"key.{opened}", closed
    )


def stream_sessions(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(vm_name, login_ts, logout_ts, copy) of a stream of (vm_name, dt, action).

    A session comes out open when it begins, and again when it is closed; `copy`
    numbers logins of one second. `latest_rows` gives one row per session.
    """
    action = F.col("action")
    instants = _instants(
        events.filter(action.isin("in", "out")), "dt", delay,
        n_in=action == "in", n_out=action == "out",
    )
    return _stateful(instants, _PairSessions(), "login_ts", "logout_ts")


def stream_uptime(ops: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(vm_name, power_on, power_off, copy) of a stream of (vm_name, ts, op).

    An interval comes out open when it begins, and again when it is closed; `copy`
    numbers power-ons of one second. `latest_rows` gives one row per interval.
    """
    op = F.col("op")
    instants = _instants(
        ops.filter(op.isin(POWER_ON, SUSPEND, DELETE)), "ts", delay,
        n_on=op == POWER_ON, n_suspend=op == SUSPEND, n_delete=op == DELETE,
    )
    return _stateful(instants, _FoldPower(), "power_on", "power_off")
