"""Power operations: log entries, uptime intervals, and operations born of reservations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeter.functions.names import is_persistent
from labmeter.functions.status import CREATED, DELETE, POWER_ON, SUSPEND, op_name
from labmeter.operators.ordered import collapse, known_time, repeat_rows, with_neighbours

KEYS = ("vm_name",)
POWER_COUNTS = ["n_on", "n_suspend", "n_off"]


def ops_to_log(ops: DataFrame) -> DataFrame:
    """Power log rows of operation codes; codes that write nothing are left out."""
    named = ops.select("vm_name", F.col("ts").alias("log_ts"), op_name(F.col("op")).alias("operation"))
    return named.filter(F.col("operation").isNotNull())


def creation_ops(reservations: DataFrame) -> DataFrame:
    """The `created` operation each persistent reservation causes when it is added."""
    persistent = reservations.filter(is_persistent(F.col("vm_name")))
    return persistent.select("vm_name", F.col("start_ts").alias("ts"), F.lit(CREATED).alias("op"))


def uptime_intervals(ops: DataFrame) -> DataFrame:
    """(vm_name, power_on, power_off) intervals the operation log leaves behind.

    0 opens an interval. 1 and 2 close the latest one if it is open. On a closed
    one, 1 adds a row that has only a power-off. Before the first 0 nothing
    happens. At equal times 1 comes before 2, and both before 0. A new 0 leaves
    an older open interval open for good, so an interval can only be closed by
    the operation right after it.
    """
    near = with_neighbours(power_instants(ops), KEYS, "ts", POWER_COUNTS, ["n_on"])
    return repeat_rows(interval_rows(near, KEYS), F.col("times")).select(*KEYS, "power_on", "power_off")


def power_instants(ops: DataFrame) -> DataFrame:
    """One row per VM and second with counts of its operations."""
    op = F.col("op")
    relevant = ops.filter(op.isin(POWER_ON, SUSPEND, DELETE))
    return collapse(
        relevant, KEYS, "ts",
        n_on=op == POWER_ON, n_suspend=op == SUSPEND, n_off=op.isin(SUSPEND, DELETE),
    )


def interval_rows(near: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, power_on, power_off, times): the intervals of each instant, equal ones as one row."""
    none = F.lit(None).cast("timestamp_ntz")
    here, n_on = known_time(F.col("ts")), F.col("n_on")
    closing = F.when(F.col("next_n_off") > 0, F.col("next_ts"))
    closes_here = F.when(F.col("prev_n_on") > 0, F.least(F.col("n_suspend"), F.lit(1))).otherwise(0)
    late_suspends = F.when(F.col("before_n_on") > 0, F.col("n_suspend") - closes_here).otherwise(0)

    def row(on: Column, off: Column, times: Column) -> Column:
        return F.struct(on.alias("power_on"), off.alias("power_off"), times.cast("long").alias("times"))

    return near.select(
        *keys,
        F.inline(F.array(
            row(here, closing, F.least(n_on, F.lit(1))),
            row(here, none, n_on - 1),
            row(none, here, late_suspends),
        )),
    )


def latest_interval(intervals: DataFrame) -> DataFrame:
    """The interval with the latest power-on of each VM; of equal ones, the one closed last."""
    known = intervals.filter(F.col("power_on").isNotNull())
    latest = F.max(F.struct("power_on", "power_off"))
    return known.groupBy("vm_name").agg(latest.alias("top")).select("vm_name", "top.*")
