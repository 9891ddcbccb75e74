"""A stored fold of an event log: sessions or uptime intervals, kept right by merging new events, early or late.

The log is cut into (VM, week) slices, as in `ordered`. Kept are, per merged batch of events: its instants, one
summary per slice, and the rows of the slices that it changed. A batch changes
- the slices that its events lie in,
- the nearest slices before and after these, whose last and first instant get another neighbour,
- for uptime, the slices that lie behind a new first power-on, up to the first one known before.

Only these are folded again, from their own instants and the summaries of their VMs. Summaries merge in any order, so that any
split of the log into batches gives the same table, whether an event comes on time, a year late, or in a stream
whose watermark has long passed it. A batch is named by the caller's number; its files are replaced when it repeats and
count when it is marked as done. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.operators import sessions, uptime
from labmeter.operators.ordered import in_slices, neighbours_in_slices, repeat_rows, slice_summaries

BUCKETS = 64
KEYS = ("vm_name",)


@dataclass(frozen=True)
class Fold:
    """How events become instants, and instants that know their neighbours become rows of (opened, closed, times)."""

    ts: str
    opened: str
    closed: str
    counts: Sequence[str]
    running: Sequence[str]
    instants: Callable[[DataFrame], DataFrame]
    rows: Callable[[DataFrame, Sequence[str]], DataFrame]


SESSIONS = Fold(
    "dt", "login_ts", "logout_ts", sessions.SESSION_COUNTS, [],
    lambda events: sessions.session_instants(events, KEYS),
    lambda near, keys: sessions.session_rows(sessions.openings_of(near, keys), keys),
)
UPTIME = Fold(
    "ts", "power_on", "power_off", uptime.POWER_COUNTS, ["n_on"], uptime.power_instants, uptime.interval_rows,
)


class FoldStore:
    """The folded table under `path`; the folder is made by the first `merge`."""

    def __init__(self, spark: SparkSession, path: str, fold: Fold, buckets: int = BUCKETS) -> None:
        self._spark, self._path, self._fold, self._buckets = spark, path.rstrip("/"), fold, buckets
        counts = ", ".join(f"{c} bigint" for c in fold.counts)
        ends = ", ".join(f"{side}_{c} bigint" for side in ("head", "tail") for c in fold.counts)
        sums = "".join(f", slice_{c} bigint" for c in fold.running)
        key, stored = "vm_name string, slice bigint", "batch bigint, bucket int"
        self._schemas = {
            "instants": f"{key}, {fold.ts} timestamp_ntz, {counts}, {stored}",
            "summaries": f"{key}, head_{fold.ts} timestamp_ntz, tail_{fold.ts} timestamp_ntz, {ends}{sums}, slice_events bigint, {stored}",
            "changed": f"{key}, {stored}",
            "rows": f"{key}, {fold.opened} timestamp_ntz, {fold.closed} timestamp_ntz, times bigint, {stored}",
            "done": "batch bigint",
        }

    def _read(self, name: str) -> DataFrame:
        """A stored table, or no rows before anything was stored."""
        folder, schema = f"{self._path}/{name}", self._schemas[name]
        try:
            return self._spark.read.schema(schema).option("basePath", folder).parquet(folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, name: str, batch: int) -> None:
        bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("vm_name"), F.lit(self._buckets)).cast("int"))
        bucketed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self._path}/{name}/batch={batch}"
        )

    def _done(self) -> list[int]:
        return [row.batch for row in self._read("done").collect()]

    def merge(self, events: DataFrame, batch: int) -> bool:
        """Takes in events as batch number `batch`, whatever their times; False when it is done already."""
        done, fold = self._done(), self._fold
        if batch in done:
            return False
        new = in_slices(fold.instants(events), fold.ts)
        self._write(new.select("vm_name", "slice", fold.ts, *fold.counts), "instants", batch)
        stored = self._read("instants").filter(F.col("batch") == batch)
        self._write(slice_summaries(stored, KEYS, fold.ts, fold.counts, fold.running), "summaries", batch)
        touched = [r.bucket for r in stored.select("bucket").distinct().collect()]  # at most as many as there are buckets
        known = F.col("bucket").isin(touched) & F.col("batch").isin([*done, batch])
        summaries = self._read("summaries").filter(known)
        fresh = summaries.filter(F.col("batch") == batch).select("vm_name").distinct()
        summaries = summaries.join(fresh, "vm_name", "left_semi")
        self._write(self._changed(summaries, batch), "changed", batch)
        changed = self._read("changed").filter(F.col("batch") == batch).select("vm_name", "slice")
        instants = self._read("instants").filter(known).join(changed, ["vm_name", "slice"], "left_semi")
        whole = instants.groupBy("vm_name", "slice", fold.ts).agg(*[F.sum(c).alias(c) for c in fold.counts])
        near = neighbours_in_slices(whole, self._merged(summaries), KEYS, fold.ts, fold.counts, fold.running)
        rows = fold.rows(near, ["vm_name", "slice"]).filter("times >= 1")
        self._write(rows, "rows", batch)
        self._spark.range(1).select(F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(
            f"{self._path}/done/at={batch}"
        )
        return True

    def _merged(self, summaries: DataFrame) -> DataFrame:
        """One summary per slice, of all batches: of a first or last second that several have, the sums of its counts."""
        ts, keys = self._fold.ts, ["vm_name", "slice"]
        ends = summaries.groupBy(*keys).agg(F.min(f"head_{ts}").alias("first"), F.max(f"tail_{ts}").alias("last"))
        at_end = {"head": F.col(f"head_{ts}") == F.col("first"), "tail": F.col(f"tail_{ts}") == F.col("last")}
        return summaries.join(ends, keys).groupBy(*keys).agg(
            F.min(f"head_{ts}").alias(f"head_{ts}"), F.max(f"tail_{ts}").alias(f"tail_{ts}"),
            *[
                F.sum(F.when(here, F.col(f"{side}_{c}"))).alias(f"{side}_{c}")
                for side, here in at_end.items() for c in self._fold.counts
            ],
            *[F.sum(f"slice_{c}").alias(f"slice_{c}") for c in self._fold.running],
        )

    def _changed(self, summaries: DataFrame, batch: int) -> DataFrame:
        """(vm_name, slice) to fold again. A VM has one row here per week, so that a window by VM is small."""
        new = F.max(F.col("batch") == batch).alias("new")
        opened = [
            F.max(F.when(condition, F.col(f"slice_{c}") > 0)).alias(name)
            for c in self._fold.running for name, condition in (
                ("opens", F.lit(True)), ("opened", F.col("batch") != batch),
            )
        ]
        each = summaries.groupBy("vm_name", "slice").agg(new, *opened)
        across = "OVER (PARTITION BY vm_name ORDER BY slice)"
        near: Column = F.expr(f"new OR coalesce(lead(new) {across}, false) OR coalesce(lag(new) {across}, false)")
        if opened:  # known from the first opening on: what the merge moved back changes all slices up to the old one
            first = "min(if({}, slice, NULL)) OVER (PARTITION BY vm_name)"
            now, before = first.format("opens"), first.format("opened")
            near = near | F.expr(
                f"coalesce(slice >= {now} AND {now} < coalesce({before}, {now} + 1) AND slice <= coalesce({before}, slice), false)"
            )
        return each.withColumn("near", near).filter("near").select("vm_name", "slice")

    def table(self) -> DataFrame:
        """(vm_name, opened, closed) of all events merged so far: each slice as the last batch that changed it left it."""
        done = self._done()
        latest = self._read("changed").filter(F.col("batch").isin(done)).groupBy("bucket", "vm_name", "slice").agg(
            F.max("batch").alias("batch")
        )
        rows = self._read("rows").join(latest, ["bucket", "vm_name", "slice", "batch"], "left_semi")
        return repeat_rows(rows.select("vm_name", self._fold.opened, self._fold.closed, "times"), F.col("times")).select(
            "vm_name", self._fold.opened, self._fold.closed
        )
