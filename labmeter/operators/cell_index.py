"""A stored index of reservations: a lookup reads the cells of its own addresses and no reservation.

Two tables under one folder, both cut by a hash of their key into folders `bucket=…`:
- `texts`: RDP texts under their rarest q-gram (`contains`), by gram;
- `cells`: calendar cells that reservations cover (`attribution`), by RDP text.

New reservations are merged as a batch of their own, named by the caller's number: its files are replaced when the
batch repeats, and count only when the batch is marked as done, so that a lost driver or a repeated micro-batch
changes nothing. Cells need no rewriting: a lookup adds up counts and takes the first by rank over all batches.
Where reservations changed, a batch can replace all that was known of the RDP texts it names. `compact` writes
everything into one new generation. One writer at a time; readers always see whole batches.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeter.functions.text import DAY, HOUR, MINUTE
from labmeter.operators.attribution import (
    CELL_UNITS, MOMENT, attributed, best_of, distinct_moments, interval_cells, probes, ranked_intervals,
)
from labmeter.operators.contains import lookup_grams, rare_grams, verified

BUCKETS = 64
# With all of CELL_UNITS, so that cells stored by these are found, and some between: fewer cells are written, read and joined.
UNITS = tuple(sorted({*CELL_UNITS, 8 * DAY, 6 * HOUR, 10 * MINUTE, 10}, reverse=True))

TEXTS = "gram string, rdp string, batch bigint, bucket int"
CELLS = (
    "rdp string, unit bigint, cell bigint, n bigint, best struct<age: bigint, vm_name: string>, "
    "batch bigint, bucket int"
)
RESETS = "rdp string, batch bigint, bucket int"
DONE = "batch bigint, shortest int, changed boolean"


class CellIndex:
    """The index under `path`; the folder is made by the first `merge`."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self._spark, self._path, self._buckets = spark, path.rstrip("/"), buckets

    def _read(self, name: str, schema: str) -> DataFrame:
        """A table, or no rows before anything was stored."""
        reader = self._spark.read.schema(schema)
        try:
            return reader.option("basePath", f"{self._path}/{name}").parquet(f"{self._path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._spark.createDataFrame([], schema)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self._buckets)).cast("int")

    def _generation(self) -> int:
        top = self._read("generations", "generation bigint").agg(F.max("generation")).first()[0]
        return top or 0

    def _state(self) -> tuple[str, list[int], int | None, list[int]]:
        """Folder of the current generation, its done batches, the length of the shortest text, batches that replace."""
        folder = f"g{self._generation()}"
        done = self._read(f"{folder}/done", DONE).collect()  # one row per batch since the last `compact`
        lengths = [row.shortest for row in done if row.shortest is not None]
        return folder, [row.batch for row in done], min(lengths, default=None), [row.batch for row in done if row.changed]

    def merge(self, reservations: DataFrame, batch: int, changed: bool = False) -> bool:
        """Adds reservations (vm_name, rdp, start_ts, end_ts) as batch number `batch`; False when it is done already.

        Numbers grow from call to call. With `changed` the rows are all reservations there are of the RDP texts they
        name, and what earlier batches told of these texts counts no more.
        """
        folder, done, _, _ = self._state()
        if done and batch <= max(done):
            return False
        known = ranked_intervals(reservations)
        cells = interval_cells(known, units=UNITS).withColumn("bucket", self._bucket("rdp"))
        taken = self._read(f"{folder}/texts", TEXTS).filter(F.col("batch").isin(done)).groupBy("gram").agg(
            F.count(F.lit(1)).alias("n")
        )
        texts = rare_grams(known, "rdp", taken).withColumn("bucket", self._bucket("gram"))
        self._write(cells, f"{folder}/cells", batch)
        self._write(texts, f"{folder}/texts", batch)
        if changed:
            named = reservations.select(F.lower("rdp").alias("rdp")).dropna().distinct()
            self._write(named.withColumn("bucket", self._bucket("rdp")), f"{folder}/resets", batch)
        self._mark(folder, batch, changed)
        return True

    def _write(self, rows: DataFrame, name: str, batch: int) -> None:
        """One file per bucket and task that has rows of it; large buckets are split at run time."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self._path}/{name}/batch={batch}"
        )

    def _mark(self, folder: str, batch: int, changed: bool) -> None:
        stored = self._read(f"{folder}/texts", TEXTS).filter(F.col("batch") == batch)
        stored.agg(F.min(F.length("rdp")).alias("shortest")).select(
            F.lit(batch).cast("long").alias("batch"), "shortest", F.lit(changed).alias("changed")
        ).write.mode("overwrite").parquet(f"{self._path}/{folder}/done/at={batch}")

    def _cells(self, folder: str, batches: list[int]) -> DataFrame:
        """(bucket, rdp, unit, cell, n, best, batch) of the done batches."""
        return self._read(f"{folder}/cells", CELLS).filter(F.col("batch").isin(batches))

    def _since(self, rows: DataFrame, folder: str, changed: list[int], buckets: list[int] | None = None) -> DataFrame:
        """Adds `since`, the last batch that replaced what was known of a row's RDP text: cells of earlier ones count no more."""
        if not changed:
            return rows.withColumn("since", F.lit(None).cast("bigint"))
        resets = self._read(f"{folder}/resets", RESETS).filter(F.col("batch").isin(changed))
        if buckets is not None:
            resets = resets.filter(F.col("bucket").isin(buckets))
        return rows.join(resets.groupBy("bucket", "rdp").agg(F.max("batch").alias("since")), ["bucket", "rdp"], "left")

    def _pairs(self, asking: DataFrame, folder: str, batches: list[int], shortest: int | None, exact: bool) -> DataFrame:
        """(address, rdp, bucket) for the indexed texts that an address contains."""
        if exact:
            pairs = asking.select("address", F.lower("address").alias("rdp")).distinct()
        else:
            length = F.lit(shortest).cast("int")
            asked = lookup_grams(asking, "address", length).withColumn("bucket", self._bucket("gram"))
            texts = self._read(f"{folder}/texts", TEXTS).filter(F.col("batch").isin(batches))
            texts = texts.filter(F.col("bucket").isin(self._some(asked))).select("bucket", "gram", "rdp")
            pairs = verified(asked.join(texts, ["bucket", "gram"]), "address").distinct()
        return pairs.withColumn("bucket", self._bucket("rdp"))

    def _located(self, moments: DataFrame, folder: str, batches: list[int], shortest: int | None, exact: bool) -> DataFrame:
        """(address, ts, rdp, bucket) for the indexed texts that a moment's address contains."""
        return moments.join(self._pairs(moments, folder, batches, shortest, exact), "address")

    def _some(self, keyed: DataFrame) -> list[int]:
        """The buckets that occur: at most as many numbers as there are buckets. They prune the files to read."""
        return sorted(row.bucket for row in keyed.select("bucket").distinct().collect())

    def _stored(self, rows: DataFrame, scratch: str | None, name: str) -> DataFrame:
        """The rows as a table of their own, where there is a folder for it."""
        if scratch is None:
            return rows
        rows.write.parquet(f"{scratch}/{name}")
        return self._spark.read.schema(rows.schema).parquet(f"{scratch}/{name}")

    def find(self, events: DataFrame, exact: bool = False, scratch: str | None = None) -> DataFrame:
        """(address, ts, vm_name, match_count) for the moments of the events that a reservation covers.

        The buckets to read are known before the lookup is planned, so that the events are read several times. Where that is
        costly, `scratch` names a new folder: moments and the texts they contain are written there once and read from then on.
        """
        folder, batches, shortest, changed = self._state()
        moments = self._stored(distinct_moments(events), scratch, "moments")
        pairs = self._stored(self._pairs(moments, folder, batches, shortest, exact), scratch, "pairs")
        buckets = self._some(pairs)
        located = moments.join(self._since(pairs, folder, changed, buckets), "address")
        cells = self._cells(folder, batches).filter(F.col("bucket").isin(buckets))
        asked = probes(located, "bucket", "since", units=UNITS)
        hits = asked.join(cells, ["bucket", "rdp", "unit", "cell"]).filter("batch >= coalesce(since, batch)")
        return best_of(hits.withColumn("source", F.lit(0))).select(*MOMENT, "vm_name", "match_count")

    def attribute(
        self, events: DataFrame, now: Column | datetime | str | None = None, exact: bool = False,
        overrides: Mapping[str, str] | None = None, scratch: str | None = None,
    ) -> DataFrame:
        """Events (address, ts, ...) with `vm_name` and `match_count`, as `attribution.attribute_events` gives them; `scratch`: see `find`."""
        return attributed(events, lambda asked: self.find(asked, exact, scratch), now, overrides)

    def compact(self) -> None:
        """Writes all done batches as one batch of a new generation, without what was replaced. A repeat does no harm."""
        folder, batches, _, changed = self._state()
        if not batches:
            return
        target, last = f"g{self._generation() + 1}", max(batches)
        known = self._since(self._cells(folder, batches), folder, changed).filter("batch >= coalesce(since, batch)")
        cells = known.groupBy("bucket", "rdp", "unit", "cell").agg(
            F.sum("n").alias("n"), F.min("best").alias("best")
        )
        self._write(cells, f"{target}/cells", last)
        kept = self._read(f"{target}/cells", CELLS).filter(F.col("batch") == last)
        texts = rare_grams(kept).withColumn("bucket", self._bucket("gram"))
        self._write(texts, f"{target}/texts", last)
        self._mark(target, last, False)
        number = self._generation() + 1
        self._spark.range(1).select(F.lit(number).cast("long").alias("generation")).write.mode("overwrite").parquet(
            f"{self._path}/generations/at={number}"
        )
