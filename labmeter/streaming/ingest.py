"""Stateless streams: attribution of logons and logoffs, and the change feed.

Every function needs only the rows of its own micro-batch and static tables.
`creation_ops` and `ops_to_log` need no form of their own: they take streams as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labmeter.functions.clock import whole_second
from labmeter.operators.attribution import attribute_events
from labmeter.operators.cell_index import CellIndex
from labmeter.operators.changes import describe_changes, first_changes, logged_changes
from labmeter.operators.fold_store import FoldStore
from labmeter.operators.lifetimes import deletions
from labmeter.sources.sinks import stamp_arrival, target_table

REJECTED = "Rejected"


def stream_attribute(
    events: DataFrame,
    reservations: DataFrame | CellIndex,
    sink: str,
    checkpoint: str,
    exact: bool = False,
    overrides: Mapping[str, str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Attribute a stream of (ts, action, address, ...) and store it by target table.

    A micro-batch writes one folder of its own, so a repeated batch replaces its
    earlier attempt. It is read once: its rows are kept while it feeds the time range, the distinct
    moments and the final join. With a stored index it reads the cells of its own addresses and no
    reservation, and sees what was merged before it began. Events that match no reservation, or whose action has no table,
    go to `target=Rejected`. Times are cut to whole seconds and every row is stamped
    with its arrival.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("ts", whole_second(F.col("ts"))).persist()
        try:
            _store(batch, batch_id)
        finally:
            batch.unpersist()

    def _store(batch: DataFrame, batch_id: int) -> None:
        if isinstance(reservations, CellIndex):
            rows = reservations.attribute(batch, exact=exact, overrides=overrides)
        else:
            rows = attribute_events(batch, reservations, exact=exact, overrides=overrides)
        table = F.coalesce(target_table(F.col("action")), F.lit(REJECTED))
        target = F.when(F.col("vm_name").isNull(), REJECTED).otherwise(table)
        stamp_arrival(rows).withColumn("target", target).write.mode("overwrite").partitionBy("target").parquet(
            f"{sink}/batch={batch_id}"
        )

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_index(
    reservations: DataFrame, index: CellIndex, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Merge a stream of new reservations into a stored index. A repeated micro-batch changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        index.merge(batch, batch_id)

    writer = reservations.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_fold(events: DataFrame, store: FoldStore, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Merge a stream of events into a stored fold: nothing is too late for it. A repeated micro-batch changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.merge(batch, batch_id)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_events(spark: SparkSession, sink: str, target: str) -> DataFrame:
    """What `stream_attribute` stored for one target table, or the rejects."""
    rows = spark.read.option("basePath", sink).parquet(sink)
    return rows.filter(F.col("target") == target).drop("batch", "target")


def stream_changes(
    power_log: DataFrame, reservations: DataFrame, employees: DataFrame
) -> DataFrame:
    """A change for each deletion that arrives. The stream's offset is the high-water mark.

    A VM comes again with each deletion: upsert by `vm_name`, see `latest_changes`.
    """
    changes = logged_changes(reservations, deletions(power_log)).drop("operation")
    return describe_changes(changes, employees)


def stream_new_reservations(reservations: DataFrame, employees: DataFrame) -> DataFrame:
    """A change for each reservation that arrives."""
    return describe_changes(first_changes(reservations), employees)
