"""Order-dependent work on event logs without one task per key.

A plain window partitioned by VM sends every event of a VM to one task. Here
1. events of one key and second collapse to one row of counts. The aggregation
   combines map-side, so a mass of copies shrinks before it is shuffled;
2. each key's time axis is cut into slices, and windows run inside a slice. A
   slice holds at most one row per second, so its size has a bound that does
   not depend on how many events there are;
3. what a slice must know of the others (its neighbours, running totals) comes
   from one summary row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from labmeter.functions.clock import epoch_of, moment
from labmeter.functions.numbers import floor_div, int_div
from labmeter.functions.text import DAY

SLICE_SECONDS = 7 * DAY
COPIES_PER_BLOCK = 50_000
BEGINNING = "0001-01-01 00:00:00"


def known_time(ts: Column) -> Column:
    """Undo the stand-in that `collapse` uses for a missing time."""
    return F.nullif(ts, moment(BEGINNING))


def spread_group(df: DataFrame, *columns: Column) -> GroupedData:
    """Group by one struct, `key`, instead of by its columns.

    Spark then always shuffles by all of them. Grouping by plain columns would
    keep a layout by VM left by an earlier join: a busy VM would stay whole in
    one task, and its skewed join could not be split at run time.
    """
    return df.groupBy(F.struct(*columns).alias("key"))


def collapse(events: DataFrame, keys: Sequence[str], ts: str, **counted: Column) -> DataFrame:
    """One row per key and instant; each named condition becomes a count of rows.

    A missing time sorts before all others, so it becomes the earliest instant.
    Rows without a key belong to no log and are left out.
    """
    counts = [F.count_if(condition).alias(name) for name, condition in counted.items()]
    instant = F.coalesce(F.col(ts), moment(BEGINNING)).alias(ts)
    known = events.dropna(subset=list(keys))
    return spread_group(known, *map(F.col, keys), instant).agg(*counts).select("key.*", *counted)


def with_neighbours(
    instants: DataFrame, keys: Sequence[str], ts: str, counts: Sequence[str], running: Sequence[str]
) -> DataFrame:
    """Add, per key in time order, `next_*` and `prev_*` of `ts` and `counts`, and
    `before_*`: the sum of each of `running` over all earlier instants.

    `instants` has one row per key and instant, with at least one count above 0.
    The summaries read every count, needed or not: with the same columns as the
    rows themselves they share one shuffle (`ReusedExchange` in the plan).
    """
    sliced = in_slices(instants.select(*keys, ts, *counts), ts).repartition(*keys, "slice")
    summaries = slice_summaries(sliced, keys, ts, counts, running)
    return neighbours_in_slices(sliced, summaries, keys, ts, counts, running)


def in_slices(instants: DataFrame, ts: str) -> DataFrame:
    """Adds `slice`, the number of the stretch of time that an instant lies in."""
    return instants.withColumn("slice", F.coalesce(floor_div(epoch_of(F.col(ts)), SLICE_SECONDS), F.lit(0)))


def slice_summaries(
    sliced: DataFrame, keys: Sequence[str], ts: str, counts: Sequence[str], running: Sequence[str]
) -> DataFrame:
    """One row per key and slice: its first and last instant, and sums."""
    return sliced.groupBy(*keys, "slice").agg(
        *_columns(
            f"min({ts}) AS head_{ts}", f"max({ts}) AS tail_{ts}",
            *[f"min_by({c}, {ts}) AS head_{c}" for c in counts],
            *[f"max_by({c}, {ts}) AS tail_{c}" for c in counts],
            *[f"sum({c}) AS slice_{c}" for c in running],
            f"sum({' + '.join(counts)}) AS slice_events",
        )
    ).filter("slice_events > 0")


def neighbours_in_slices(
    sliced: DataFrame, summaries: DataFrame, keys: Sequence[str], ts: str, counts: Sequence[str], running: Sequence[str]
) -> DataFrame:
    """`with_neighbours` for the slices in `sliced`, each of them whole; `summaries` has all slices of their keys."""
    columns = [ts, *counts]
    key = ", ".join(keys)
    inside = f"PARTITION BY {key}, slice ORDER BY {ts}"
    across = f"PARTITION BY {key} ORDER BY slice"
    local = sliced.selectExpr(
        *keys, "slice", *columns,
        *[f"lead({c}) OVER ({inside}) AS next_{c}" for c in columns],
        *[f"lag({c}) OVER ({inside}) AS prev_{c}" for c in columns],
        *[f"{_sum_before(c, inside)} AS before_{c}" for c in running],
    )
    carry = summaries.selectExpr(
        *keys, "slice",
        *[f"lead(head_{c}) OVER ({across}) AS after_{c}" for c in columns],
        *[f"lag(tail_{c}) OVER ({across}) AS ahead_{c}" for c in columns],
        *[f"{_sum_before(f'slice_{c}', across)} AS carried_{c}" for c in running],
    )
    return local.join(carry, [*keys, "slice"]).selectExpr(
        *keys, "slice", *columns,
        *[f"coalesce(next_{c}, after_{c}) AS next_{c}" for c in columns],
        *[f"coalesce(prev_{c}, ahead_{c}) AS prev_{c}" for c in columns],
        *[f"before_{c} + carried_{c} AS before_{c}" for c in running],
    )


def _columns(*expressions: str) -> list[Column]:
    return [F.expr(e) for e in expressions]


def _sum_before(column: str, window: str) -> str:
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"coalesce(sum({column}) OVER ({window} {frame}), 0)"


def repeat_rows(df: DataFrame, times: Column, index: str = "copy") -> DataFrame:
    """Each row `times` times, numbered from 1 in `index`; rows with fewer than one go.

    One branch: what stands above (sorts, windows, joins) is planned once, at the price of
    one more shuffle of the rows that are not yet unfolded.
    """
    counted = df.withColumn("_times", times.cast("long")).filter("_times >= 1")
    return unfold(counted, "_times", index).drop("_times")


def unfold(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row as often as column `times` says, numbered from 1 in `index`.

    A row with many copies is cut into blocks that are spread over the cluster
    before they unfold, so no task has to write a whole group.
    """
    return unfold_blocks(cut_blocks(df, times).repartition(*df.columns, "block"), times, index)


def cut_blocks(df: DataFrame, times: str) -> DataFrame:
    """One row per `COPIES_PER_BLOCK` copies, numbered from 0 in `block`."""
    last = int_div(F.col(times) - 1, COPIES_PER_BLOCK)
    return df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def unfold_blocks(blocks: DataFrame, times: str, index: str) -> DataFrame:
    """The copies of each block, where the block is; keeps the order of rows."""
    first = F.col("block") * COPIES_PER_BLOCK + 1
    last = F.least(F.col(times), (F.col("block") + 1) * COPIES_PER_BLOCK)
    return blocks.withColumn(index, F.explode(F.sequence(first, last))).drop("block")
