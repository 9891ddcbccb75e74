"""One-permutation MinHash fingerprints, and their likeness along a table in order of id.

All shingles of a text are hashed once. The leading bits of a hash choose one of BINS bins and each bin keeps
its smallest hash. An empty bin takes the content of another one that a hash of (bin, attempt) names, trying
again until that one is full (optimal densification). Of every bin only the lowest LOW_BITS bits are
stored, after a hash of content and bin. Two different sets agree there by chance in 1 of 2 ** LOW_BITS bins, which the
likeness corrects.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeter.llm.shingles import distinct_sets, mix, slices

BINS = 512
LOW_BITS = 4
ROWS_A_CELL = 4096
MOST_CELLS = 20_000

_SHIFT = np.uint64(64 - int(math.log2(BINS)))


def sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts x BINS) low-order bits, and which texts have words at all."""
    tokens, at = distinct_sets(column)
    rows = len(at) - 1
    owner = np.repeat(np.arange(rows), np.diff(at))
    cell = owner * BINS + (tokens >> _SHIFT).astype(np.int64)  # tokens are sorted in each text: the first of a bin is its smallest
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    value = np.zeros(rows * BINS, np.uint64)
    full = np.zeros(rows * BINS, bool)
    value[cell[first]] = tokens[first]
    full[cell[first]] = True
    some = np.diff(at) > 0
    empty = np.flatnonzero(~full & np.repeat(some, BINS))
    attempt = 0
    while len(empty):
        attempt += 1
        bins = (empty % BINS).astype(np.uint64)
        other = (mix(bins + np.uint64(attempt * BINS)) % np.uint64(BINS)).astype(np.int64)
        source = empty - empty % BINS + other
        found = full[source]
        value[empty[found]] = value[source[found]]
        empty = empty[~found]
    stamp = mix(np.arange(BINS, dtype=np.uint64))  # bins with one and the same content get bits of their own
    low = mix(value.reshape(rows, BINS) ^ stamp) & np.uint64(2**LOW_BITS - 1)
    return low.astype(np.uint8), some


def packed(low: np.ndarray, some: np.ndarray) -> list[str]:
    """Hexadecimal fingerprints; the empty string for texts without words."""
    whole = low[:, 0::2] << LOW_BITS | low[:, 1::2] if LOW_BITS == 4 else low
    return [row.tobytes().hex() if has else "" for row, has in zip(whole, some)]


def likeness(x: np.ndarray, x_some: np.ndarray, y: np.ndarray, y_some: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity row by row: 1 for two empty sets, 0 for an empty and another one."""
    chance = 2.0**-LOW_BITS
    agree = (x == y).mean(axis=1) if len(x) else np.zeros(0)
    found = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(x_some & y_some, found, (x_some == y_some).astype(float))


def _celled(ids: str, bounds: np.ndarray, heads: list[int] | None, previous: dict[int, int]):
    """Rows with their cell; the first rows of a cell also go to the end of the cell before."""

    def cells_of(column: pa.Array) -> np.ndarray:
        values = column.to_numpy(zero_copy_only=False)
        known = column.is_valid().to_numpy(zero_copy_only=False)
        place = len(bounds) - np.searchsorted(bounds, np.where(known, values, 0).astype(np.int64), "left")
        return np.where(known, place, len(bounds) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            cell = cells_of(column)
            if heads is None:
                yield pa.RecordBatch.from_arrays([column, pa.array(cell, pa.int64())], names=[ids, "cell"])
                continue
            names = [*batch.schema.names, "cell", "tail"]
            zeros = pa.array(np.zeros(len(cell), np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), zeros], names=names)
            first = {}
            text = batch.column("text")
            for i in np.flatnonzero(np.isin(cell, list(previous))).tolist():
                if column[i].as_py() == heads[int(cell[i])]:
                    key = int(cell[i])
                    if key not in first or text[i].as_py() < text[first[key]].as_py():
                        first[key] = i
            if first:
                rows = pa.array(list(first.values()))
                yield pa.RecordBatch.from_arrays([
                    *[c.take(rows) for c in batch.columns], pa.array([previous[c] for c in first], pa.int64()),
                    pa.array(np.ones(len(first), np.int32)),
                ], names=names)

    return run


def in_order(docs: DataFrame, ids: str) -> DataFrame:
    """(ids, text, cell, tail) sorted by falling id inside cells, one cell after the other.

    Cells are ranges of ids of about ROWS_A_CELL rows. Each ends in a copy (tail = 1) of the first row of the next one
    (the last: of the first), so that every row is followed by the next one in its own cell.
    The driver sees the bounds and the largest id of each cell: two numbers a cell, MOST_CELLS at most.
    """
    spark = docs.sparkSession
    kind = docs.schema[ids].dataType.simpleString()
    cells = min(MOST_CELLS, max(1, math.ceil(docs.count() / ROWS_A_CELL)))
    steps = [i / cells for i in range(1, cells)]
    found = docs.select(ids).approxQuantile(ids, steps, 0.2 / cells) if steps else []
    bounds = np.unique(np.array([int(b) for b in found], np.int64))
    tops = (
        docs.select(ids).mapInArrow(_celled(ids, bounds, None, {}), f"`{ids}` {kind}, cell bigint")
        .groupBy("cell").agg(F.max(ids).alias("top")).orderBy("cell").collect()
    )
    order = [r["cell"] for r in tops]
    heads = {r["cell"]: r["top"] for r in tops}
    previous = {c: order[i - 1] for i, c in enumerate(order)}
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(order))
    return (
        docs.mapInArrow(_celled(ids, bounds, heads, previous), f"`{ids}` {kind}, text string, cell bigint, tail int")
        .repartition(parts, "cell").sortWithinPartitions("cell", "tail", F.col(ids).desc_nulls_last(), "text")
    )


def _compared(ids: str):
    names = [ids, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def pairs(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Results for all rows but the last; each looks at the row after it."""
        text, cell, tail = rows.column("text"), rows.column("cell").to_numpy(), rows.column("tail").to_numpy()
        words = text.to_pylist()
        sized, digests, edited = [], [], []
        for this, after in zip(words[:-1], words[1:]):
            cut = len(this) // 3
            changed = this[:len(this) - cut] + after[:cut]
            sized.append(len(this))
            digests.append(hashlib.sha256(changed.encode()).hexdigest())
            edited.append(changed)
        low, some = sketches(text)
        other, other_some = sketches(pa.array(edited, pa.string()))
        keep = pa.array((cell[:-1] == cell[1:]) & (tail[:-1] == 0))
        return pa.RecordBatch.from_arrays([
            rows.column(ids)[:-1], pa.array(sized, pa.int64()), pa.array(digests, pa.string()),
            pa.array(packed(low, some)[:-1], pa.string()), pa.array(packed(other, other_some), pa.string()),
            pa.array(likeness(low[:-1], some[:-1], other, other_some)), pa.array(likeness(low[:-1], some[:-1], low[1:], some[1:])),
        ], names=names).filter(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for low, high in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                if len(part) > 1:
                    yield pairs(part)
                held = part.slice(len(part) - 1)

    return run


def fingerprint_edits(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and its likeness to both the edit and the next row.

    The edited text has its last third (rounded down) replaced by as many first code points of the next row's text (or all), by
    falling id; the row after the last is the first. Null text: empty. Rows with the same id stand in the order of
    their texts, rows without id come last. A single row is its own next. An empty table gives no rows.
    """
    whole = docs.select(F.col(ids).alias(ids), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = whole.schema[ids].dataType.simpleString()
    return in_order(whole, ids).mapInArrow(
        _compared(ids),
        f"`{ids}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
