"""Best-fit packing of documents into sequences of tokens, by linear grouping.

Lengths are whole numbers up to the capacity, so that the histogram of lengths holds all that a packing needs, whatever
the number of documents. The plan is made on it (at most ``capacity`` counts reach the driver):

1. *Group.* Pieces longer than a part of a sequence are ranked by length and cut into groups of equal number; within a group
   lengths are rounded up to its longest. Few small pieces want a small part and many small ones a large part: of the plans for
   SHAPES (groups, part) the one with the fewest sequences counts.
2. *Configurations.* Which of the few rounded lengths share a sequence, and how often, is a linear program over configurations,
   solved by generating columns: duals price the lengths, a knapsack finds the best new configuration. Counts are rounded down.
3. *Substitute.* Each slot takes an actual piece of its group; sequences whose slots hold the same lengths stay one class.
4. *Best fit.* What is left and all small pieces go, longest first, where the least room is left.

The plan says, for ranges of ranks within one length, in which sequences and at what offset they go. Ranks come from numbering
pieces within a task and running sums over the tasks, so that a length which a third of all pieces share needs no task of its own.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labmeter.llm import bytepairs
from labmeter.llm.scratch import keep
from labmeter.llm.shingles import slices

CAPACITY = 2048
END = 0
SHAPES = ((96, 1 / 8), (128, 1 / 4), (192, 1 / 3), (256, 0.45))
IN_GROUP = 8
ROUNDS = 1000


def fullest(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How often to take each size so that the prices within the capacity are highest, and their sum."""
    best = np.zeros(capacity + 1)
    held = np.zeros((len(sizes), capacity + 1), np.int32)
    for i, (size, worth) in enumerate(zip(sizes.tolist(), price.tolist())):
        if worth <= 0:
            continue
        before = best.copy()
        for n in range(1, capacity // size + 1):
            other = before[:capacity + 1 - n * size] + n * worth
            better = other > best[n * size:] + 1e-12
            best[n * size:][better] = other[better]
            held[i, n * size:][better] = n
    taken, room = np.zeros(len(sizes)), capacity
    for i in range(len(sizes) - 1, -1, -1):
        taken[i] = held[i, room]
        room -= int(taken[i]) * int(sizes[i])
    return taken, float(best[capacity])


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Columns of how often a configuration holds each size, and how many sequences have each: whole numbers that exceed no demand.

    Every basis on the way is a feasible plan, so that ``rounds`` bounds the work and not the result's rightness.
    """
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    nudged = demand * (1 + 1e-6 * np.cos(np.arange(len(sizes))))  # no two ratios tie, so that no basis comes twice
    amount = inverse @ nudged
    for _ in range(rounds):
        taken, worth = fullest(sizes, inverse.sum(axis=0), capacity)
        if worth <= 1 + 1e-6:
            break
        step = inverse @ taken
        ratio = np.full(len(sizes), np.inf)
        grows = step > 1e-9
        ratio[grows] = amount[grows] / step[grows]
        out = int(np.argmin(ratio))
        row, size = inverse[out] / step[out], ratio[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        amount = np.maximum(amount - step * size, 0)
        amount[out] = size
        columns[:, out] = taken
    whole = np.floor(np.maximum(np.linalg.solve(columns, demand), 0) + 1e-6).astype(np.int64)
    return columns.astype(np.int64), whole


@dataclass
class Plan:
    """Ranges of ranks within a length, and where they go: ``per`` pieces to each sequence from ``first`` on, at ``offset``."""

    capacity: int
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    n_sequences: int = 0

    def put(self, length: int, rank: int, number: int, first: int, per: int, offset: int) -> None:
        self.rows.append((length, rank, number, first, per, offset))

    def new(self, number: int) -> int:
        self.n_sequences += number
        return self.n_sequences - number

    def table(self) -> np.ndarray:
        """(length, rank, number, first, per, offset) by length and rank."""
        made = np.array(self.rows, np.int64).reshape(-1, 6)
        return made[np.lexsort((made[:, 1], made[:, 0]))]


def _grouped(lengths: list[int], counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded length, runs of [length, rank, number]) of each group, longest first. Groups of one rounded length are one."""
    total, done, made = sum(counts[n] for n in lengths), 0, []
    for n in lengths:
        rank = 0
        while rank < counts[n]:
            group = done * groups // total
            end = -(-(group + 1) * total // groups)  # the first rank of the next group
            part = min(counts[n] - rank, end - done)
            if made and (made[-1][2] == group or made[-1][0] == n):
                made[-1][1].append([n, rank, part])
            else:
                made.append((n, [[n, rank, part]], group))
            rank, done = rank + part, done + part
    return [(size, runs) for size, runs, _ in made]


def _place_groups(plan: Plan, grouped: list[tuple[int, list[list[int]]]], rooms: dict[int, list[tuple[int, int]]]) -> list[list[int]]:
    """Fills the configurations' slots; adds the classes of sequences to ``rooms`` and returns the runs that are left."""
    sizes = np.array([s for s, _ in grouped])
    demand = np.array([sum(r[2] for r in runs) for _, runs in grouped], float)
    columns, amounts = configurations(sizes, demand, plan.capacity)
    for j in np.argsort(-amounts, kind="stable").tolist():
        if not amounts[j]:
            continue
        classes = [(plan.new(int(amounts[j])), int(amounts[j]), 0)]
        for i in np.flatnonzero(columns[:, j]).tolist():
            runs = grouped[i][1]
            for _ in range(columns[i, j]):
                classes = _fill_slot(plan, classes, runs)
        for first, number, used in classes:
            rooms.setdefault(plan.capacity - used, []).append((first, number))
    return [run for _, runs in grouped for run in runs if run[2]]


def _fill_slot(plan: Plan, classes: list[tuple[int, int, int]], runs: list[list[int]]) -> list[tuple[int, int, int]]:
    """One piece to each sequence of the classes (first, number, used), which part where lengths change."""
    made = []
    for first, number, used in classes:
        while number:
            while runs and not runs[0][2]:
                runs.pop(0)
            if not runs:
                made.append((first, number, used))
                break
            length, rank, left = runs[0]
            part = min(number, left)
            plan.put(length, rank, part, first, 1, used)
            runs[0][1:] = rank + part, left - part
            made.append((first, part, used + length))
            first, number = first + part, number - part
    return made


def _best_fit(plan: Plan, runs: list[list[int]], rooms: dict[int, list[tuple[int, int]]]) -> None:
    """Longest first, each piece where the least room is left; equal pieces and equal rooms in one go."""
    order = sorted(rooms)
    for length, rank, left in sorted(runs, key=lambda r: (-r[0], r[1])):
        while left:
            place = bisect.bisect_left(order, length)
            if place == len(order):
                per = plan.capacity // length
                number = -(-left // per)
                room, classes = plan.capacity, [(plan.new(number), number)]
            else:
                room = order.pop(place)
                per, classes = room // length, rooms.pop(room)
            back: dict[int, list[tuple[int, int]]] = {}
            for first, number in classes:
                whole = min(number, left // per)
                if whole:
                    plan.put(length, rank, whole * per, first, per, plan.capacity - room)
                    back.setdefault(room - per * length, []).append((first, whole))
                    rank, left = rank + whole * per, left - whole * per
                    first, number = first + whole, number - whole
                if number and 0 < left < per:
                    plan.put(length, rank, left, first, left, plan.capacity - room)
                    back.setdefault(room - left * length, []).append((first, 1))
                    rank, left, first, number = rank + left, 0, first + 1, number - 1
                if number:
                    back.setdefault(room, []).append((first, number))
            for rest, same in back.items():
                if rest not in rooms:
                    bisect.insort(order, rest)
                rooms.setdefault(rest, []).extend(same)


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, shapes: tuple[tuple[int, float], ...] = SHAPES) -> Plan:
    """The plan with the fewest sequences among those of the given shapes (ties: the first)."""
    plans = []
    for number, large in shapes:
        plan, rooms = Plan(capacity), {}
        lengths = sorted((n for n in histogram if large * capacity < n < capacity), reverse=True)
        runs = [[n, 0, c] for n, c in histogram.items() if n <= large * capacity or n >= capacity]
        if lengths:
            number = max(1, min(number, sum(histogram[n] for n in lengths) // IN_GROUP))
            runs += _place_groups(plan, _grouped(lengths, histogram, number), rooms)
        _best_fit(plan, runs, rooms)
        plans.append(plan)
    return min(plans, key=lambda p: p.n_sequences)


def cut(docs: DataFrame, path: str = bytepairs.MODEL, capacity: int = CAPACITY, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """(ids, piece, start, length, tokens) of every row: the text's ids and then ``END``, in pieces of at most ``capacity``.

    ``tokens`` are little-endian unsigned 32-bit numbers. Only a document of more than ``capacity`` tokens is cut; all its pieces but
    the first are full. Null and empty texts are one ``END``. Repeated rows and null ids are documents of their own; other
    columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bytepairs.read(path))
    docs = docs.select(F.col(ids).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for low, high in slices(batch.column("text")):
                rows, starts, sizes, tokens = [], [], [], []
                for row, value in enumerate(batch.column("text")[low:high].to_pylist(), low):
                    found = np.append(model.marked(value or ""), np.uint32(END)).astype("<u4")
                    edge = (len(found) - 1) % capacity + 1
                    edges = [0, *range(edge, len(found) + 1, capacity)]
                    rows += [row] * (len(edges) - 1)
                    starts += edges[:-1]
                    sizes += np.diff(edges).tolist()
                    tokens += [found[a:b].tobytes() for a, b in zip(edges, edges[1:])]
                rows = np.array(rows)
                piece = np.arange(len(rows)) - np.searchsorted(rows, rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary()),
                ], names=[ids, "piece", "start", "length", "tokens"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"`{ids}` {kind}, piece int, start bigint, length bigint, tokens binary")


def _numbered(pieces: DataFrame, length: str, capacity: int) -> DataFrame:
    """With the task's number and how many pieces of the same length the task had before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, so_far = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(length).to_numpy()
            order = np.argsort(sizes, kind="stable")
            own = sizes[order]
            nth = np.empty(len(sizes), np.int64)
            nth[order] = np.arange(len(sizes)) - np.searchsorted(own, own) + so_far[own]
            so_far += np.bincount(sizes, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), task), pa.int64()), pa.array(nth)],
                names=[*batch.schema.names, "__task", "__nth"],
            )

    return pieces.mapInArrow(run, StructType([*pieces.schema.fields, *StructType.fromDDL("__task bigint, __nth bigint").fields]))


def place(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", shapes: tuple[tuple[int, float], ...] = SHAPES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: the sequence that a piece of 1 to ``capacity`` tokens goes to, and its place there.

    Pieces of a sequence lie one behind the other without gaps, and no piece is left out. All other columns pass (columns of the two names
    are replaced). The rows are written once, so that numbers hold when a task is lost. An empty table stays empty.
    """
    pieces = pieces.drop("sequence_id", "offset")
    spark = pieces.sparkSession
    kept = keep(_numbered(pieces, length, capacity), "pieces")
    size = F.col(length).alias("__size")
    counted = keep(kept.groupBy("__task", size).agg(F.count(F.lit(1)).alias("__n")), "piece-counts")
    histogram = {r[0]: r[1] for r in counted.groupBy("__size").agg(F.sum("__n")).collect()}  # at most ``capacity`` rows
    made = make_plan(histogram, capacity, shapes).table()
    shared = spark.sparkContext.broadcast((made, made[:, 0] << 48 | made[:, 1]))
    before = Window.partitionBy("__size").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("__task", "__size", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    ranked = kept.withColumn("__size", F.col(length)).join(bases, ["__task", "__size"]).select(
        *pieces.columns, (F.col("__base") + F.col("__nth")).alias("__rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = shared.value
        for batch in batches:
            sizes, rank = batch.column(length).to_numpy(), batch.column("__rank").to_numpy()
            row = table[np.searchsorted(keys, sizes << 48 | rank, "right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array(row[:, 3] + nth // row[:, 4]), pa.array(row[:, 5] + nth % row[:, 4] * sizes),
            ], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    added = StructType.fromDDL("sequence_id bigint, offset bigint").fields
    return ranked.mapInArrow(run, StructType([*pieces.schema.fields, *added]))


def pack(docs: DataFrame, path: str = bytepairs.MODEL, capacity: int = CAPACITY, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of ``cut``, with their tokens, placed by ``place``."""
    return place(cut(docs, path, capacity, ids, text), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, tokens): the whole sequences; none holds more than ``capacity`` tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "tokens")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_join(F.transform(parts, lambda p: F.hex(p["tokens"])), "").alias("tokens")
    ).withColumn("tokens", F.unhex("tokens"))
