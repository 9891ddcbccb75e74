"""Periodic runs of words, found online by catching squares over dyadic blocks.

A square of period q is a stretch that repeats at distance q at once. For q from 2**k to 2**(k + 1) - 1 its first half holds a
whole aligned block of h = 2**(k - 1) words. Each completed block of level k is a catcher: it waits for the suffix of h words that
equals it while that suffix begins 2**k to 2**(k + 1) - 1 words after it. An appended word therefore makes two comparisons of
suffix hashes at each level, and the hash of a suffix of 2h words comes from two of h. Catches of one period in neighbouring
blocks belong to one run: the first chain of them that is long enough is extended to both sides, word by word, and
then grows with the words that are appended. A multiple of a known run's period inside that run is no new run.

Words are 64-bit hashes (equal hashes count as equal words). All words of an ``append`` go through a level as one column.
Work grows with n log n; what is kept beyond the words are block hashes, at most one a word and level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labmeter.llm.shingles import _EXACT_BYTE, _STEP, buffers, mix, runs, slices

TIMES = 4
LEAST = 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_EDGE = np.uint64(0xA24BAED4963EE407)


class _Level:
    """Catchers of one level: period ``low`` to ``2 * low - 1``, blocks of ``size`` words."""

    def __init__(self, k: int, times: int, least: int):
        self.low = 1 << k
        self.size = max(1, self.low >> 1)
        self.slots = 1 if k == 0 else 2
        periods = np.arange(self.low, min(2 * self.low, self.low + least + 1))
        shortest = int(np.maximum((times - 1) * periods, least - periods).min())
        self.chain = max(1, (shortest - self.size + 1) // self.size)  # whole blocks inside any run that counts
        self.blocks = np.zeros(0, np.uint64)
        self.caught = np.zeros((self.slots, self.chain * self.size), bool)  # of the latest suffixes


class Catchers:
    """All runs of the words appended so far that have ``length >= max(least, times * period)`` and a period up to ``longest``."""

    def __init__(self, longest: int, times: int = TIMES, least: int = LEAST):
        self.times, self.least = times, least
        self.words = np.zeros(0, np.uint64)
        self.levels = [_Level(k, times, least) for k in range(max(0, longest).bit_length())]
        self.longest = longest
        self.tails: dict[int, np.ndarray] = {}
        self.found: list[list[int]] = []  # start, end, period; those that reach the end of the words may still grow
        self.open: list[int] = []
        self.cover = np.zeros(0, np.int32)  # the run that was found last over a word, counted from 1

    def append(self, words: np.ndarray) -> None:
        old = len(self.words)
        self.words = np.concatenate([self.words, words.astype(np.uint64)])
        self.cover = np.concatenate([self.cover, np.zeros(len(words), np.int32)])
        still = []
        for i in self.open:
            run = self.found[i]
            before, run[1] = run[1], self._right(run[1] - run[2], run[2]) + run[2]
            self.cover[before:run[1]] = i + 1
            if run[1] == len(self.words):
                still.append(i)
        self.open = still
        hashes, first = self.words[old:], old  # of the suffixes that begin at ``first`` and after
        size = 1
        for level in self.levels:
            if level.size != size:
                hashes, first = self._doubled(hashes, first, size)
                size = level.size
            self._compare(level, hashes, first)

    def _doubled(self, hashes: np.ndarray, first: int, size: int) -> tuple[np.ndarray, int]:
        """Hashes of the new suffixes of twice the size."""
        tail = self.tails.get(size, np.zeros(0, np.uint64))
        all_of = np.concatenate([tail, hashes])
        self.tails[size] = all_of[max(0, len(all_of) - size):]
        made = all_of[:-size] * _LEFT + all_of[size:] * _RIGHT if len(all_of) > size else np.zeros(0, np.uint64)
        return made ^ (made >> np.uint64(29)), first - len(tail)

    def _compare(self, level: _Level, hashes: np.ndarray, first: int) -> None:
        """Compares the new suffixes with the catchers that wait for them, and follows up new chains of catches."""
        size, low = level.size, level.low
        level.blocks = np.concatenate([level.blocks, hashes[-first % size::size]])
        if not len(hashes):
            return
        n, back = len(hashes), level.caught.shape[1]
        block = (np.arange(first, first + n) - low) // size
        caught = np.zeros((level.slots, back + n), bool)
        caught[:, :back] = level.caught
        for slot in range(level.slots):
            waiting = np.flatnonzero(block >= slot)
            caught[slot, back + waiting] = hashes[waiting] == level.blocks[block[waiting] - slot]
        level.caught = caught[:, n:].copy()
        begins = ~caught[:, :n]
        for i in range(level.chain):
            begins &= caught[:, back - i * size:back - i * size + n]
        slot, at = np.nonzero(begins)
        if not len(at):
            return
        end = first + at + size
        start = (block[at] - slot) * size
        period = end - size - start
        start -= (level.chain - 1) * size
        known = np.array([[0, 0, 1], *self.found])[self.cover[start]]
        fresh = (period <= self.longest) & ~((known[:, 0] <= start) & (end <= known[:, 1]) & (period % known[:, 2] == 0))
        for a, b, q in zip(start[fresh].tolist(), end[fresh].tolist(), period[fresh].tolist()):
            run = [self._left(a, q), self._right(b - q, q) + q, q]
            self.found.append(run)
            self.cover[run[0]:run[1]] = len(self.found)
            if run[1] == len(self.words):
                self.open.append(len(self.found) - 1)

    def _left(self, i: int, period: int) -> int:
        """The first place from which on, up to i, words equal those a period later."""
        step = 64
        while i > 0:
            low = max(0, i - step)
            other = np.flatnonzero(self.words[low:i] != self.words[low + period:i + period])
            if len(other):
                return low + int(other[-1]) + 1
            i, step = low, 2 * step
        return 0

    def _right(self, i: int, period: int) -> int:
        """The first place from i on whose word differs from the one a period later, or has none."""
        step, last = 64, len(self.words) - period
        while i < last:
            high = min(last, i + step)
            other = np.flatnonzero(self.words[i:high] != self.words[i + period:high + period])
            if len(other):
                return i + int(other[0])
            i, step = high, 2 * step
        return last

    def runs(self) -> np.ndarray:
        """(start, length, period) by start and period; of equal stretches the smallest period."""
        made = np.array(self.found, np.int64).reshape(-1, 3)
        made = made[np.lexsort((made[:, 2], made[:, 1], made[:, 0]))]
        first = np.ones(len(made), bool)
        first[1:] = (made[1:, :2] != made[:-1, :2]).any(axis=1)
        made = made[first]
        made[:, 1] -= made[:, 0]
        made = made[made[:, 1] >= np.maximum(self.least, self.times * made[:, 2])]
        return made[np.lexsort((made[:, 2], made[:, 0]))]


def exact_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, letters' case counting, and the n + 1 places where each text's begin."""
    data, at = buffers(column)
    start, size, total = runs(data, at, table=_EXACT_BYTE)
    return mix(total + size.astype(np.uint64) * _STEP[0]), np.searchsorted(start, at)


def runs_of(words: np.ndarray, at: np.ndarray, times: int = TIMES, least: int = LEAST) -> dict[int, np.ndarray]:
    """Runs of each text that has any. Texts of like length go through the same catchers, parted by words that occur once."""
    count, found = np.diff(at), {}
    classes = np.frexp(count.astype(float))[1]
    for kind in np.unique(classes[count >= least]).tolist():
        rows = np.flatnonzero((classes == kind) & (count >= least))
        first = np.concatenate([[0], np.cumsum(count[rows] + 1)])
        column = mix(np.arange(first[-1]).astype(np.uint64) ^ _EDGE)
        inside = np.ones(first[-1], bool)
        inside[first[1:] - 1] = False
        column[inside] = words[np.repeat(at[rows] - (first[:-1] - np.arange(len(rows))), count[rows]) + np.arange(count[rows].sum())]
        catchers = Catchers(int(count[rows].max()) // times, times, least)
        catchers.append(column)
        made = catchers.runs()
        owner = np.searchsorted(first, made[:, 0], "right") - 1
        made[:, 0] -= first[owner]
        for row in np.unique(owner).tolist():
            found[int(rows[row])] = made[owner == row]
    return found


def find_runs(docs: DataFrame, text: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """Adds ``n_words``, ``runs`` (word number, length in words, period; by start, then period) and ``collapsed``: the words that no run
    repeats, joined by one space.

    A run is as long as it can be and has at least ``least`` words and ``times`` periods; its first period stays, and a word that
    any run repeats goes. Words are what other characters than space and 0x09-0x0D make up. Null, empty and wordless texts have no
    words, no runs and an empty ``collapsed``. Whole texts are read, each row for itself; other columns pass, those named like an
    added one are replaced. An empty table stays empty.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(text)):
                part = batch.slice(low, high - low)
                words, at = exact_words(part.column(text))
                found = runs_of(words, at, times, least)
                lists, kept = [], []
                for row, value in enumerate(part.column(text).to_pylist()):
                    own = (value or "").encode().split()
                    if row in found:
                        again = np.zeros(len(own) + 1, np.int64)
                        for start, length, period in found[row].tolist():
                            again[start + period] += 1
                            again[start + length] -= 1
                        own = [w for w, n in zip(own, np.cumsum(again).tolist()) if not n]
                    lists.append([dict(zip(("start", "length", "period"), r)) for r in found[row].tolist()] if row in found else [])
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(at), pa.int64()), pa.array(lists, kind), pa.array(kept, pa.string())],
                    names=[*part.schema.names, "n_words", "runs", "collapsed"],
                )

    added = StructType.fromDDL(f"n_words bigint, runs {RUNS}, collapsed string").fields
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))


def plant_repeats(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """(ids, text) where a tenth of the documents, told by a checksum of the id, repeat some of their words to the end.

    With h = crc32(id as text), g = h div 10 and n words: if 10 divides h, each word i from a = g mod n on becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). The words are then joined by one space; all other texts stay, as do those
    of a null id.
    """
    code = F.crc32(F.col(ids).cast("string").cast("binary"))
    words = docs.select(
        F.col(ids), F.col(text).alias("text"), code.alias("h"), F.expr("crc32(cast(cast(`%s` AS string) AS binary)) div 10" % ids).alias("g"),
        F.when(code % 10 == 0, F.regexp_extract_all(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).alias("w"),
    ).withColumn("n", F.size("w"))
    placed = words.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = "array_join(transform(sequence(0, n - 1), i -> element_at(w, cast(if(i < a, i, a + (i - a) % p) AS int) + 1)), ' ')"
    return placed.select(F.col(ids), F.when(F.col("n") > 0, F.expr(repeated)).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame, ids: str = "doc_id") -> DataFrame:
    """Counts, the longest run (ties: smallest start, then period) and digests of all runs and of what is left."""
    longest = F.array_min(F.expr("transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("top", longest).select(
        F.col(ids), F.size("runs").cast("bigint").alias("n_runs"), F.col("top.start").alias("start"),
        (-F.col("top.less")).alias("length"), F.col("top.period").alias("period"),
        F.expr("(-1000 * top.less) div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
