"""Shards of near-equal bytes by a minimax contiguous partition, in DataFrame functions.

Rows with equal texts form an atomic group. Groups stand in the order of a 64-bit hash of their text, so that
a shard is a range of hashes and a row finds its shard without a join. The smallest feasible
capacity is found by binary search, checked greedily. The driver never sees groups: it holds sums of ranges of
hashes, 2 ** 16 at first. Each round opens at most MOST_OPEN of the ranges where a cut can still fall, the
largest first, into 2 ** 8 finer ones, until those hold single groups; the last search is exact.

The capacity bounds the largest shard only. Groups larger than an even share then get shards of their own, the parts
between them share out the other shards by the same search, and inside a part each cut falls as near to an even share of
what is left as the part's capacity allows. Ranges beside these cuts are opened likewise. Of several ways to set large groups
apart the one with the largest smallest shard counts.

Texts with the same hash stay together (for different texts: probability 2 ** -64 a pair).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labmeter.llm.scratch import keep

FIRST_BITS, NEXT_BITS = 16, 8
MOST_OPEN = 256
APART = (1, 2, 4, 8)
SLOTS = 1024
SIGN = -(1 << 63)

Segment = tuple[int, int, int]  # first hash (unsigned), log2 of the number of hashes (0: one group), sum of sizes


def shards_needed(sums: list[int], capacity: int, most: int) -> list[int] | None:
    """Indexes before which a greedy fill cuts; None if more than ``most`` shards are needed."""
    cuts, held = [], 0
    for i, size in enumerate(sums):
        if size > capacity:
            return None
        if held + size > capacity:
            cuts.append(i)
            held = 0
            if len(cuts) >= most:
                return None
        held += size
    return cuts


def smallest_capacity(sums: list[int], shards: int) -> int:
    """Binary search for the smallest capacity at which a greedy fill needs at most ``shards`` shards."""
    low, high = max([0, *sums, -(-sum(sums) // shards)]), sum(sums)
    while low < high:
        middle = (low + high) // 2
        if shards_needed(sums, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _capacity(ends: list[int], parts: list[tuple[int, int]], shards: int) -> int:
    """Smallest capacity at which greedy fills of the parts need at most ``shards`` shards. ``ends``: running sums from 0."""

    def fits(capacity: int) -> bool:
        left = shards
        for start, stop in parts:
            while start < stop:
                reached = bisect_right(ends, ends[start] + capacity, start, stop + 1) - 1
                if reached == start or not left:
                    return False
                start, left = reached, left - 1
        return True

    low, high = 0, max((ends[b] - ends[a] for a, b in parts), default=0)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def _even_cuts(ends: list[int], start: int, stop: int, shards: int) -> list[int]:
    """Cuts of a part into shards (or one for each group), each as near to an even share of the rest as capacity allows."""
    shards = min(shards, stop - start)
    capacity, least, cuts = _capacity(ends, [(start, stop)], shards), [stop], []
    for _ in range(shards - 1):  # where the last 1, 2, ... shards can begin at the earliest
        least.append(bisect_left(ends, ends[least[-1]] - capacity, start, stop + 1))
    for left in range(shards - 1, 0, -1):
        first = max(least[left], start + 1)
        last = min(bisect_right(ends, ends[start] + capacity, start, stop + 1) - 1, stop - left)
        wanted = ends[start] + (ends[stop] - ends[start]) / (left + 1)
        start = min(last, bisect_left(ends, wanted, first, last + 1))
        if start > first and wanted - ends[start - 1] < ends[start] - wanted:
            start -= 1
        cuts.append(start)
    return cuts


def _larger(sums: list[int], shards: int, times: int) -> list[int]:
    """Indexes of what exceeds ``times`` the even share, where the share is that of the others over the other shards."""
    order = sorted(range(len(sums)), key=lambda i: -sums[i])[:shards]
    rest, found = sum(sums), []
    for i in order:
        if len(found) + 1 >= shards or sums[i] * (shards - len(found)) <= times * rest:
            break
        rest -= sums[i]
        found.append(i)
    return sorted(found)


def balanced_cuts(sums: list[int], shards: int, capacity: int) -> list[int]:
    """Indexes before which shards begin, none above ``capacity`` (which can be met), the smallest as large as may be."""
    ends = [0, *accumulate(sums)]
    best: tuple[tuple[int, int], list[int]] | None = None
    for apart in {tuple(_larger(sums, shards, times)) for times in APART} | {()}:
        edges = [(a, b) for a, b in zip([0, *(i + 1 for i in apart)], [*apart, len(sums)]) if a < b]
        free = shards - len(apart)
        if len(edges) > free:
            continue
        share = _capacity(ends, edges, free)
        used = [_needed(ends, a, b, share) for a, b in edges]
        for _ in range(free - sum(used)):  # one more to the part with the fullest shards that can still be cut
            open_parts = [j for j, (a, b) in enumerate(edges) if used[j] < b - a]
            if open_parts:
                used[max(open_parts, key=lambda j: (ends[edges[j][1]] - ends[edges[j][0]]) / used[j])] += 1
        begins = {a for a, _ in edges} | set(apart)
        for (a, b), n in zip(edges, used):
            begins.update(_even_cuts(ends, a, b, n))
        cuts = sorted(begins - {0})
        loads = [ends[b] - ends[a] for a, b in zip([0, *cuts], [*cuts, len(sums)])]
        if max(loads) <= capacity and (best is None or (len(loads), min(loads)) > best[0]):
            best = (len(loads), min(loads)), cuts
    return best[1] if best else []


def _needed(ends: list[int], start: int, stop: int, capacity: int) -> int:
    count = 0
    while start < stop:
        start, count = bisect_right(ends, ends[start] + capacity, start, stop + 1) - 1, count + 1
    return count


def _summed(groups: DataFrame, bit: int, within: int = 0, prefixes: list[int] | None = None) -> list[Segment]:
    """Sums of ranges of 2 ** bit hashes, all or inside the given ranges of 2 ** within hashes."""
    rows = groups
    if prefixes is not None:
        rows = rows.filter(F.shiftrightunsigned(F.col("h"), within).isin(prefixes))
    sums = rows.groupBy(F.shiftrightunsigned(F.col("h"), bit).alias("p")).agg(
        F.sum("size").alias("size"), F.count("*").alias("n")
    )
    return sorted(((r["p"] % (1 << 64)) << bit, 0 if r["n"] == 1 else bit, r["size"]) for r in sums.toLocalIterator())


def _where_cuts_fall(sums: list[int], low: int, high: int, shards: int) -> set[int]:
    """Indexes of all ranges in which a greedy fill cuts at a capacity between low and high.

    With finer groups a fill reaches at least as far as with these ranges whole (at ``low``), and the
    j-th cut comes at ``j * high`` at the latest.
    """
    zones, start, reach, total = set(), 0, 0, 0
    for j in range(1, shards):
        held = 0
        while start < len(sums) and held + sums[start] <= low:
            held += sums[start]
            start += 1
        while reach < len(sums) and total + sums[reach] <= j * high:
            total += sums[reach]
            reach += 1
        zones.update(range(start, min(reach + 1, len(sums))))
    return zones


def cut_hashes(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Unsigned hashes at which shards 1, 2, ... begin, and the capacity. ``groups``: (h, size) rows.

    The best capacity with whole ranges is at most the largest open range above the best with groups. The
    search ends when every range that may hold a cut is a single group.
    """
    segments = _summed(groups, 64 - FIRST_BITS)
    while True:
        sums = [s[2] for s in segments]
        high = smallest_capacity(sums, shards)
        widest = max([0, *(size for _, bit, size in segments if bit)])
        low = max([0, -(-sum(sums) // shards), high - widest, *(size for _, bit, size in segments if not bit)])
        zones = _where_cuts_fall(sums, low, high, shards)
        wide = sorted((i for i in zones if segments[i][1]), key=lambda i: -segments[i][2])[:MOST_OPEN]
        if not wide or low >= high:
            break
        segments = _opened(groups, segments, wide)
    while True:
        sums = [s[2] for s in segments]
        cuts = balanced_cuts(sums, shards, high)
        beside = {j for i in cuts for j in (i - 1, i)} | set(_larger(sums, shards, 1))
        wide = sorted((i for i in beside if segments[i][1]), key=lambda i: -segments[i][2])[:MOST_OPEN]
        if not wide:
            return [segments[i][0] for i in cuts], high
        segments = _opened(groups, segments, wide)


def _opened(groups: DataFrame, segments: list[Segment], wide: list[int]) -> list[Segment]:
    """The segments with those of ``wide`` that are as wide as its first replaced by finer ones."""
    bit = segments[wide[0]][1]
    opened = {i for i in wide if segments[i][1] == bit}
    finer = _summed(groups, max(0, bit - NEXT_BITS), bit, [segments[i][0] >> bit for i in opened])
    return sorted([s for i, s in enumerate(segments) if i not in opened] + finer)


def assign_shards(docs: DataFrame, shards: int = 24, ids: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """(ids, size, text_crc32, shard, slot) for each row.

    Null text: no bytes, in one group with the empty text. Equal rows are rows of one group; slots of
    rows with equal ids stand in any order. A group larger than an even share fills a shard of its own; the rest is
    spread evenly over the others (``balanced_cuts``).
    An empty table gives no rows. Slots have no gap: rows are numbered inside SLOTS cells of each shard
    (by a hash of the id, so that a large group spreads) after the number of rows of the cells before.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = keep(
        docs.select(
            F.col(ids).alias("id"), (F.octet_length(whole).cast("long") + overhead).alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("h"),
        ), "sized",
    )
    groups = keep(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    cuts, _ = cut_hashes(groups, shards)
    place = F.col("h").bitwiseXOR(F.lit(SIGN))  # signed order of this is the unsigned order of h
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (place >= F.lit(cut + SIGN)).cast("int")
    rows = rows.withColumn("shard", shard).withColumn("cell", F.pmod(F.xxhash64("id", F.lit("slot")), F.lit(SLOTS)).cast("int"))
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "cell").orderBy("id", "h")
    placed = rows.withColumn("inside", F.row_number().over(inside) - 1).join(counts, ["shard", "cell"])
    return placed.select(
        F.col("id").alias(ids), "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"),
    )
