"""Exact n-gram Jaccard join by token-combination prefixes.

A document's set holds the 64-bit hashes of its distinct shingles. Two sets link when
``100 * |x & y| >= percent * |x | y|``.

1. *Frequencies.* Tokens are counted over all documents. They travel packed, 8 bytes each,
   to tasks that own a range of the hash space. Bloom filters come back: tokens of at
   least two documents, frequent ones (more than ``rare`` documents, or as many as the
   filter holds), and ever more frequent ones. The size of each is bounded (``FILTER_BYTES``), whatever the input; a full
   filter lets more tokens pass, which costs time and never a link.
2. *Who can link.* A partner shares at least percent of x's tokens, so x needs that many
   tokens that two documents have. Only such sets go on, once per distinct set.
3. *Prefixes.* x may miss t = |x| - ceil(percent * |x| / 100) tokens of a partner. Tokens
   stand in one order for all: by the number of filters that have them, then by hash, so that the most frequent come last. Rare tokens are one
   class with combinations of one token; frequent tokens are dealt by hash to classes with
   combinations of k tokens. The prefix is extended until the sum over classes of
   max(0, tokens - k + 1) is t + 1: whatever t tokens a partner lacks, one combination
   is left that both have. The number of classes grows with the size of the sets (sets that
   can link lie in the same or neighbouring size bands, and each set is indexed for its own
   band and the next), so that a document has about as many combinations as tokens.
4. *Meet.* t above is for the smallest partner: x may miss |x| - percent * (|x| + |y|) / (100 + percent) tokens of a partner of |y|, 1/7 of
   |x| for one as large as x. So a combination carries its *reach*, |x| + 1 less the sum at which it is complete: the most tokens that x has in common with a
   partner whose first common combination it is. Two sets are a candidate pair only where both reach far enough for their sizes. In their
   first common combination linked sets do; members that reach nobody of their group leave it.
5. *Verify.* Of combinations with the same members the one that reaches farthest is kept. First every set is checked against one leader of its groups. Then each such group checks its
   members against one of them, then against GROWTH more, and so on; members found connected
   need no more checks, so a group of many near copies costs a few lines of checks and not all
   pairs. After two such rounds the members outside a group's largest component are compared with all others, in blocks
   that are spread over the cluster; only groups with more than MOST_APART such members are indexed anew with
   k + 1 tokens, and go through rounds until they have no more. Before whole sets are fetched, a pair's parity sketches are compared where it meets: bits in which they differ
   are tokens that only one set has, so that a pair with too many of these cannot link and goes no further. Every check after that
   compares whole sets. The rounds end only when no group has
   members left that are neither connected nor compared.

Every pair of linked sets is either checked or already connected, so components are exact. ``every_link`` skips no pair:
it checks whatever shares a combination of MOST_TOKENS tokens, however connected, and yields the links themselves.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labmeter.llm.components import relabel
from labmeter.llm.scratch import keep
from labmeter.llm.shingles import distinct_sets, lean, mix, slices

FILTER_BYTES = 32 << 20
RARE = 16
TOKENS_A_TASK = 1_000_000
SMALL_GROUP = 48
MOST_APART = 4096
BLOCK = 512
MOST_TOKENS = 3
GROWTH = 32
KEYS_A_BATCH = 100_000
LEVEL_POWER = 2
FIRST_ROUNDS = 1
SKETCH_WORDS = 16

_SALT = np.uint64(0xA0761D6478BD642F)
_PAIR = np.uint64(0xE7037ED1A0B428DB)
_PARITY = np.uint64(0x8EBC6AF09C88C6E3)


def needed(size: int, percent: int) -> int:
    """Fewest tokens that a partner of a set of this size shares with it."""
    return -(-percent * size // 100)


def common(size: int, other: int, percent: int) -> int:
    """Fewest tokens that linked sets of these sizes have in common."""
    return -(-percent * (size + other) // (100 + percent))


def band(size: int, percent: int) -> int:
    """Sets that can link lie in the same or in neighbouring bands."""
    low, index = 1, 0
    while (upper := bounds(index, percent)[1]) < size:
        low, index = upper, index + 1
    return index


def bounds(index: int, percent: int) -> tuple[int, int]:
    """Smallest and largest set size of a band: a band ends where the first set's partners end."""
    low = 1
    for _ in range(index):
        low = 100 * low // percent + 1
    return low, 100 * low // percent


class Filter:
    """A Bloom filter in segments, one for each range of the hash space."""

    def __init__(self, segments: list[bytes]):
        self.parts = len(segments)
        self.bits = 8 * len(segments[0]) if segments else 0
        self.data = np.frombuffer(b"".join(segments), np.uint8)

    @staticmethod
    def places(tokens: np.ndarray, bits: int) -> list[np.ndarray]:
        mixed = mix(tokens ^ _SALT)
        low, high = mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32)
        return [((low + np.uint64(i) * high) % np.uint64(bits)).astype(np.int64) for i in range(4)]

    @staticmethod
    def segment(tokens: np.ndarray, bits: int) -> bytes:
        on = np.zeros(bits, bool)
        for place in Filter.places(tokens, bits):
            on[place] = True
        return np.packbits(on).tobytes()

    def has(self, tokens: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(tokens), bool)
        first = part_of(tokens, self.parts) * self.bits
        found = np.ones(len(tokens), bool)
        for place in Filter.places(tokens, self.bits):
            at = first + place
            found &= (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return found


def part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _packed(parts: int, text: str):
    """(part, tokens, again, more) rows: the tokens of a batch's distinct sets, each once; how often more those occur that several
    sets have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            chunks, seen = [], set()
            for low, high in slices(column):
                tokens, at = distinct_sets(column[low:high])
                for a, b in zip(at[:-1], at[1:]):
                    ref = fingerprint(tokens[a:b])
                    if ref not in seen:
                        seen.add(ref)
                        chunks.append(tokens[a:b])
            if not chunks:
                continue
            tokens, counts = np.unique(np.concatenate(chunks), return_counts=True)
            again, more = tokens[counts > 1], (counts[counts > 1] - 1).astype(np.int32)
            edges, edges_again = (np.searchsorted(part_of(x, parts), np.arange(parts + 1)) for x in (tokens, again))
            rows = [i for i in range(parts) if edges[i] < edges[i + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int32()),
                *[
                    pa.array([x[e[i]:e[i + 1]].tobytes() for i in rows], pa.binary())
                    for x, e in ((tokens, edges), (again, edges_again), (more, edges_again))
                ],
            ], names=["part", "tokens", "again", "more"])

    return run


def fingerprint(tokens: np.ndarray) -> int:
    """Names a set, as a signed 64-bit number that does not depend on the order."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ _PAIR).sum(dtype=np.uint64) + np.uint64(len(tokens)) * _SALT
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that occur in two documents or more, with their counts, by part."""
    held: dict[int, list[list[np.ndarray]]] = {}
    for batch in batches:
        for part, *found in zip(batch["part"].to_pylist(), batch["tokens"], batch["again"], batch["more"]):
            kept = held.setdefault(part, [[], [], []])
            for chunks, data, kind in zip(kept, found, (np.uint64, np.uint64, np.int32)):
                chunks.append(np.frombuffer(data.as_buffer(), kind))
    while held:
        part, (once, again, more) = held.popitem()
        tokens = np.sort(np.concatenate(once))
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        counts = np.diff(np.append(first, len(tokens)))
        tokens = tokens[first]
        np.add.at(counts, np.searchsorted(tokens, np.concatenate(again)), np.concatenate(more))
        shared = counts > 1
        tokens, counts = tokens[shared], np.minimum(counts[shared], 2**31 - 1)
        tail = np.bincount(np.minimum(63, np.log2(counts).astype(np.int64)), minlength=64)
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([tokens.tobytes()], pa.binary()),
            pa.array([counts.astype(np.int32).tobytes()], pa.binary()), pa.array([tail.tolist()], pa.list_(pa.int64())),
        ], names=["part", "tokens", "counts", "tail"])


class Levels:
    """How frequent a token is: the number of filters, each of more frequent tokens than the one before, that have it."""

    def __init__(self, filters: list[Filter]):
        self.filters = filters

    def of(self, tokens: np.ndarray) -> np.ndarray:
        level = np.zeros(len(tokens), np.int64)
        left = np.arange(len(tokens))
        for each in self.filters:
            left = left[each.has(tokens[left])]
            level[left] += 1
        return level


def _segments(wanted: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, tokens, counts in zip(batch["part"], batch["tokens"], batch["counts"]):
                tokens, counts = np.frombuffer(tokens.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int32)
                made = [Filter.segment(tokens[counts > above], bits) for above, bits in wanted]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.as_py()] * len(wanted), pa.int32()), pa.array(range(len(wanted)), pa.int32()), pa.array(made, pa.binary()),
                ], names=["part", "number", "bits"])

    return run


def _filters(counted: DataFrame, parts: int, wanted: list[tuple[int, int]]) -> list[Filter]:
    """One filter for each (count to exceed, members). At most FILTER_BYTES of each reach the driver."""
    sized = [
        (above, min(8 * FILTER_BYTES // parts, 16 * members // parts + 1024) // 64 * 64 or 64) for above, members in wanted
    ]
    made = counted.select("part", "tokens", "counts").mapInArrow(lean(_segments(sized)), "part int, number int, bits binary")
    segments = [[bytes(bits // 8)] * parts for _, bits in sized]
    for row in made.toLocalIterator():
        segments[row["number"]][row["part"]] = bytes(row["bits"])
    return [Filter(each) for each in segments]


def frequency_filters(docs: DataFrame, text: str, rare: int) -> tuple[Filter, Levels]:
    """A filter of the tokens that two documents have, and levels of the frequent ones, each of 2**LEVEL_POWER times the count before."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, math.ceil(size / 6 / TOKENS_A_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = docs.select(text).mapInArrow(lean(_packed(parts, text)), "part int, tokens binary, again binary, more binary")
    counted = keep(
        packed.repartition(parts, "part").mapInArrow(
            lean(_counted), "part int, tokens binary, counts binary, tail array<bigint>"
        ), "token-counts",
    )
    tail = [0] * 64
    sums = counted.select(F.posexplode("tail").alias("power", "n")).groupBy("power").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # 64 rows at most
        tail[row["power"]] = row["n"]
    shared, power = sum(tail), max(1, int(math.log2(rare)))
    while sum(tail[power:]) > FILTER_BYTES // 4:
        power += 1
    powers = [p for p in range(power, 31, LEVEL_POWER) if p == power or sum(tail[p:])]
    two, *many = _filters(counted, parts, [(1, shared), *[(2**p, sum(tail[p:])) for p in powers]])
    return two, Levels(many)


def _measured(ids: str, text: str, percent: int, shared):
    """Each document's set size and name; the tokens of a set that can link, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, known = batch.column(text), set()
            for low, high in slices(column):
                tokens, at = distinct_sets(column[low:high])
                again = np.concatenate([[0], np.cumsum(shared.value.has(tokens))])
                refs, kept = [], []
                for a, b in zip(at[:-1], at[1:]):
                    ref = fingerprint(tokens[a:b]) if b > a else None
                    can = b > a and again[b] - again[a] >= needed(int(b - a), percent) and ref not in known
                    if can:
                        known.add(ref)
                    refs.append(ref)
                    kept.append(tokens[a:b].tobytes() if can else None)
                yield pa.RecordBatch.from_arrays([
                    batch.column(ids)[low:high], pa.array(np.diff(at), pa.int64()),
                    pa.array(refs, pa.int64()), pa.array(kept, pa.binary()),
                ], names=[ids, "n_shingles", "ref", "tokens"])

    return run


def signatures(tokens: np.ndarray, level: np.ndarray, shared: np.ndarray, percent: int, k: int) -> np.ndarray:
    """All combinations that a set is indexed by, for its own size band and the next."""
    return np.unique(reaching(tokens, level, shared, percent, k)[0])


def reaching(
    tokens: np.ndarray, level: np.ndarray, shared: np.ndarray, percent: int, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The combinations of a set, the reach of each, and whether it is for the set's own size band.

    Sets of one band meet where it is their own; in the next band's combinations a set looks for sets of that band only.
    """
    size, own = len(tokens), band(len(tokens), percent)
    order = np.lexsort((tokens, level))
    tokens, shared = tokens[order], shared[order]
    lights = int((level == 0).sum())
    keys, reach, ours = [], [], []
    for scheme in (own, own + 1):
        smallest = max(bounds(own + 1, percent)[0] if scheme > own else bounds(max(0, own - 1), percent)[0], needed(size, percent))
        spare = size - common(size, smallest, percent)
        if spare < 0:
            continue
        stamp = mix(np.array([scheme * 64 + k], np.uint64))[0]
        single = np.flatnonzero(shared[:min(lights, spare + 1)])
        found, weight = [mix(tokens[single] ^ stamp)], [single + 1]
        if lights <= spare:
            least = needed(bounds(max(0, scheme - 1), percent)[0], percent)
            width = min(k, least)  # sets of a few tokens have no larger combination in common
            classes = max(1, (least - 1) // (3 * (width - 1))) if width > 1 else 1
            heavy = tokens[lights:]
            dealt = (mix(heavy ^ _PAIR) % np.uint64(classes)).astype(np.int64)
            order = np.argsort(dealt, kind="stable")
            first, length = _runs_of(dealt[order])
            place = np.empty(len(heavy), np.int64)
            place[order] = np.arange(len(heavy)) - np.repeat(first, length)
            summed = lights + np.cumsum(place + 1 >= width)
            used = order[order <= np.searchsorted(summed, spare, "right")]
            made, last = combinations(heavy[used], dealt[used], width)
            found.append(mix(made ^ ~stamp))
            weight.append(summed[used[last]])
        weights = np.concatenate(weight)
        keys.append(np.concatenate(found))
        reach.append(size + 1 - weights)
        ours.append(np.full(len(weights), scheme == own))
    return np.concatenate(keys), np.concatenate(reach), np.concatenate(ours)


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return first, np.diff(np.append(first, len(values)))


def combinations(tokens: np.ndarray, classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each combination of k tokens of one class, and the place of its last token; tokens of a class stand together."""
    first, length = _runs_of(classes)
    end = np.repeat(first + length, length)
    sums, last = mix(tokens), np.arange(len(tokens))
    hashed = sums
    for _ in range(k - 1):
        count = end[last] - 1 - last
        last = np.repeat(last, count) + 1 + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        with np.errstate(over="ignore"):
            sums = np.repeat(sums, count) + hashed[last]
    return mix(sums), last


INDEX = "sig bigint, ref bigint, size bigint, reach int, own boolean"
MEMBER = ["ref", "size", "reach", "own"]


def _indexed(percent: int, k: int, shared, frequent):
    def packed(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], refs: list[int], sizes: list[int]) -> pa.RecordBatch:
        lengths = [len(keys) for keys, _, _ in rows]
        keys, reach, own = (np.concatenate(x) for x in zip(*rows))
        return pa.RecordBatch.from_arrays([
            pa.array(keys.view(np.int64)), pa.array(np.repeat(np.array(refs, np.int64), lengths)),
            pa.array(np.repeat(np.array(sizes, np.int64), lengths)), pa.array(reach.astype(np.int32)), pa.array(own),
        ], names=["sig", *MEMBER])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, refs, sizes, held = [], [], [], 0
            for ref, tokens in zip(batch["ref"].to_pylist(), batch["tokens"]):
                tokens = np.frombuffer(tokens.as_buffer(), np.uint64)
                rows.append(reaching(tokens, frequent.value.of(tokens), shared.value.has(tokens), percent, k))
                refs.append(ref)
                sizes.append(len(tokens))
                held += len(rows[-1][0])
                if held > KEYS_A_BATCH:
                    yield packed(rows, refs, sizes)
                    rows, refs, sizes, held = [], [], [], 0
            if rows:
                yield packed(rows, refs, sizes)

    return run


def sketch(tokens: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS * 64 bits, each the parity of the number of tokens that fall on it."""
    bits = 64 * SKETCH_WORDS
    odd = np.bincount((mix(tokens ^ _PARITY) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [sketch(np.frombuffer(tokens.as_buffer(), np.uint64)).tolist() for tokens in batch["tokens"]]
        yield pa.RecordBatch.from_arrays([batch["ref"], pa.array(made, pa.list_(pa.int64()))], names=["ref", "sketch"])


def _outlines(sets: DataFrame) -> DataFrame:
    """(ref, sketch) of each set."""
    return keep(sets.select("ref", "tokens").mapInArrow(lean(_outlined), "ref bigint, sketch array<bigint>"), "outlines")


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _able_sets(docs: DataFrame, ids: str, text: str, percent: int, rare: int):
    """Each document's set, the distinct sets that can link, and the two filters."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col(ids).alias(ids), F.col(text).alias(text))
    two, many = frequency_filters(docs, text, rare)
    shared, frequent = context.broadcast(two), context.broadcast(many)
    kind = docs.schema[ids].dataType.simpleString()
    measured = keep(
        docs.mapInArrow(
            lean(_measured(ids, text, percent, shared)), f"`{ids}` {kind}, n_shingles bigint, ref bigint, tokens binary"
        ), "sets",
    )
    sets = keep(
        measured.filter("tokens is not null").groupBy("ref").agg(F.first("tokens").alias("tokens")), "able-sets"
    )
    return measured, sets, shared, frequent


def linked_sets(docs: DataFrame, ids: str = "doc_id", text: str = "text", percent: int = 75, rare: int = RARE) -> tuple[DataFrame, DataFrame]:
    """Each document's (ids, n_shingles, ref), and (ref, label) of the sets that are linked.

    ``ref`` names a distinct set (null: no words), ``label`` a component of linked sets.
    """
    measured, sets, shared, frequent = _able_sets(docs, ids, text, percent, rare)
    labels = keep(sets.select("ref", F.col("ref").alias("label")), "labels")
    outlines = _outlines(sets)
    left = sets
    for k in range(2, MOST_TOKENS + 1):
        groups = _groups(keep(left.mapInArrow(lean(_indexed(percent, k, shared, frequent)), INDEX), "index"), percent, outlines)
        for salt in range(FIRST_ROUNDS):
            labels = _verified(_one_partner_each(groups, labels, percent, salt), sets, labels, percent)
        last, wide = k == MOST_TOKENS, None
        for step in itertools.count():
            groups, pairs = _some_against_the_rest(groups, labels, percent, step)
            if pairs is None:
                break
            labels = _verified(pairs, sets, labels, percent)
            if step:
                opened = _open(groups, labels)
                wide = opened.filter(F.col("apart") > MOST_APART)
                if not last or wide.isEmpty():
                    labels = _verified(_pairs_apart(groups, opened, labels, percent), sets, labels, percent)
                    break
        if last or wide is None or wide.isEmpty():
            break
        left = sets.join(keep(groups.join(wide, "sig").select("ref").distinct(), "still-open"), "ref")
    return measured.select(ids, "n_shingles", "ref"), labels


def _groups(found: DataFrame, percent: int, outlines: DataFrame | None = None) -> DataFrame:
    """The groups that sets meet in, without those members that reach none of the others' sizes, twice over: the smallest may leave.
    With ``outlines``, every member that stays has its sketch."""
    for _ in range(2):
        smallest = F.greatest("least", F.ceil(F.col("size") * percent / 100))
        reaches = percent * (F.col("size") + smallest) <= (100 + percent) * F.col("reach")
        found = keep(found.join(_one_of_equal_groups(found), "sig").filter(reaches).select("sig", *MEMBER), "groups")
    return found if outlines is None else keep(found.join(outlines, "ref").select("sig", *MEMBER, "sketch"), "outlined")


def _one_of_equal_groups(found: DataFrame) -> DataFrame:
    """(sig, least): one combination for each group of two members or more, with the size of the smallest member. Near copies share hundreds
    with the same members; these are of one size band, and the first in the order of tokens reaches farthest for every member.

    Groups count as equal when number and mixed hashes (64 bits) of their members are.
    """
    groups = found.groupBy("sig").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("ref")).alias("members"), F.bool_or("own").alias("own"),
        F.sum("reach").alias("reach"), F.min("size").alias("least"),
    )
    chosen = groups.filter("n > 1 AND own").groupBy("n", "members").agg(F.max(F.struct("reach", "sig", "least")).alias("best"))
    return chosen.select("best.sig", "best.least")


def _open(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, most, apart, rest): groups whose members belong to several components, with the largest of these, how many members are
    apart from it, and how many are in it."""
    each = groups.join(labels, "ref").groupBy("sig", "label").agg(F.count("*").alias("n"))
    whole = each.groupBy("sig").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
    return keep(whole.filter("n > top.n").selectExpr("sig", "top.label AS most", "n - top.n AS apart", "top.n AS rest"), "open")


def _meet(percent: int):
    """Whether two members of a group, the second with names that begin with a_, can be linked sets in their first common combination."""
    far = percent * (F.col("size") + F.col("a_size")) <= (100 + percent) * F.least("reach", "a_reach")
    return far & (F.col("own") | F.col("a_own"))


def _can_link(percent: int):
    """False only for sets that cannot link: of their tokens, at least as many stand in one set alone as the sketches differ in bits."""
    apart = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("a_sketch")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return _meet(percent) & (apart * (100 + percent) <= (F.col("size") + F.col("a_size")) * (100 - percent))


def _other(columns: list[str]) -> list:
    """The columns of a pair's second member."""
    return [F.col(c).alias("a" if c == "ref" else f"a_{c}") for c in columns]


def _one_partner_each(groups: DataFrame, labels: DataFrame, percent: int, salt: int) -> DataFrame:
    """One pair for each set: with the first, by a hash, of the sets that lead a group of its. Most of a group of near copies choose the
    same few leaders, so that the rounds after this find it connected."""
    first = groups.groupBy("sig").agg(F.min(F.struct(F.xxhash64("ref", F.lit(salt)).alias("h"), *MEMBER)).alias("lead"))
    led = groups.join(first.select("sig", "lead.*").select("sig", "h", *_other(MEMBER)), "sig")
    chosen = led.filter(F.col("a") != F.col("ref")).filter(_meet(percent)).groupBy("ref").agg(F.min_by("a", F.struct("h", "a")).alias("to"))
    own, other = labels.withColumnRenamed("label", "own"), labels.select(F.col("ref").alias("to"), "label")
    return chosen.join(own, "ref").join(other, "to").filter("own <> label").select(
        F.least("ref", "to").alias("a"), F.greatest("ref", "to").alias("b")
    ).distinct()


def _some_against_the_rest(groups: DataFrame, labels: DataFrame, percent: int, step: int) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of GROWTH ** step members of each open group with those not connected to them; these then leave."""
    labelled = groups.join(labels, "ref")
    still = labelled.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("sig")
    groups = keep(labelled.join(still, "sig").select("sig", *MEMBER, "label", "sketch"), "open-groups")
    if groups.isEmpty():
        return groups.drop("label"), None
    order = Window.partitionBy("sig").orderBy(F.xxhash64("ref", F.lit(step)))
    leaders = keep(
        groups.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= GROWTH**step)
        .select("sig", *_other([*MEMBER, "label", "sketch"])), "leaders",
    )
    pairs = (
        groups.join(leaders, "sig").filter(F.col("label") != F.col("a_label")).filter(_can_link(percent))
        .select(F.least("a", "ref").alias("a"), F.greatest("a", "ref").alias("b")).distinct()
    )
    rest = groups.drop("label").join(leaders.select("sig", F.col("a").alias("ref")), ["sig", "ref"], "left_anti")
    return keep(rest, "groups"), pairs


def _pairs_apart(groups: DataFrame, opened: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components in groups with at most MOST_APART members apart from the largest component.

    Those apart are dealt to blocks of BLOCK members and meet all the others, which are dealt to blocks of MOST_APART.
    """
    opened = opened.filter(F.col("apart") <= MOST_APART).select(
        "sig", "most", F.ceil(F.col("apart") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("apart") + F.col("rest")) / MOST_APART).cast("int").alias("others"),
    )
    rows = groups.join(labels, "ref").join(opened, "sig")

    def dealt(into: str, salt: str):
        return F.pmod(F.xxhash64("ref", F.lit(salt)), F.col(into)).cast("int")

    def every(into: str):
        return F.explode(F.sequence(F.lit(0), F.col(into) - 1))

    names = ["label", "sketch"]
    left = rows.filter("label <> most").withColumn("block", dealt("blocks", "block")).withColumn("other", every("others"))
    right = rows.withColumn("other", dealt("others", "other")).withColumn("block", every("blocks"))
    met = left.select("sig", "block", "other", *_other([*MEMBER, *names])).join(
        right.select("sig", "block", "other", *MEMBER, *names, (F.col("label") == F.col("most")).alias("far")), ["sig", "block", "other"]
    )
    return (
        met.filter((F.col("label") != F.col("a_label")) & (F.col("far") | (F.col("a") < F.col("ref")))).filter(_can_link(percent))
        .select(F.least("a", "ref").alias("a"), F.greatest("a", "ref").alias("b")).distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Labels after the pairs whose whole sets are similar enough have been joined."""
    links = _links(pairs, sets, percent)
    return labels if links.isEmpty() else relabel(labels, links)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    The pairs are written first: Spark then knows their size before it plans, and where they are few it reads the
    sets in place and moves only those that a pair names.
    """
    pairs = keep(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    first = sets.select(F.col("ref").alias("a"), F.col("tokens").alias("x"))
    second = sets.select(F.col("ref").alias("b"), F.col("tokens").alias("y")).join(pairs.select("b"), "b", "left_semi")
    return keep(
        pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(lean(_overlaps(percent)), "a bigint, b bigint"),
        "links",
    )


def _all_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of members of a group. Members are dealt to blocks, so that a large group spreads over many keys."""
    counts = groups.groupBy("sig").agg(F.ceil(F.count("*") / SMALL_GROUP).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("ref", F.lit("block")), F.col("blocks")).cast("int")
    rows = groups.join(counts, "sig").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("sig", *MEMBER, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    left = rows.filter("block = low").select("sig", "low", "high", *_other(MEMBER))
    met = left.join(rows.filter("block = high"), ["sig", "low", "high"]).filter((F.col("low") < F.col("high")) | (F.col("a") < F.col("ref")))
    return (
        met.filter(_meet(percent))
        .select(F.least("a", "ref").alias("a"), F.greatest("a", "ref").alias("b")).distinct()
    )


def every_link(docs: DataFrame, ids: str = "doc_id", text: str = "text", percent: int = 75, rare: int = RARE) -> tuple[DataFrame, DataFrame]:
    """Each document's (ids, n_shingles, ref), and every link (a, b), a < b, between distinct sets.

    Rows with equal sets (one ``ref``) are linked too and not listed. In a group of near copies the links
    themselves grow with the square of its distinct sets; nothing is left out.
    """
    measured, sets, shared, frequent = _able_sets(docs, ids, text, percent, rare)
    groups = _groups(keep(sets.mapInArrow(lean(_indexed(percent, MOST_TOKENS, shared, frequent)), INDEX), "index"), percent)
    return measured.select(ids, "n_shingles", "ref"), _links(_all_pairs(groups, percent), sets, percent)


def count_links(docs: DataFrame, ids: str = "doc_id", text: str = "text", percent: int = 75, rare: int = RARE) -> DataFrame:
    """(ids, n_shingles, n_links) for each row: how many other rows it is linked with, those with its own set included.

    Null and wordless texts have no links. An empty table gives no rows.
    """
    members, links = every_link(docs, ids, text, percent, rare)
    copies = keep(members.filter("ref is not null").groupBy("ref").agg(F.count("*").alias("n")), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies.withColumnRenamed("ref", "b"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    degrees = copies.join(others.withColumnRenamed("a", "ref"), "ref", "left").select(
        "ref", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    with_words = members.filter("ref is not null").join(degrees, "ref").select(ids, "n_shingles", "n_links")
    without = members.filter("ref is null").select(ids, "n_shingles", F.lit(0).cast("bigint").alias("n_links"))
    return with_words.unionByName(without)


def near_duplicates(docs: DataFrame, ids: str = "doc_id", text: str = "text", percent: int = 75, rare: int = RARE) -> DataFrame:
    """(ids, n_shingles, component_id) for each row: the smallest id that links reach.

    Null and wordless texts have size 0 and link with nothing: their component is their own
    id. Rows with equal sets are linked, repeated rows stay. A null id takes the component of
    its set. An empty table gives no rows; other columns are not read.
    """
    measured, labels = linked_sets(docs, ids, text, percent, rare)
    refs = measured.filter("ref is not null").groupBy("ref").agg(F.min(ids).alias("least"))
    placed = keep(refs.join(labels, "ref", "left").select("ref", "least", F.coalesce("label", "ref").alias("label")), "placed")
    smallest = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    by_ref = placed.join(smallest, "label").select("ref", "component_id")
    with_words = measured.filter("ref is not null").join(by_ref, "ref").select(ids, "n_shingles", "component_id")
    without = measured.filter("ref is null").select(ids, "n_shingles", F.col(ids).alias("component_id"))
    return with_words.unionByName(without)
