"""Alignment of two tokenizers' tokens: divide and conquer at the places where both end a token.

Both cut the same bytes. An interval of the first tokenizer's ends is cut at a common end near its middle: from the middle
on, bisecting the other's ends gives the next one there, bisecting the own ends the next one here, until both meet or the
interval ends. What lies left of the middle and right of the cut is done in the same way; what was passed over has no common end.
All intervals of a slice of texts, whatever their text, take each step together as columns. What lies between two
neighbouring cuts is a group (a leaf), and tokens whose bytes overlap are linked.

``count_links`` tells for each pair of ids how many documents of the corpus hold it linked. Documents come in blocks; a block sends
each of its pairs once, with the number of its documents that hold it, and gets the corpus' number back, so that a pair which
every document holds moves once a block and its documents are not moved for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labmeter.llm import bytepairs
from labmeter.llm.bytepairs import joined
from labmeter.llm.scratch import keep
from labmeter.llm.shingles import slices

FIRST = bytepairs.MODEL
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_ROWS = 4096


class PieceModel:
    """A sentencepiece model that can be sent to executors, and the bytes of each id."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.proto = proto
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)

    def _bytes(self, i: int) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return self.model.id_to_piece(i).replace("▁", " ").encode()

    def __reduce__(self):
        return PieceModel, (self.proto,)


class Pair:
    """Both tokenizers; ``width`` is a number above all ids of the second, so that id pairs are ``a * width + b``."""

    def __init__(self, first: bytepairs.BytePairs, second: PieceModel):
        self.first, self.second, self.width = first, second, len(second.bytes_of)
        most = max(len(first.sizes), self.width)
        self.marked = [f"{i}{mark}" for mark in (",", "|", ";") for i in range(most)]
        self.most = most

    def __reduce__(self):
        return Pair, (self.first, self.second)


def read(first: str = FIRST, second: str = SECOND) -> Pair:
    """Reads both vocabularies on the driver (they are of fixed size)."""
    return Pair(bytepairs.read(first), PieceModel(Path(second).read_bytes()))


@dataclass
class Tokens:
    """Ids of all texts one after the other and their ends in the joined bytes; ``at``: the n + 1 places where each text's begin."""

    ids: np.ndarray
    ends: np.ndarray
    at: np.ndarray


def tokens(pair: Pair, texts: list[str | None]) -> tuple[Tokens, Tokens]:
    """Tokens of a space and each text. A text that is null, empty or not the same bytes in either has none."""
    wanted = [i for i, t in enumerate(texts) if t]
    second = pair.second.model.encode([texts[i] for i in wanted], num_threads=1) if wanted else []
    parts = [[np.zeros(0, np.int64)] * len(texts) for _ in range(2)]
    for i, b in zip(wanted, second):
        text = " " + texts[i]
        data = text.encode()
        a = pair.first.plain(text).astype(np.int64)
        if int(pair.first.sizes[a].sum()) == len(data) and b"".join(map(pair.second.bytes_of.__getitem__, b)) == data:
            parts[0][i], parts[1][i] = a, np.array(b, np.int64)
    made = []
    for sizes, found in zip((pair.first.sizes, pair.second.sizes), parts):
        ids = joined(found).astype(np.int64)
        at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        made.append(Tokens(ids, np.cumsum(sizes[ids]), at))
    return made[0], made[1]


def shared_cuts(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places in ``a`` of the ends that ``b`` has too, within the intervals [low, high), each of which ends at such a place."""
    found = [np.zeros(0, np.int64)]
    while len(low):
        place = (low + high) // 2
        middle, met, going = place.copy(), np.zeros(len(low), bool), np.arange(len(low))
        while len(going):
            own = a[place[going]]
            other = b[np.searchsorted(b, own)]
            same = own == other
            met[going[same]] = True
            going, other = going[~same], other[~same]
            place[going] = np.searchsorted(a, other)
            going = going[place[going] < high[going]]
        found.append(place[met])
        low, high = np.concatenate([low, place[met] + 1]), np.concatenate([middle, high[met]])
        left = low < high
        low, high = low[left], high[left]
    return np.sort(np.concatenate(found))


@dataclass
class Aligned:
    """Numbers of tokens of either side up to the end of each group, the n + 1 places where each text's groups begin, and links
    as places of tokens of either side, in order of their bytes, with theirs."""

    cut_a: np.ndarray
    cut_b: np.ndarray
    at: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    links_at: np.ndarray


def aligned(a: Tokens, b: Tokens) -> Aligned:
    """Two tokens overlap in one stretch of bytes, which ends where either ends: one link for each place where a token ends."""
    held = np.diff(a.at) > 0
    cuts = shared_cuts(a.ends, b.ends, a.at[:-1][held], a.at[1:][held])
    cut_b = np.searchsorted(b.ends, a.ends[cuts]) + 1
    size = int(a.ends[-1]) if len(a.ends) else 0
    either = np.zeros((2, size + 1), bool)
    either[0, a.ends], either[1, b.ends] = True, True
    ends = np.flatnonzero(either[0] | either[1])
    before = np.cumsum(either, axis=1, dtype=np.int64)[:, ends] - either[:, ends]
    return Aligned(cuts + 1, cut_b, np.searchsorted(cuts, a.at), before[0], before[1], np.searchsorted(before[0], a.at))


def group_texts(pair: Pair, a: Tokens, b: Tokens, found: Aligned) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text: ids of either side in order, group by group; empty without tokens."""
    last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    last_a[found.cut_a - 1], last_b[found.cut_b - 1] = True, True
    size_a, size_b = np.diff(found.cut_a, prepend=0), np.diff(found.cut_b, prepend=0)
    made = np.empty(len(a.ids) + len(b.ids), np.int64)
    made[np.arange(len(a.ids)) + np.repeat(found.cut_b - size_b, size_a)] = a.ids + last_a * pair.most
    made[np.arange(len(b.ids)) + np.repeat(found.cut_a, size_b)] = b.ids + last_b * (2 * pair.most)
    at = (a.at + b.at).tolist()
    return ["".join(map(pair.marked.__getitem__, made[x:y].tolist()))[:-1] for x, y in zip(at, at[1:])]


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, text: str = "text") -> DataFrame:
    """Adds ``a_ids``, ``b_ids`` and ``groups``: (a_end, b_end, byte_end), tokens and bytes up to each group's end.

    Both encode a space and the text, and strings of special tokens are plain text. Texts that are null, empty or not
    rendered byte for byte by both have empty lists. Each row for itself; other columns pass, those named like an added
    one are replaced. An empty table stays empty.
    """
    docs = docs.drop("a_ids", "b_ids", "groups")
    shared = docs.sparkSession.sparkContext.broadcast(read(first, second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(text)):
                part = batch.slice(low, high - low)
                a, b = tokens(shared.value, part.column(text).to_pylist())
                found = aligned(a, b)
                base = np.concatenate([[0], a.ends])[a.at]
                n = np.diff(found.at)
                groups = pa.StructArray.from_arrays([
                    pa.array((found.cut_a - np.repeat(a.at[:-1], n)).astype(np.int32)),
                    pa.array((found.cut_b - np.repeat(b.at[:-1], n)).astype(np.int32)),
                    pa.array(a.ends[found.cut_a - 1] - np.repeat(base[:-1], n)),
                ], names=["a_end", "b_end", "byte_end"])
                lists = [
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), values) for at, values in (
                        (a.at, pa.array(a.ids, pa.int32())), (b.at, pa.array(b.ids, pa.int32())), (found.at, groups),
                    )
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*part.schema.names, "a_ids", "b_ids", "groups"])

    added = "a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int,byte_end:bigint>>"
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(added).fields]))


DOC = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
COUNTS = "n_best bigint, count_sum bigint"
_BLOCK = "block bigint, keys array<bigint>, holders array<int>, held array<int>, places binary, times binary"


def _blocks(docs: DataFrame, shared, ids: str, most_rows: int) -> DataFrame:
    """One row for each block of documents: their rows, the block's distinct pairs with the number of its documents that hold each, and
    which pairs each document holds how often (gaps between places in the block's list, and times, one byte each where they fit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high in slices(batch.column("text"), rows=most_rows):
                part = batch.slice(low, high - low)
                a, b = tokens(pair, part.column("text").to_pylist())
                found = aligned(a, b)
                named = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(pair, a, b, found)]
                n_links = np.diff(found.links_at)
                key = a.ids[found.link_a] * pair.width + b.ids[found.link_b]
                row = np.repeat(np.arange(len(part)), n_links)
                each, times = np.unique(row << 40 | key, return_counts=True)  # ids are below 2**20 each
                keys, place, holders = np.unique(each & (1 << 40) - 1, return_inverse=True, return_counts=True)
                held = np.bincount(each >> 40, minlength=len(part))
                gaps = np.diff(place, prepend=0)
                starts = (np.cumsum(held) - held)[held > 0]
                gaps[starts] = place[starts]
                rows = pa.StructArray.from_arrays([
                    part.column("id"), *[pa.array(x, pa.int64()) for x in (np.diff(a.at), np.diff(b.at), np.diff(found.at), n_links)],
                    pa.array(named, pa.string()),
                ], names=[ids, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([keys.tolist()], pa.list_(pa.int64())),
                    pa.array([holders.tolist()], pa.list_(pa.int32())), pa.array([held.tolist()], pa.list_(pa.int32())),
                    pa.array([_packed(gaps)], pa.binary()), pa.array([_packed(times)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), rows),
                ], names=["block", "keys", "holders", "held", "places", "times", "docs"])
                number += 1

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"{_BLOCK}, docs array<struct<`{ids}`:{kind},{DOC.replace(' ', ':').replace(',:', ',')}>>")


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on: one byte each, 255 standing for a number that follows in eight bytes behind all."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def _unpacked(data: bytes, number: int) -> np.ndarray:
    if not number:
        return np.zeros(0, np.int64)
    values = np.frombuffer(data, np.uint8, number).astype(np.int64)
    if len(data) > number:
        values[values == 255] = np.frombuffer(data, "<i8", -1, number)
    return values


def count_links(docs: DataFrame, first: str = FIRST, second: str = SECOND, ids: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ids, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row.

    A pair's count is the number of rows whose text holds it linked; ``count_sum`` adds it up over a row's links, and ``n_best`` counts the
    links whose count is the highest that their first id has in the corpus (ties too). Texts without tokens (see ``align``) have
    zeros and an empty digest. Repeated rows and null ids are documents of their own; other columns are not read; an empty
    table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(read(first, second))
    width = shared.value.width
    blocks = keep(_blocks(docs.select(F.col(ids).alias("id"), F.col(text).alias("text")), shared, ids, block_rows), "blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("keys", "holders")).alias("place", "pair")).select(
        "block", "place", F.col("pair.keys").alias("key"), F.col("pair.holders").alias("holders")
    )
    counts = keep(pairs.groupBy("key").agg(F.sum("holders").alias("count")), "pair-counts")
    own = F.expr(f"key div {width}").alias("a")
    highest = counts.groupBy(own).agg(F.max("count").alias("highest"))  # one row for each of the first vocabulary's ids
    told = counts.withColumn("a", own).join(F.broadcast(highest), "a").select(
        "key", (F.col("count") * 2 + (F.col("count") == F.col("highest")).cast("bigint")).alias("told")
    )
    back = pairs.select("block", "place", "key").join(told, "key").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "told"))).alias("told")
    ).select("block", F.col("told.told").alias("told"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                held = row["held"].values.to_numpy()
                told = row["told"].values.to_numpy() if row["told"].is_valid else np.zeros(0, np.int64)
                number = int(held.sum())
                place, times = _unpacked(row["places"].as_py(), number), _unpacked(row["times"].as_py(), number)
                starts = np.cumsum(held) - held
                summed = np.cumsum(place)
                before = np.concatenate([[0], summed])[starts]
                each = told[summed - np.repeat(before, held)]
                sums = np.zeros((2, number + 1), np.int64)
                np.cumsum((each & 1) * times, out=sums[0, 1:])
                np.cumsum((each >> 1) * times, out=sums[1, 1:])
                of = sums[:, starts + held] - sums[:, starts]
                rows = row["docs"].values
                yield pa.RecordBatch.from_arrays(
                    [*rows.flatten(), pa.array(of[0]), pa.array(of[1])], names=names
                )

    kind = docs.schema[ids].dataType.simpleString()
    schema = StructType.fromDDL(f"`{ids}` {kind}, {DOC}, {COUNTS}")
    names = schema.fieldNames()
    return blocks.drop("keys", "holders").join(back, "block", "left").select(
        "block", "held", "places", "times", "docs", "told"
    ).mapInArrow(run, schema)
