"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The model is of the merge type with byte fallback. A text's symbols are its code points; the agenda holds
every pair of neighbours that is a piece, best score first, leftmost among equals. A keyed hash of (seed, document,
stretch and its number in the text, place, piece) skips a candidate with the given rate, so that every occurrence of a word
is segmented by a draw of its own, and reruns agree. Without dropout the result is the model's usual encoding.

No piece has a word mark after another character (checked when the model is read), so that no merge crosses the beginning of
a run of spaces: a text falls apart into stretches (spaces, then other characters). A stretch's segmentation follows from
which of the pieces that occur in it are skipped where. Occurrences with the same stretch and the same skipped ones (64-bit hashes
of both) are segmented once in a few megabytes of text, all stretches of like length together: each round takes the
best candidate of every stretch. Longer ones than LONG symbols go through an agenda one by one. Symbols outside the vocabulary and the
word mark itself become bytes. Decoding joins pieces' bytes and takes the leading space off.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labmeter.llm.shingles import _EXACT_BYTE, _POWER, PIECE, buffers, mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE = 0.1
SEED = 20240501
LONG = 48
DRAWS_AT_ONCE = 16384
MARK = "▁"

_M = (1 << 64) - 1
_NONE = 1 << 62
_FAR = 2**31 - 1


class Table:
    """An open table from 64-bit keys to two numbers each."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        bits = max(4, (4 * len(rows)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _M, np.uint64)
        self.values = np.zeros((1 << bits, 2), np.int32)
        for key, one, two in rows:
            slot = (key * 0x9E3779B97F4A7C15 & _M) >> (64 - bits)
            while self.keys[slot] != _M:
                slot = slot + 1 & self.mask
            self.keys[slot] = key
            self.values[slot] = one, two

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both numbers of the keys ``left << 32 | right`` (_FAR, 0: no such key)."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        one, two = np.full(len(key), _FAR, np.int32), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[slot]
            hit = held == key[todo]
            one[todo[hit]] = self.values[slot[hit], 0]
            two[todo[hit]] = self.values[slot[hit], 1]
            on = ~hit & (held != np.uint64(_M))
            todo, slot = todo[on], slot[on] + 1 & self.mask
        return one, two


class Pieces:
    """A vocabulary: rank and id of each piece, ids of the 256 bytes, the bytes of each id.

    ``pair`` finds what two neighbours merge to, in a table of all splits of pieces into two; ``tree`` leads from a
    beginning of pieces and a symbol to the next longer beginning, and tells the id of the piece that it is (-1: none).
    """

    def __init__(self, ranks: dict[str, tuple[int, int]], byte_ids: list[int], bytes_of: list[bytes]):
        self.ranks, self.byte_ids, self.bytes_of = ranks, byte_ids, bytes_of
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.base = len(bytes_of)
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.base
        for piece, (_, i) in ranks.items():
            if len(piece) == 1 and piece != MARK:
                self.symbol[ord(piece)] = i
        self.symbol[0x20] = ranks[MARK][1]
        splits = [
            (ranks[p[:i]][1] << 32 | ranks[p[i:]][1], rank, made)
            for p, (rank, made) in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks
        ]
        self.splits = Table(splits)
        nodes: dict[tuple[int, int], list[int]] = {}
        for piece, (_, i) in ranks.items():
            node = 0
            for c in piece:
                step = nodes.setdefault((node, int(self.symbol[0x20 if c == MARK else ord(c)])), [len(nodes) + 1, -1])
                node = step[0]
            step[1] = i
        self.tree = Table([(node << 32 | symbol, to, i) for (node, symbol), (to, i) in nodes.items()])

    def __reduce__(self):
        return Pieces, (self.ranks, self.byte_ids, self.bytes_of)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (_FAR: no piece) and id of the merged neighbours."""
        return self.splits.find(left, right)


def read_model(path: str = MODEL) -> Pieces:
    """Reads a model on the driver; it is sent to the executors (a vocabulary is of fixed size)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks, byte_ids, bytes_of = {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            bytes_of.append(bytes([int(piece[3:5], 16)]))
            continue
        bytes_of.append(piece.replace(MARK, " ").encode())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ranks[piece] = (i, i)
    order = sorted(ranks, key=lambda p: (-model.get_score(ranks[p][1]), ranks[p][1]))
    ranks = {p: (rank, ranks[p][1]) for rank, p in enumerate(order)}
    if -1 in byte_ids or any(MARK in p.lstrip(MARK) for p in ranks):
        raise ValueError("the model needs byte fallback and pieces with word marks in front only")
    return Pieces(ranks, byte_ids, bytes_of)


def skipped(key: int, place: int, piece: int, least: int) -> bool:
    x = (key + place * 0x9E3779B97F4A7C15 + piece * 0xC2B2AE3D27D4EB4F) & _M
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _M
    return (x ^ (x >> 29)) & 0xFFFFFFFF < least


def merged(symbols: list[str], ranks: dict[str, tuple[int, int]], key: int, least: int) -> list[str]:
    """Segments one stretch. ``least``: rate of skipping times 2 ** 32."""

    def wanted(a: str, b: str, place: int) -> int:
        found = ranks.get(a + b)
        if found is None or least and skipped(key, place, found[1], least):
            return _NONE
        return found[0]

    if len(symbols) <= LONG:
        symbols, places = list(symbols), list(range(len(symbols)))
        best = [wanted(symbols[i], symbols[i + 1], i) for i in range(len(symbols) - 1)]
        while best:
            least_rank = min(best)
            if least_rank == _NONE:
                break
            i = best.index(least_rank)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del places[i + 1], best[i]
            if i:
                best[i - 1] = wanted(symbols[i - 1], symbols[i], places[i - 1])
            if i < len(best):
                best[i] = wanted(symbols[i], symbols[i + 1], places[i])
        return symbols
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    agenda: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < len(parts):
            rank = wanted(parts[i], parts[after[i]], i)
            if rank != _NONE:
                heapq.heappush(agenda, (rank, i, parts[i] + parts[after[i]]))

    for i in range(len(parts) - 1):
        offer(i)
    while agenda:
        _, i, whole = heapq.heappop(agenda)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != whole:
            continue
        gone = after[i]
        parts[i], parts[gone] = whole, None
        after[i] = after[gone]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def stretch_ids(model: Pieces, stretch: bytes, leading: bool, key: int, least: int) -> list[int]:
    text = stretch.decode()
    symbols = [MARK if c == " " else "\0" + MARK if c == MARK else c for c in (" " + text if leading else text)]
    ids = []
    for symbol in merged(symbols, model.ranks, key, least):
        found = model.ranks.get(symbol)
        if found is not None:
            ids.append(found[1])
        else:
            ids += [model.byte_ids[b] for b in (symbol if symbol[1:] != MARK else MARK).encode()]
    return ids


def stretches(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash of each stretch, and where each text's stretches begin. An empty text has none."""
    space = data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[at[:-1][np.diff(at) > 0]] = True
    start = np.flatnonzero(begins)
    size = np.diff(np.append(start, len(data)))
    hashes = np.zeros(len(start), np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(start, start[low] + PIECE, "right")) - 1)
        if size[low] > PIECE:
            digest = hashlib.blake2b(data[start[low]:start[low] + size[low]].tobytes(), digest_size=8).digest()
            hashes[low] = int.from_bytes(digest, "little")
            low += 1
            continue
        first, last = start[low], start[high - 1] + size[high - 1]
        if last - first > PIECE:
            high = max(low + 1, high - 1)
            last = start[high - 1] + size[high - 1]
        place = np.arange(first, last) - np.repeat(start[low:high], size[low:high])
        hashes[low:high] = np.add.reduceat(_EXACT_BYTE[data[first:last]] * _POWER[place], start[low:high] - first)
        low = high
    return start, mix(hashes + size.astype(np.uint64)), np.searchsorted(start, at)


def gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ranges of ``values``, one after the other."""
    return values[gathered_places(first, size)]


def gathered_places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def _candidate(place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def _hit(x: np.ndarray, least: int) -> np.ndarray:
    """``skipped`` for arrays of key + candidate."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) & np.uint64(0xFFFFFFFF) < np.uint64(least)


def merged_together(model: Pieces, symbols: np.ndarray, number: np.ndarray, keys: np.ndarray, least: int) -> np.ndarray:
    """Segments many stretches: (stretches x width) symbols are merged in place, ``number`` counts them. Returns it."""
    width = symbols.shape[1]
    place = np.broadcast_to(np.arange(width, dtype=np.int16), symbols.shape).copy()
    ranks = np.full((len(symbols), width), _FAR, np.int32)
    made = np.zeros((len(symbols), width), np.int32)

    def offer(rows: np.ndarray, at: np.ndarray) -> None:
        rank, piece = model.pair(symbols[rows, at], symbols[rows, at + 1])
        some = np.flatnonzero(rank != _FAR)
        if least:
            rank[some[_hit(keys[rows[some]] + _candidate(place[rows[some], at[some]], piece[some]), least)]] = _FAR
        ranks[rows, at], made[rows, at] = rank, piece

    rows, at = np.nonzero(np.arange(width)[None, :] < number[:, None] - 1)
    offer(rows, at)
    live, columns = np.arange(len(symbols)), np.arange(width)[None, :]
    while len(live):
        best = ranks[live].argmin(1)
        some = ranks[live, best] != _FAR
        live, best = live[some], best[some]
        if not len(live):
            break
        symbols[live, best] = made[live, best]
        right = columns != best[:, None] + 1  # the right neighbour goes, and the candidate itself
        own = columns != best[:, None]
        for table, kept in ((symbols, right), (place, right), (ranks, own), (made, own)):
            rows = table[live]
            rows[:, :-1] = rows[kept].reshape(len(live), width - 1)
            table[live] = rows
        number[live] -= 1
        ranks[live, number[live] - 1] = _FAR
        left, right = best > 0, best < number[live] - 1
        offer(np.concatenate([live[left], live[right]]), np.concatenate([best[left] - 1, best[right]]))
    return number


def _as_ids(model: Pieces, symbols: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the symbols (those outside the vocabulary: of their bytes), and how many of each stretch."""
    odd = np.flatnonzero(symbols >= model.base)
    if not len(odd):
        return symbols, number
    kinds, back = np.unique(symbols[odd], return_inverse=True)
    spelt = [[model.byte_ids[b] for b in chr(k - model.base).encode()] for k in kinds.tolist()]
    size = np.ones(len(symbols), np.int64)
    size[odd] = np.array([len(x) for x in spelt])[back]
    ids = np.repeat(symbols, size)
    first = np.cumsum(size) - size
    for i, symbol in zip(odd.tolist(), back.tolist()):
        ids[first[i]:first[i] + size[i]] = spelt[symbol]
    total = np.concatenate([[0], np.cumsum(size)])
    ends = np.cumsum(number)
    return ids, total[ends] - total[ends - number]


def _symbols(model: Pieces, data: np.ndarray, start: np.ndarray, size: np.ndarray, leading: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the stretches, one stretch after the other, and how many each has."""
    stretch = gathered(data, start, size)
    points = np.add.reduceat(((stretch & 0xC0) != 0x80).astype(np.int64), np.cumsum(size) - size)
    text = np.frombuffer(stretch.tobytes().decode().encode("utf-32-le"), np.uint32)
    return np.insert(model.symbol[text], (np.cumsum(points) - points)[leading], model.symbol[0x20]), points + leading


def _occurring(model: Pieces, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each place and piece of two symbols or more in stretches up to LONG, by stretch, and how many each has.

    Whatever a merge may offer is among them: neighbours merge to a piece that the text has at the place of the left one.
    """
    end = np.repeat(np.cumsum(count), count)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(count) - count, count)
    live = np.flatnonzero(np.repeat(count <= LONG, count))
    node, depth = np.zeros(len(live), np.int32), 0
    found, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    while len(live):
        inside = live + depth < end[live]
        live, node = live[inside], node[inside]
        node, piece = model.tree.find(node, symbols[live + depth])
        on = node != _FAR
        live, node, piece = live[on], node[on], piece[on]
        if depth:
            found.append(live[piece >= 0])
            pieces.append(piece[piece >= 0])
        depth += 1
    at, piece = np.concatenate(found), np.concatenate(pieces)
    order = np.argsort(at, kind="stable")
    at, piece = at[order], piece[order]
    owner = np.repeat(np.arange(len(count)), count)[at]
    return _candidate(place[at], piece), np.bincount(owner, minlength=len(count))


def _draws(key: np.ndarray, kind: np.ndarray, candidates: np.ndarray, number: np.ndarray, least: int) -> np.ndarray:
    """A hash for each occurrence of which of its stretch's candidates are skipped. ``kind``: the occurrence's stretch."""
    first, stamps = np.cumsum(number) - number, mix(candidates)
    found = np.zeros(len(key), np.uint64)
    for low in range(0, len(key), DRAWS_AT_ONCE):
        own = kind[low:low + DRAWS_AT_ONCE]
        own, rows = own[number[own] > 0], low + np.flatnonzero(number[own] > 0)
        if not len(rows):
            continue
        size = number[own]
        at = gathered_places(first[own], size)
        out = _hit(np.repeat(key[rows], size) + candidates[at], least)
        found[rows] = np.add.reduceat(np.where(out, stamps[at], np.uint64(0)), np.cumsum(size) - size)
    return found


def segmented(model: Pieces, data: np.ndarray, start: np.ndarray, size: np.ndarray, leading: np.ndarray, keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each stretch, one after the other, and how many each has."""
    symbols, count = _symbols(model, data, start, size, leading)
    first = np.cumsum(count) - count
    found, number = [], np.zeros(len(start), np.int64)
    place = np.zeros(len(start), np.int64)
    total, low = 0, 0
    for width in sorted({min(w, LONG) for w in (3, 5, 7, 9, 12, 16, 24, LONG)}):
        rows = np.flatnonzero((count > low) & (count <= width))
        low = width
        if not len(rows):
            continue
        table = np.full((len(rows), width), -1, np.int32)
        inside = np.arange(width)[None, :] < count[rows][:, None]
        table[inside] = gathered(symbols, first[rows], count[rows])
        held = merged_together(model, table, count[rows].copy(), keys[rows], least)
        ids, held = _as_ids(model, table[np.arange(width)[None, :] < held[:, None]], held)
        number[rows], place[rows] = held, total + np.cumsum(held) - held
        found.append(ids)
        total += len(ids)
    for i in np.flatnonzero(count > LONG).tolist():
        ids = stretch_ids(model, data[start[i]:start[i] + size[i]].tobytes(), bool(leading[i]), int(keys[i]), least)
        number[i], place[i] = len(ids), total
        found.append(np.array(ids, np.int32))
        total += len(ids)
    return gathered(np.concatenate(found), place, number), number


def encode_column(model: Pieces, column: pa.Array, variant: np.ndarray, seed: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's begin. ``variant``: a 64-bit number of each text's draw."""
    data, at = buffers(column)
    start, hashes, own = stretches(data, at)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    size, held, least = np.diff(np.append(start, len(data))), np.diff(own), int(rate * 2**32)
    leading = np.zeros(len(start), bool)
    leading[own[:-1][held > 0]] = True
    with np.errstate(over="ignore"):
        named = hashes ^ leading.astype(np.uint64) * np.uint64(0x5851F42D4C957F2D)
        _, sample, back = np.unique(named, return_index=True, return_inverse=True)
        keys = np.zeros(len(start), np.uint64)
        if least:
            stamp = mix(variant.astype(np.int64).view(np.uint64) ^ mix(np.array([seed % 2**64], np.uint64)))
            order = (np.arange(len(start)) - np.repeat(own[:-1], held)).astype(np.uint64)
            keys = mix(named ^ mix(np.repeat(stamp, held) + order * np.uint64(0xD6E8FEB86659FD93)))
            symbols, count = _symbols(model, data, start[sample], size[sample], leading[sample])
            draws = np.where(count[back] > LONG, keys, _draws(keys, back, *_occurring(model, symbols, count), least))
            _, sample, back = np.unique(mix(named) + draws, return_index=True, return_inverse=True)
        ids, number = segmented(model, data, start[sample], size[sample], leading[sample], keys[sample], least)
    ids = gathered(ids, (np.cumsum(number) - number)[back], number[back])
    return ids, np.concatenate([[0], np.cumsum(number[back])])[own]


def decode_ids(model: Pieces, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The UTF-8 bytes of each text."""
    size = model.sizes[ids]
    data = gathered(model.flat, model.starts[ids], size)
    ends = np.concatenate([[0], np.cumsum(size)])[at]
    return [data[a + 1:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, path: str = MODEL, ids: str = "doc_id", text: str = "text", seed: int = SEED, rate: float = RATE, copies: bool = False) -> DataFrame:
    """Adds ``pieces``: the ids of the text; other columns pass.

    Null and empty texts have no pieces. Rows of equal id and text agree, unless ``copies`` says that such rows that follow one another
    are copies with a draw of their own each: the first of them has that of a single row. They are counted as far as one task reads on, so that
    a copy that a file's split parts from the one before it counts as the first again.
    An empty table stays empty. A column named ``pieces`` is replaced.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_model(path))
    plain = docs.drop("pieces")
    docs = plain.withColumn("pieces", F.xxhash64(ids, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (0, -1)
        for batch in batches:
            if copies and len(batch):
                drawn, last = own_draws(batch.column("pieces").to_numpy(), *last)
                batch = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(drawn)], names=batch.schema.names)
            for part, found, at in _encoded(shared.value, batch, text, "pieces", seed, rate):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=part.schema.names)

    schema = StructType([*plain.schema.fields, *StructType.fromDDL("pieces array<int>").fields])
    return docs.mapInArrow(run, schema)


def own_draws(variant: np.ndarray, before: int, number: int) -> tuple[np.ndarray, tuple[int, int]]:
    """A number for each row, another one for each of equal rows that follow one another. ``before`` and ``number``: the last row's variant
    and how many such rows it came after (-1: there was none). Also both for the rows' last."""
    first = np.append(number < 0 or variant[0] != before, variant[1:] != variant[:-1])
    starts = np.maximum.accumulate(np.where(first, np.arange(len(variant)), -number - 1))
    nth = np.arange(len(variant)) - starts
    with np.errstate(over="ignore"):
        drawn = variant.view(np.uint64) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return drawn.view(np.int64), (int(variant[-1]), int(nth[-1]))


def _encoded(model: Pieces, batch: pa.RecordBatch, text: str, variant: str, seed: int, rate: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch, with the ids of their texts and where each text's begin."""
    for low, high in slices(batch.column(text), most=8 * PIECE):
        part = batch.slice(low, high - low)
        yield part, *encode_column(model, part.column(text), part.column(variant).to_numpy(), seed, rate)


def decode(encoded: DataFrame, path: str = MODEL, to: str = "decoded") -> DataFrame:
    """Adds the text that the pieces stand for (null pieces: null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            for low in range(0, len(lists), 512):
                part = batch.slice(low, 512)
                own = part.column("pieces")
                at = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in own])]).astype(np.int64)
                texts = decode_ids(shared.value, own.flatten().to_numpy(zero_copy_only=False), at)
                texts = [t.decode() if x.is_valid else None for t, x in zip(texts, own)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, to])

    schema = StructType([*encoded.schema.fields, *StructType.fromDDL(f"{to} string").fields])
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str = MODEL, ids: str = "doc_id", text: str = "text", seed: int = SEED, rate: float = RATE) -> DataFrame:
    """Number of pieces, digests of the pieces and of the decoded text, and whether that is the text itself.

    Texts are encoded and decoded in one pass, so that a task holds the pieces of one slice only. Nulls, empty
    texts and repeated rows are treated as by ``encode``; columns other than id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))
    docs = docs.select(F.col(ids).alias(ids), F.col(text).alias("text"), F.xxhash64(ids, text).alias("variant"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found, at in _encoded(shared.value, batch, "text", "variant", seed, rate):
                data, places = buffers(part.column("text"))
                whole, edges = data.tobytes(), places.tolist()
                decoded = decode_ids(shared.value, found, at)
                named = [",".join(map(str, found[a:b].tolist())).encode() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(n).hexdigest() for n in named], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                    pa.array([d == whole[a:b] for d, a, b in zip(decoded, edges[:-1], edges[1:])], pa.bool_()),
                ], names=[ids, "n_pieces", "pieces_sha256", "decoded_sha256", "lossless"])

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(
        run, f"`{ids}` {kind}, n_pieces bigint, pieces_sha256 string, decoded_sha256 string, lossless boolean"
    )
