"""Word and shingle hashes of whole text columns, computed over Arrow's own buffers.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Its hash is
a sum over its bytes, so a text of any length is read in pieces of ``PIECE`` bytes, and a
word that two pieces share is added up. Memory beyond the text itself is a few times
PIECE plus 8 bytes a word. Hashes have 64 bits: two of m different words or shingles
share one with probability m * m / 2**65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
WIDTH = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over 64 bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_FOLD = np.arange(256)
_FOLD[ord("A"):ord("Z") + 1] += 32
_BYTE = mix(_FOLD.astype(np.uint64) + np.uint64(1))
_EXACT_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.concatenate([[np.uint64(1)], np.full(PIECE, _BASE, np.uint64)]))
    _STEP = mix(np.arange(1, 4 * WIDTH, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 places where its texts begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(places, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[at[0]:at[-1]], at - at[0]


def runs(
    data: np.ndarray, at: np.ndarray, outside: np.ndarray = _SPACE, table: np.ndarray = _BYTE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and unmixed hash of each run of bytes that are not ``outside``."""
    starts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    sums: list[np.ndarray] = []
    going = False
    for low in range(0, len(data), PIECE):
        piece = data[low:low + PIECE]
        inside = ~outside[piece]
        breaks = np.ones(len(piece), bool)
        breaks[1:] = ~inside[:-1]
        edges = at[np.searchsorted(at, low):np.searchsorted(at, low + len(piece))] - low
        goes_on = going and bool(inside[0]) and not (len(edges) and edges[0] == 0)
        breaks[edges] = True
        going = bool(inside[-1])
        where = np.flatnonzero(inside)
        if not len(where):
            continue
        first = np.flatnonzero(breaks[where])
        if len(first) == 0 or first[0] != 0:
            first = np.concatenate([[0], first])
        size = np.diff(np.append(first, len(where)))
        place = np.arange(len(where)) - np.repeat(first, size)
        total = np.add.reduceat(table[piece[where]] * _POWER[place], first)
        start = where[first] + low
        if goes_on:
            with np.errstate(over="ignore"):
                factor = np.uint64(pow(int(_BASE), int(sizes[-1][-1]), 1 << 64))
                sums[-1][-1] += total[0] * factor
            sizes[-1][-1] += size[0]
            start, size, total = start[1:], size[1:], total[1:]
        if len(start):
            starts.append(start)
            sizes.append(size)
            sums.append(total)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(sums)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 places where each text's words begin."""
    data, at = buffers(column)
    start, size, total = runs(data, at)
    with np.errstate(over="ignore"):
        hashes = mix(total + size.astype(np.uint64) * _STEP[0])
    return hashes, np.searchsorted(start, at)


def shingle_hashes(words: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, repeats included; a shorter text is one shingle."""
    count = np.diff(at)
    number = np.where(count == 0, 0, np.maximum(1, count - width + 1))
    places = np.concatenate([[0], np.cumsum(number)])
    first = np.arange(places[-1]) - np.repeat(places[:-1] - at[:-1], number)
    used = np.repeat(np.minimum(count, width), number)
    with np.errstate(over="ignore"):
        out = used.astype(np.uint64) * _STEP[width]
        for i in range(width):
            inside = used > i
            out[inside] += words[first[inside] + i] * _STEP[i]
    return mix(out), places


def slices(column: pa.Array, most: int = 8 * PIECE, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Cut a column into ranges of at most ``rows`` texts and ``most`` bytes; a longer text stands alone."""
    _, at = buffers(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        high = min(high, low + rows, len(column))
        yield low, high
        low = high


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function over batches, which gives its memory back when they end: Python workers live on between tasks, and what a
    task's arrays took stays theirs otherwise."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)

    return wrapped


def distinct_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each begins."""
    shingles, at = shingle_hashes(*word_hashes(column))
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        shingles[low:high].sort()
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = shingles[1:] != shingles[:-1]
    fresh[at[:-1][at[:-1] < len(shingles)]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return shingles[fresh], kept[at]
