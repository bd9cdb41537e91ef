"""Words of many UTF-8 texts at once, as arrays. Runs on the executors."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

SEED = 20_250_131
CHUNK_BYTES = 250_000


def release() -> None:
    """Give memory that was freed back to the machine: a worker stays for later tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim:
            trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are white space, and a random 64-bit number for each byte; A-Z count as a-z."""
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    numbers = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    numbers[65:91] = numbers[97:123]
    numbers[space] = 0
    return space, numbers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row + 1, bytes and offsets of runs of rows of about `limit` bytes."""
    data, offsets = utf8(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit)))
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, space: np.ndarray, numbers: np.ndarray):
    """(hash, row, start, end) of the words, in order. `space` says which bytes part words, and
    `numbers` has 0 for those; bytes with the same number count as the same."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    inside = ~space[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(inside & after) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    spans = np.diff(np.concatenate(([0], starts, [len(data)])))
    place = np.arange(len(data)) - np.repeat(np.concatenate(([0], starts)), spans)
    place[~inside] = 0
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    hashes = np.add.reduceat(numbers[data] * powers[place], starts)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return mix(hashes), rows, starts, ends


cloudpickle.register_pickle_by_value(sys.modules[__name__])
