"""Words of whole texts as numpy columns, straight from Arrow's text buffers.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``. No Python string is made, so the cost per word
is a few vector operations, and memory stays in proportion to ``slice_bytes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words up to this many bytes are hashed by table, longer ones by xxhash.
SHORT = 32


def _spaces() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


SPACES = _spaces()
LOWER = _lower()
#: One random 64-bit value for each place in a word and each byte.
TABLE = np.random.default_rng(20240517).integers(0, 2**64, size=(SHORT, 256), dtype=np.uint64)


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer row."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, length and row of every run of bytes ``inside``; ``data`` starts at ``offsets[0]``."""
    base = offsets - offsets[0]
    solid = inside[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[base] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    rows = np.searchsorted(base, starts, side="right") - 1
    return starts, ends - starts, rows


def hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same on every machine."""
    out = np.zeros(len(starts), dtype=np.uint64)
    live = np.flatnonzero(lengths <= SHORT)
    at, left = starts[live], lengths[live]
    for place in range(SHORT):
        keep = left > place
        if not keep.all():
            live, at, left = live[keep], at[keep], left[keep]
        if not len(live):
            break
        out[live] += TABLE[place][data[at + place]]
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes())
    return mix(out ^ (lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, and the number of the distinct value at each place."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.empty(len(values), dtype=bool)
    new[:1] = True
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number
