"""Word-aligned coding of unsigned integers: each 64-bit word holds as many values as fit.

The upper four bits of a word are its selector, the lower 60 hold values of one width. Selector 0 is an
escape: the next word is one raw 64-bit value. Selector 1 is a run: 32 bits of value, 28 bits of count.
Blocks of ``BLOCK`` values start at a word of their own, so a table of block offsets lets a reader start
at any block and decode all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Fixed by the format: width in bits of selectors 2 to 15; a word holds 60 // width values.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE, RUN = 0, 1
#: Shortest run that gets a word of its own.
LEAST_RUN = 61


def _classes(values: np.ndarray) -> np.ndarray:
    """For each value, the number of widths that are too narrow for it (14: it needs an escape)."""
    largest = int(values.max())
    if largest < 1 << 20:
        table = np.zeros(largest + 1, np.uint8)
        for width in WIDTHS:
            table[1 << width :] += 1
        return table[values]
    out = np.zeros(len(values), np.uint8)
    for width in WIDTHS:
        out += values >> np.uint64(width) != 0
    return out


def _takes(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most values a word can hold from each place on, and its selector.

    The largest class of the next n values comes from those of fewer values; past the end all is 0.
    """
    n = len(classes)
    takes, kind = np.ones(n, np.uint8), np.full(n, ESCAPE, np.uint8)
    top, have = classes, 1
    for number, width in reversed(list(enumerate(WIDTHS, 2))):
        fits = 60 // width
        while have < fits:
            step = min(have, fits - have)
            wider = top.copy()
            np.maximum(top[: n - step], top[step:], out=wider[: n - step])
            top, have = wider, have + step
        ok = top <= number - 2
        takes[ok], kind[ok] = fits, number
    return takes, kind


def encode(values: np.ndarray, bounds: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of many streams, the word offsets of the streams, and the first word of every block.

    Stream ``i`` is ``values[bounds[i]:bounds[i + 1]]``. Its blocks are those of its values, in order.
    """
    values = values.astype(np.uint64)
    n, sizes = len(values), np.diff(bounds)
    blocks = -(-sizes // block)
    first = np.repeat(bounds[:-1], blocks) + (np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * block
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, np.int64)
    ends = np.append(first[1:], n)
    # Zeros behind each block let its last word be filled up.
    spread = np.arange(n) + np.repeat(np.arange(len(first)) * 60, ends - first)
    padded = np.zeros(n + 60 * len(first), np.uint8)
    padded[spread] = _classes(values)
    takes, kind = (x[spread].astype(np.int64) for x in _takes(padded))
    change = np.flatnonzero(values[1:] != values[:-1]) + 1
    run_ends = np.append(change, n)
    run_sizes = np.diff(run_ends, prepend=0)
    if run_sizes.max() >= LEAST_RUN:
        limit = np.repeat(ends, ends - first)
        run = np.minimum(np.repeat(run_ends, run_sizes), limit) - np.arange(n)
        long = (run >= LEAST_RUN) & (values < 1 << 32)
        takes[long], kind[long] = run[long], RUN
    step, at, place = takes.tolist(), [], 0
    for place, end in zip(first.tolist(), ends.tolist()):
        while place < end:
            at.append(place)
            place += step[place]
    at = np.array(at)
    block_of = np.searchsorted(ends, at, side="right")
    takes = np.minimum(takes[at], ends[block_of] - at)
    kinds = kind[at]
    place = np.cumsum(np.where(kinds == ESCAPE, 2, 1)) - np.where(kinds == ESCAPE, 2, 1)
    out = np.zeros(int(place[-1]) + (2 if kinds[-1] == ESCAPE else 1), np.uint64)
    for number, width in enumerate(WIDTHS, 2):
        mine = np.flatnonzero(kinds == number)
        if not len(mine):
            continue
        start, count = at[mine], takes[mine]
        word = np.full(len(mine), number << 60, np.uint64)
        for k in range(60 // width):
            have = count > k
            word[have] |= values[start[have] + k] << np.uint64(k * width)
        out[place[mine]] = word
    mine = np.flatnonzero(kinds == RUN)
    out[place[mine]] = np.uint64(RUN << 60) | takes[mine].astype(np.uint64) << np.uint64(32) | values[at[mine]]
    mine = np.flatnonzero(kinds == ESCAPE)
    out[place[mine] + 1] = values[at[mine]]
    words_at = np.append(place, len(out))
    block_words = words_at[np.searchsorted(at, first)]
    stream_words = words_at[np.searchsorted(at, bounds)]
    return out, stream_words, block_words


def decode(words: np.ndarray, block_words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All values of blocks that begin at ``block_words`` and hold ``sizes`` values each."""
    n = int(sizes.sum())
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    kinds = (words >> np.uint64(60)).astype(np.int64)
    # The raw word behind an escape is no word of its own.
    raw = np.zeros(len(words), dtype=bool)
    for i in np.flatnonzero(kinds == ESCAPE).tolist():
        if not raw[i]:
            raw[i + 1] = True
    at = np.flatnonzero(~raw)
    kinds, word = kinds[at], words[at]
    takes = np.array([1, 0, *(60 // w for w in WIDTHS)])[kinds]
    runs = kinds == RUN
    takes[runs] = (word[runs] >> np.uint64(32) & np.uint64((1 << 28) - 1)).astype(np.int64)
    own = np.searchsorted(block_words, at, side="right") - 1
    total = np.cumsum(takes)
    before = total - takes
    head = np.searchsorted(at, block_words)
    before = before - before[head][own]
    takes = np.minimum(takes, sizes[own] - before)
    first = (np.cumsum(sizes) - sizes)[own] + before
    for number, width in enumerate(WIDTHS, 2):
        mine = np.flatnonzero(kinds == number)
        if not len(mine):
            continue
        mask = np.uint64((1 << width) - 1)
        for k in range(60 // width):
            have = mine[takes[mine] > k]
            out[first[have] + k] = word[have] >> np.uint64(k * width) & mask
    mine = np.flatnonzero(runs)
    if len(mine):
        many = takes[mine]
        where = np.repeat(first[mine], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        out[where] = np.repeat(word[mine] & np.uint64((1 << 32) - 1), many)
    mine = np.flatnonzero(kinds == ESCAPE)
    out[first[mine]] = words[at[mine] + 1]
    return out
