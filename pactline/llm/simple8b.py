"""Simple-8b: runs of small integers in 64-bit words, coded with numpy.

The top four bits of a word are its selector: how many values it holds and how
wide each is, lowest bits first. Values are coded in blocks of ``BLOCK``; the
word offset of each block is kept beside the words, so any block can be decoded
alone and all blocks of an array at once. The last word of a block may hold
more places than the block has values; these are zero and not decoded.
A block with a value of more than 60 bits escapes: its values are stored as
plain words and the sign bit of its offset is set.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# Selector -> (values in the word, bits of each).
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
_COUNTS = np.array([n for n, _ in SELECTORS], dtype=np.int64)
_WIDTH = BLOCK + max(n for n, _ in SELECTORS)
_PLAIN = np.int64(-(2**63))


def _widths(values: np.ndarray) -> np.ndarray:
    bits = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    bits[values >= np.uint64(1 << 60)] = 64
    return bits


def _choices(bits: np.ndarray) -> np.ndarray:
    """For each place the selector that packs the most values from there on."""
    chosen = np.full(bits.shape, len(SELECTORS) - 1, dtype=np.uint8)
    widest, have = bits.copy(), 1
    for selector in range(len(SELECTORS) - 2, -1, -1):
        count, room = SELECTORS[selector]
        while have < count:
            step = min(have, count - have)
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            have += step
        chosen[widest <= room] = selector
    return chosen


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and the offset of each block's first word (int64)."""
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grid = np.zeros((blocks, _WIDTH), dtype=np.uint64)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint64)
    padded[: len(values)] = values
    grid[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    limits = np.full(blocks, BLOCK)
    limits[-1] = len(values) - (blocks - 1) * BLOCK

    bits = _widths(grid)
    plain = (bits > 60).any(axis=1)
    chosen = _choices(bits)
    chosen[plain] = len(SELECTORS) - 1
    rows = np.arange(blocks)
    at = np.zeros(blocks, dtype=np.int64)
    seen_at, seen_selector = [], []
    while (open_ := at < limits).any():
        here = np.where(open_, at, -1)
        selector = chosen[rows, np.where(open_, at, 0)]
        seen_at.append(here)
        seen_selector.append(selector)
        at = np.where(open_, at + _COUNTS[selector], at)
    place = np.stack(seen_at, axis=1)
    used = place >= 0
    selector = np.stack(seen_selector, axis=1)[used]
    start = (place + rows[:, None] * _WIDTH)[used]
    flat = grid.ravel()
    words = np.zeros(len(start), dtype=np.uint64)
    for s, (count, width) in enumerate(SELECTORS):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        word = np.full(len(mine), s << 60, dtype=np.uint64)
        if width:
            for j in range(count):
                word |= flat[start[mine] + j] << np.uint64(width * j)
        words[mine] = word
    per_block = used.sum(axis=1)
    offsets = np.concatenate([[0], np.cumsum(per_block)[:-1]])
    if plain.any():
        raw = np.repeat(plain, per_block)
        words[raw] = flat[start[raw]]
        offsets = np.where(plain, offsets | _PLAIN, offsets)
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` values of words made by ``pack``, as uint64."""
    blocks = len(offsets)
    if not blocks:
        return np.zeros(0, dtype=np.uint64)
    plain = offsets < 0
    offsets = offsets & ~_PLAIN
    per_block = np.diff(np.append(offsets, len(words)))
    block = np.repeat(np.arange(blocks), per_block)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = plain[block]
    selector[raw] = len(SELECTORS) - 1
    counts = _COUNTS[selector]
    ahead = np.cumsum(counts) - counts
    start = ahead - ahead[offsets][block] + block * _WIDTH
    out = np.zeros(blocks * _WIDTH, dtype=np.uint64)
    for s, (count, width) in enumerate(SELECTORS):
        mine = np.flatnonzero(selector == s)
        if not len(mine) or not width:
            continue
        mask = np.uint64((1 << width) - 1)
        for j in range(count):
            out[start[mine] + j] = (words[mine] >> np.uint64(width * j)) & mask
    out[start[raw]] = words[raw]
    return out.reshape(blocks, _WIDTH)[:, :BLOCK].ravel()[:size]
