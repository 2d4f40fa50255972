"""Words and their hashes for whole Arrow columns of text, as numpy arrays.

A word is a maximal run of bytes other than space and the control characters
9 to 13. Nothing here loops over words or documents in Python: positions come
from masks, hashes from prefix sums, so a task costs a few passes per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer text is worked on alone, whole.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_LANES = 2
_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(1, 2**63, size=(_LANES, 256), dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[:, 65:91] = _FOLDED[:, 97:123]
_BASE = [int(x) | 1 for x in _rng.integers(2**62, 2**63, size=_LANES, dtype=np.uint64)]
_GRAM = _rng.integers(2**62, 2**63, size=(_LANES, 64), dtype=np.uint64) | np.uint64(1)
# Places whose powers are kept.
_BLOCK = 1 << 16
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Slice(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a column as one run of bytes."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Byte positions of words, the first word of each row and the row count."""

    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.firsts) - 1), self.counts)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into runs of rows of about ``limit`` bytes; null is empty."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        cut = offsets[first : last + 1]
        yield Slice(first, last, data[cut[0] : cut[-1]], cut - cut[0])
        first = last


def find_words(part: Slice) -> Words:
    """Where the words of a slice are; a word never crosses from row to row."""
    solid = ~SPACE[part.data]
    edge = np.zeros(len(part.data) + 1, dtype=bool)
    edge[part.offsets] = True
    before = np.zeros_like(solid)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros_like(solid)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


_SIGNIFICANT = np.zeros(256, dtype=bool)
_SIGNIFICANT[48:58] = _SIGNIFICANT[65:91] = _SIGNIFICANT[97:123] = _SIGNIFICANT[128:] = True


def trimmed(part: Slice, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words without signs at their ends; a word of signs stays whole."""
    places = np.flatnonzero(_SIGNIFICANT[part.data])
    if not len(places):
        return words.starts, words.ends
    low = np.searchsorted(places, words.starts)
    high = np.searchsorted(places, words.ends) - 1
    some = low <= high
    starts = np.where(some, places[np.minimum(low, len(places) - 1)], words.starts)
    return starts, np.where(some, places[np.maximum(high, 0)] + 1, words.ends)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(lane: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``_BLOCK`` powers of a lane's base and of its inverse."""
    if lane not in _powers:
        steps = np.ones((2, _BLOCK), dtype=np.uint64)
        steps[0, 1:] = _BASE[lane]
        steps[1, 1:] = pow(_BASE[lane], -1, 2**64)
        _powers[lane] = tuple(np.multiply.accumulate(row) for row in steps)
    return _powers[lane]


def _block_powers(base: int, size: int) -> np.ndarray:
    """Powers of ``base`` at the first place of every block of ``size`` places."""
    steps = np.full(size // _BLOCK + 1, pow(base, _BLOCK, 2**64), dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class SpanHasher:
    """64-bit hashes of spans of bytes; ``fold`` lower-cases A-Z first.

    Powers are kept for one block of places and put together from two levels, so
    a worker keeps 2 MB of them however long its texts are.
    """

    def __init__(self, data: np.ndarray, fold: bool = False, lane: int = 0):
        up, self._down = _power(lane)
        self._far = _block_powers(pow(_BASE[lane], -1, 2**64), len(data))
        letters = (_FOLDED if fold else _BYTE)[lane]
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        for nth, far in enumerate(_block_powers(_BASE[lane], len(data))):
            first = nth * _BLOCK
            block = letters[data[first : first + _BLOCK]]
            block *= up[: len(block)]
            block *= far
            sums = self._sums[first + 1 : first + 1 + len(block)]
            np.cumsum(block, out=sums)
            sums += self._sums[first]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = self._sums[ends] - self._sums[starts]
        value *= self._down[starts % _BLOCK]
        value *= self._far[starts // _BLOCK]
        value += (ends - starts).astype(np.uint64)
        return mix(value)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False, lane: int = 0
) -> np.ndarray:
    return SpanHasher(data, fold, lane)(starts, ends)


def gram_hashes(words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """A hash for each ``n`` consecutive word hashes, rows ignored."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        total += words[i : i + size] * _GRAM[lane, i]
    return mix(total)


def ids_column(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("doc_id")


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)
