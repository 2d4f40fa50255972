"""A configuration linear program over a histogram of lengths, rounded to whole bins.

The program chooses how often to use each configuration (lengths that fit into
one bin together), so that every length is covered as often as it occurs and as
few bins as possible are used. It has a column for every way to fill a bin, so
columns are priced when they are needed: a knapsack by dynamic programming finds
the configurations of the highest price, for all lengths at once, and
multiplicative weights lower the price of what is covered.

Everything here is on arrays of at most ``capacity`` numbers: the work depends
on the bin's size and not on how many items there are.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np

# Share of a length that one use of a configuration covers at most.
STEP = 0.1
# How much a price falls while its length is covered.
RATE = 0.5
# Configurations taken from one pricing.
BATCH = 64
# First prices are sizes to this power: long items are harder to place.
POWER = 1.2

Configuration = tuple[tuple[int, int], ...]


class Prices(NamedTuple):
    """Best price of every bin size, and the item that is taken there first."""

    best: np.ndarray
    item: np.ndarray


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> Prices:
    """Price of the best contents of each size up to ``capacity``; ``lengths`` ascend."""
    best = np.zeros(capacity + 1)
    item = np.full(capacity + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for size in range(1, capacity + 1):
        best[size] = best[size - 1]
        count = fitting[size]
        if count:
            worth = best[size - lengths[:count]]
            worth += prices[:count]
            top = int(worth.argmax())
            if worth[top] > best[size]:
                best[size], item[size] = worth[top], top
    return Prices(best, item)


def _contents(priced: Prices, lengths: np.ndarray, size: int, first: int) -> Counter:
    """The items of the best configuration that holds ``first``."""
    found = Counter([first])
    left = size - int(lengths[first])
    while left > 0:
        top = int(priced.item[left])
        if top < 0:
            left -= 1
        else:
            found[top] += 1
            left -= int(lengths[top])
    return found


def solve(counts: np.ndarray, capacity: int) -> list[tuple[Configuration, float]]:
    """Configurations and how often each is used, fractions included.

    ``counts[n]`` items have length ``n``. Every length is covered exactly; a
    configuration never covers more than is left of any of its lengths.
    """
    lengths = np.flatnonzero(counts[: capacity + 1])
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return []
    need = counts[lengths].astype(np.float64)
    left = need.copy()
    used: dict[Configuration, float] = {}
    open_ = np.arange(len(lengths))
    while len(open_):
        share = left[open_] / need[open_]
        own = lengths[open_]
        price = (own / capacity) ** POWER * np.exp(RATE * (share - share.max()))
        priced = knapsack(own, price, capacity)
        # The least covered lengths first; long ones where shares tie.
        for first in np.lexsort((-own, -share))[:BATCH].tolist():
            found = _contents(priced, own, capacity, first)
            at = open_[list(found)]
            copies = np.fromiter(found.values(), np.float64, len(found))
            amount = float(np.min(np.minimum(need[at] * STEP, left[at]) / copies))
            if amount <= 0:
                continue
            pairs = zip(lengths[at].tolist(), found.values(), strict=True)
            key = tuple(sorted(pairs, reverse=True))
            used[key] = used.get(key, 0.0) + amount
            left[at] -= amount * copies
            left[at[left[at] < 1e-9 * need[at]]] = 0.0
        open_ = open_[left[open_] > 0]
    return list(used.items())


def _whole(
    solution: list[tuple[Configuration, float]], counts: np.ndarray, carry: bool
) -> tuple[list[tuple[Configuration, int]], np.ndarray]:
    """Whole uses of the configurations and the counts that are left.

    ``carry`` hands the fraction of a configuration on to the next one, so that
    small fractions add up to bins; without it fractions are left to best fit.
    """
    left, out, carried = counts.copy(), [], 0.0
    for key, amount in sorted(solution, key=lambda x: x[0], reverse=True):
        want = amount + carried if carry else amount
        times = min([int(want + 1e-9), *[int(left[n] // c) for n, c in key]])
        carried = want - times
        if times > 0:
            for n, c in key:
                left[n] -= c * times
            out.append((key, times))
    return out, left


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Long items first, each into the fullest bin that holds it, like bins in one step."""
    bins: dict[int, list[tuple[Configuration, int]]] = {}
    rooms = np.zeros(capacity + 1, dtype=np.int64)
    for n in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[n])
        while left:
            fits = np.flatnonzero(rooms[n:capacity])
            if not len(fits):
                each = capacity // n
                key, times = ((n, each),), left // each
                if not times:
                    key, times = ((n, left),), 1
                left -= times * key[0][1]
            else:
                room = n + int(fits[0])
                old, there = bins[room].pop()
                rooms[room] -= there
                each = min(room // n, left)
                times = min(there, left // each)
                if there > times:
                    bins[room].append((old, there - times))
                    rooms[room] += there - times
                key = (*old, (n, each))
                left -= times * each
            room = capacity - sum(a * b for a, b in key)
            bins.setdefault(room, []).append((key, times))
            rooms[room] += times
    return [entry for kept in bins.values() for entry in kept]


def pack(counts: np.ndarray, capacity: int) -> list[tuple[Configuration, int]]:
    """Whole bins for all items: the program's solution, rounded in the best of several ways.

    Fractions are carried on or left over, and of the bins either all are kept or
    those without a gap. What is left over is packed by best fit.
    """
    solution, ways = solve(counts, capacity), []
    for carry in (False, True):
        bins, left = _whole(solution, counts, carry)
        ways.append(bins + best_fit(left, capacity))
        full = [(key, times) for key, times in bins if sum(n * c for n, c in key) == capacity]
        rest = counts.copy()
        for key, times in full:
            for n, c in key:
                rest[n] -= c * times
        ways.append(full + best_fit(rest, capacity))
    return min(ways, key=lambda bins: sum(times for _, times in bins))
