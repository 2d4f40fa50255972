"""Benchmark decontamination: latent semantic retrieval, and every near-verbatim item.

1. ``idf_weights``: inverse document frequency of words (lower case, signs at
   their ends removed, hashed to ``WIDTH`` places), counted over all documents.
2. ``basis``: the benchmark's items are cut into passages of up to two blocks of
   ``BLOCK`` words; a randomised SVD of their TF-IDF matrix gives ``RANK``
   directions. Tasks send partial products per place, so the driver holds
   ``WIDTH`` x ``RANK`` numbers at most, whatever the number of passages.
3. Search by cosine: every document is cut into overlapping passages in the same
   way, and each is projected. A passage at ``COSINE`` or more to an item's
   passage, both projections scaled to length one, is a candidate: so an item in
   other words and another order is found, as long as it speaks of the same.
4. Search by rare words, which is exact: whoever keeps ``SHARE`` of an item's n
   words, at least m, keeps k of any n - m + k of them. So the passages with at
   least k of the item's n - m + k rarest words around them are candidates too: no
   near copy is left out, whatever its length and the number of items.
5. A candidate is a leak if the longest common subsequence of the item's words
   and the document's words around the passage covers ``SURE`` of the item; or
   ``SHARE`` of it, in one unbroken run or with ``ANSWER`` of the item's answer
   (its last sentence, at least ``ANSWER_WORDS`` words). So changed, dropped and
   inserted words do not hide an item, nor does a changed or missing answer.
   Where the common subsequence is shorter, down to ``LOOSE``, a candidate of the
   cosine search is a leak if it keeps ``KEPT`` of the answer in one place and,
   in any order, ``HELD`` of the item's words by their weight: a paraphrase.

Items are taken in blocks of ``ITEMS``, each against all documents.

Defined cases: a null or empty text has no passage and no leak; an item without
words matches nothing; one of fewer than ``LEAST`` words, which chance would find
in pieces anywhere, is a leak where its words stand in one run, by a hash of the
whole item (so an item of one word is in every document with that word); equal items each report; rows that repeat a ``doc_id`` are judged
each; an empty benchmark or table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import texts, written
from pactline.llm.words import Slice, SpanHasher, find_words, gram_hashes, slices, trimmed

WIDTH = 1 << 16
BLOCK = 16
RANK = 256
COSINE = 0.55
ENERGY = 0.35
ITEMS = 5_000
LEAST = 8
SHARE = 0.7
SURE = 0.85
ANSWER = 0.5
ANSWER_WORDS = 4
LOOSE = 0.3
KEPT = 0.85
HELD = 0.7
_POWER = 2  # rounds of the range finder
_PASSAGES = 1_024  # projected, or compared with all passages of items, at once
_POSTS = 1 << 20  # words of documents met in items, looked at together
_SENTENCE = re.compile(r"[.!?]+\s+|\n+")

_HITS = (
    "doc_id bigint, text_hash bigint, item_id bigint, cosine double, "
    "lcs_share double, answer_share double"
)


class Coded(NamedTuple):
    """Words of a slice as hashes and places of the TF-IDF space, and their blocks."""

    keys: np.ndarray
    places: np.ndarray
    firsts: np.ndarray
    block: np.ndarray
    block_firsts: np.ndarray


class Item(NamedTuple):
    item_id: int
    words: np.ndarray
    answer: np.ndarray


class Index(NamedTuple):
    weights: np.ndarray
    rank: np.ndarray  # place -> row of ``basis``, or -1
    basis: np.ndarray
    weighed: np.ndarray  # ``basis`` times its places' weights
    vectors: np.ndarray
    owners: np.ndarray
    items: list[Item]
    sizes: np.ndarray
    least: np.ndarray  # how many of an item's rarest words a leak holds at least
    keys: np.ndarray  # the rarest words of all items, and the items of each
    firsts: np.ndarray
    posts: np.ndarray
    runs: dict[int, tuple[np.ndarray, np.ndarray]]  # words of short items -> hashes, items


def _folded(data: np.ndarray) -> np.ndarray:
    """The text with Latin-1's capital letters in lower case (A-Z fold in the hash)."""
    second = np.zeros(len(data), dtype=bool)
    second[1:] = data[:-1] == 0xC3
    capital = second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return np.where(capital, data + np.uint8(0x20), data)


def _coded(part: Slice) -> Coded:
    part = part._replace(data=_folded(part.data))
    found = find_words(part)
    starts, ends = trimmed(part, found)
    keys = SpanHasher(part.data, fold=True)(starts, ends)
    counts = found.counts
    blocks = -(-counts // BLOCK)
    block_firsts = np.concatenate([[0], np.cumsum(blocks)])
    row = found.rows
    block = block_firsts[row] + (np.arange(len(keys)) - found.firsts[row]) // BLOCK
    return Coded(keys, _places(keys), found.firsts, block, block_firsts)


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)


def _passages(coded: Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last block of each passage, and its row: every two neighbours, or a lone block."""
    blocks = np.diff(coded.block_firsts)
    count = np.where(blocks > 1, blocks - 1, blocks)
    row = np.repeat(np.arange(len(blocks)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = coded.block_firsts[row] + nth
    return first, np.minimum(first + 1, coded.block_firsts[row + 1] - 1), row


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, docs = np.zeros(WIDTH, dtype=np.int64), 0
    for batch in batches:
        for part in slices(batch.column("text")):
            coded = _coded(part)
            rows = part.last - part.first
            row = np.repeat(np.arange(rows), np.diff(coded.firsts))
            seen = np.unique(row * WIDTH + coded.places)
            found += np.bincount(seen % WIDTH, minlength=WIDTH)
            docs += rows
    if docs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, WIDTH)), pa.array(np.append([docs], found))],
            names=["place", "n"],
        )


def idf_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each place over all documents; ``WIDTH`` sums."""
    rows = docs.select(F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(_frequencies, "place bigint, n bigint").groupBy("place")
    found = np.zeros(WIDTH + 1)
    for r in sums.agg(F.sum("n").alias("n")).collect():
        found[r["place"] + 1] = r["n"]
    return np.log((1 + found[0]) / (1 + found[1:])) + 1


def _matrix(coded: Coded, weights: np.ndarray):
    """Rows, places and values of the unit TF-IDF vectors of all passages."""
    first, last, _ = _passages(coded)
    bounds = np.searchsorted(coded.block, np.arange(coded.block_firsts[-1] + 1))
    begin, end = bounds[first], bounds[last + 1]
    sizes = end - begin
    row = np.repeat(np.arange(len(first)), sizes)
    token = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[row]
    key, count = np.unique(row * WIDTH + coded.places[token], return_counts=True)
    row, place = np.divmod(key, WIDTH)
    value = count * weights[place]
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(first)))
    return row, place, value / norm[row], len(first)


def _times(row, place, value, rows: int, dense: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Sparse passages times a dense matrix that has a row for each ranked place."""
    out = np.zeros((rows, dense.shape[1]))
    known = rank[place] >= 0
    row, place, value = row[known], place[known], value[known]
    for i in range(0, len(row), 1 << 15):
        r, p, v = (x[i : i + (1 << 15)] for x in (row, place, value))
        heads = np.flatnonzero(np.diff(r, prepend=-1))
        out[r[heads]] += np.add.reduceat(v[:, None] * dense[rank[p]], heads, axis=0)
    return out


def _producer(weights: np.ndarray, rank: np.ndarray, dense: np.ndarray, gram: bool):
    def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dense.shape[1] if gram else len(dense), dense.shape[1]))
        for batch in batches:
            for part in slices(batch.column("text")):
                row, place, value, rows = _matrix(_coded(part), weights)
                if rows:
                    seen = _times(row, place, value, rows, dense, rank)
                    if gram:
                        total += seen.T @ seen
                    else:
                        np.add.at(total, rank[place], value[:, None] * seen[row])
        some = np.flatnonzero(total.any(axis=1))
        width = dense.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1) * width, pa.int32()),
                    pa.array(total[some].ravel()),
                ),
            ],
            names=["place", "sums"],
        )

    return produce


def _summed(items: DataFrame, producer, rows: int, width: int) -> np.ndarray:
    """Partial matrices of all tasks, added up by row."""
    parts = items.select("text").mapInArrow(producer, "place bigint, sums array<double>")
    cells = parts.select("place", F.posexplode("sums").alias("at", "x"))
    sums = cells.groupBy("place", "at").agg(F.sum("x").alias("x"))
    lines = sums.groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("at", "x"))).alias("line")
    )
    out = np.zeros((rows, width))
    for r in lines.select("place", F.col("line.x").alias("x")).collect():
        out[r["place"]] = r["x"]
    return out


def basis(items: DataFrame, places: np.ndarray, weights: np.ndarray, most: int = RANK):
    """``rank`` and ``basis``: directions of the items' passages by a randomised SVD."""
    rank = np.full(WIDTH, -1, dtype=np.int64)
    rank[places] = np.arange(len(places))
    width = max(1, min(most, len(places)))
    dense = np.linalg.qr(np.random.default_rng(8).normal(size=(len(places), width)))[0]
    for _ in range(_POWER):
        product = _summed(items, _producer(weights, rank, dense, False), len(places), width)
        dense = np.linalg.qr(product)[0]
    gram = _summed(items, _producer(weights, rank, dense, True), width, width)
    _, turn = np.linalg.eigh((gram + gram.T) / 2)
    return rank, (dense @ turn[:, ::-1]).astype(np.float32)


def _item(item_id: int, text: str) -> Item | None:
    def hashed(value: str) -> np.ndarray:
        part = next(slices(pa.array([value], pa.large_string())))
        return _coded(part).keys

    words = hashed(text)
    if not len(words):
        return None
    parts = [s for s in _SENTENCE.split(text.strip()) if s.strip()]
    answer = hashed(parts[-1])
    return Item(item_id, words, answer if len(answer) >= ANSWER_WORDS else words[-ANSWER_WORDS:])


def _rarest(items: list[Item], weights: np.ndarray):
    """For each item how many of its rarest words a leak holds, and those words' items."""
    least, keys, owners = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, item in enumerate(items):
        size = len(item.words)
        if size < LEAST:
            least.append(0)
            continue
        need = max(1, math.ceil(SHARE * size - 1e-9))
        least.append(max(1, need // 2))
        order = np.argsort(-weights[_places(item.words)], kind="stable")
        some = np.unique(item.words[order[: size - need + least[-1]]])
        keys.append(some)
        owners.append(np.full(len(some), at))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(keys, kind="stable")
    distinct, firsts = np.unique(keys[order], return_index=True)
    return np.array(least), distinct, np.append(firsts, len(keys)), owners[order]


def _runs(items: list[Item]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Items under ``LEAST`` words by their number of words: sorted hashes, and the items."""
    found = {}
    sizes = np.array([len(item.words) for item in items])
    for size in np.unique(sizes[sizes < LEAST]).tolist():
        at = np.flatnonzero(sizes == size)
        keys = np.concatenate([gram_hashes(items[i].words, size) for i in at])
        order = np.argsort(keys, kind="stable")
        found[size] = keys[order], at[order]
    return found


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; a row of zeros stays."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)


def build_index(items: DataFrame, weights: np.ndarray) -> Index | None:
    """What tasks need to find these items: at most ``ITEMS`` of them."""
    found = items.collect()
    found.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
    known = [(r, _item(r["item_id"], r["text"])) for r in found]
    known = [(r["text"], item) for r, item in known if item is not None]
    if not known:
        return None
    column = pa.array([text for text, _ in known], pa.large_string())
    vectors, owners, matrices, places = [], [], [], []
    for part in slices(column):
        coded = _coded(part)
        matrices.append((*_matrix(coded, weights),))
        owners.append(_passages(coded)[2] + part.first)
        places.append(coded.places)
    rank, dense = basis(items, np.unique(np.concatenate(places)), weights)
    found = [item for _, item in known]
    for row, place, value, rows in matrices:
        vectors.append(_times(row, place, value, rows, dense, rank))
    return Index(
        weights.astype(np.float32),
        rank,
        dense,
        dense * weights[np.flatnonzero(rank >= 0), None].astype(np.float32),
        _unit(np.concatenate(vectors)),
        np.concatenate(owners),
        found,
        np.array([len(item.words) for item in found]),
        *_rarest(found, weights),
        _runs(found),
    )


def lcs(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of whole numbers."""
    where: dict[int, int] = {}
    for i, x in enumerate(left.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(left)) - 1
    state = full
    for x in right.tolist():
        hit = state & where.get(x, 0)
        state = (state + hit | state - hit) & full
    return len(left) - state.bit_count()


def _unbroken(item: Item, near: np.ndarray, share: float = SHARE) -> bool:
    """Whether this share of the item stands in the words in one run."""
    size = len(item.words)
    run, words = math.ceil(share * size - 1e-9), near.tobytes()
    return any(item.words[i : i + run].tobytes() in words for i in range(size - run + 1))


def _paraphrase(item: Item, near: np.ndarray, weights: np.ndarray) -> bool:
    """Whether the words keep the answer in one place, and most of the item in any order."""
    mine, times = np.unique(item.words, return_counts=True)
    theirs, there = np.unique(near, return_counts=True)
    at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
    both = np.where(theirs[at] == mine, np.minimum(times, there[at]), 0)
    weight = weights[_places(mine)]
    if (both * weight).sum() < HELD * (times * weight).sum():
        return False
    size = len(item.answer)
    room = size + size // 2
    need = KEPT * size
    return any(
        lcs(item.answer, near[i : i + room]) >= need
        for i in np.flatnonzero(np.isin(near, item.answer)).tolist()
    )


def _in_runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within each run of these sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _met(at: np.ndarray, item: np.ndarray, coded: Coded, index: Index):
    """Passages with enough of an item's rarest words around them, from where these words are."""
    order = np.lexsort((at, item))
    at, item = at[order], item[order]
    row = np.searchsorted(coded.firsts, at, side="right") - 1
    last = np.arange(len(at)) + index.least[item] - 1
    end = np.minimum(last, len(at) - 1)
    whole = np.flatnonzero((last == end) & (item[end] == item) & (row[end] == row))
    low, high = at[whole] - coded.firsts[row[whole]], at[last[whole]] - coded.firsts[row[whole]]
    item, row = item[whole], row[whole]
    size = index.sizes[item]
    count = np.maximum(coded.block_firsts[row + 1] - coded.block_firsts[row] - 1, 1)
    # The passage from block j stands among the words 16 j - size to 16 j + 32 + size.
    begin = np.maximum(-((2 * BLOCK + size - high - 1) // BLOCK), 0)
    stop = np.minimum((low + size) // BLOCK, count - 1) + 1
    if len(item):
        same = (item[1:] == item[:-1]) & (row[1:] == row[:-1])
        begin[1:] = np.where(same, np.maximum(begin[1:], stop[:-1]), begin[1:])
    sizes = np.maximum(stop - begin, 0)
    passage = np.repeat(begin, sizes) + _in_runs(sizes)
    return np.repeat(row, sizes), np.repeat(item, sizes), passage


def _retrieved(coded: Coded, index: Index):
    """Row, item and passage (counted within the row) of all that are near in the latent space.

    Passages with less than ``ENERGY`` of their weight on words of the benchmark
    are no paraphrase of an item and are not projected. A passage's projection is
    the sum of its two blocks'; at unit length the norm of its vector goes out.
    """
    first, last, row = _passages(coded)
    rank, weight = index.rank[coded.places], index.weights[coded.places] ** 2
    count = coded.block_firsts[-1]
    whole = np.bincount(coded.block, weight, count)
    inside = np.bincount(coded.block, np.where(rank >= 0, weight, 0), count)
    two = first < last
    share = inside[first] + two * inside[last]
    some = np.flatnonzero(share >= ENERGY * (whole[first] + two * whole[last]))
    if not len(some):
        return
    first, last, row, two = first[some], last[some], row[some], two[some]
    wanted = np.zeros(count, dtype=bool)
    wanted[first] = wanted[last] = True
    token = np.flatnonzero((rank >= 0) & wanted[coded.block])
    place = np.cumsum(wanted) - 1
    blocks = np.zeros((int(wanted.sum()), index.basis.shape[1]), dtype=np.float32)
    begin = np.searchsorted(place[coded.block[token]], np.arange(len(blocks) + 1))
    for i in range(0, len(blocks), _PASSAGES):
        low, held = begin[i : i + _PASSAGES + 1][:-1], np.diff(begin[i : i + _PASSAGES + 1])
        for nth in range(int(held.max())):  # the nth known word of all these blocks
            have = np.flatnonzero(held > nth)
            blocks[i + have] += index.weighed[rank[token[low[have] + nth]]]
    for i in range(0, len(first), _PASSAGES):
        a, b = place[first[i : i + _PASSAGES]], place[last[i : i + _PASSAGES]]
        flat = blocks[a] + np.where(two[i : i + _PASSAGES, None], blocks[b], np.float32(0))
        at, near = np.nonzero(_unit(flat) @ index.vectors.T >= COSINE)
        nth = first[i + at] - coded.block_firsts[row[i + at]]
        found = np.stack([row[i + at], index.owners[near], nth], axis=1)
        yield from np.unique(found, axis=0).tolist()


def _candidates(coded: Coded, index: Index):
    """Row, item and passage (counted within the row) of all that may be leaks."""
    if not len(index.keys):
        return
    key = np.minimum(np.searchsorted(index.keys, coded.keys), len(index.keys) - 1)
    token = np.flatnonzero(index.keys[key] == coded.keys)
    if not len(token):
        return
    key = key[token]
    sizes = index.firsts[key + 1] - index.firsts[key]
    row = np.searchsorted(coded.firsts, token, side="right") - 1
    # Whole rows, as many as hold about ``_POSTS`` words met.
    sums = np.cumsum(sizes) - sizes
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    cuts = heads[np.flatnonzero(np.diff(sums[heads] // _POSTS, prepend=-1))]
    for first, last in zip(cuts, [*cuts[1:], len(token)], strict=True):
        some = sizes[first:last]
        posts = np.repeat(index.firsts[key[first:last]], some) + _in_runs(some)
        yield from zip(
            *(
                x.tolist()
                for x in _met(np.repeat(token[first:last], some), index.posts[posts], coded, index)
            ),
            strict=True,
        )


def _verbatim(coded: Coded, index: Index):
    """Row, item and passage where a short item stands in one run."""
    for size, (hashes, items) in index.runs.items():
        grams = gram_hashes(coded.keys, size)
        low = np.searchsorted(hashes, grams)
        sizes = np.searchsorted(hashes, grams, side="right") - low
        at = np.flatnonzero(sizes)
        row = np.searchsorted(coded.firsts, at, side="right") - 1
        inside = at + size <= coded.firsts[row + 1]
        at, row = at[inside], row[inside]
        low, sizes = low[at], sizes[at]
        item = items[np.repeat(low, sizes) + _in_runs(sizes)]
        last = np.maximum(np.diff(coded.block_firsts)[row] - 2, 0)
        passage = np.minimum((at - coded.firsts[row]) // BLOCK, last)
        found = np.stack([np.repeat(row, sizes), item, np.repeat(passage, sizes)], axis=1)
        yield from np.unique(found, axis=0).tolist()


def _cosines(coded: Coded, hits: list[tuple[int, int]], passages, index: Index) -> np.ndarray:
    """The largest cosine of each hit's passages with those of its item."""
    counts = np.array([len(p) for p in passages])
    row, item = np.repeat(np.array(hits), counts, axis=0).T
    begin = coded.firsts[row] + np.concatenate(passages) * BLOCK
    sizes = np.minimum(begin + 2 * BLOCK, coded.firsts[row + 1]) - begin
    at = np.repeat(np.arange(len(row)), sizes)
    token = np.repeat(begin, sizes) + _in_runs(sizes)
    key, count = np.unique(at * WIDTH + coded.places[token], return_counts=True)
    at, place = np.divmod(key, WIDTH)
    value = (count * index.weights[place]).astype(np.float32)
    flat = _unit(_times(at, place, value, len(row), index.basis, index.rank))
    first = np.searchsorted(index.owners, item)
    last = np.searchsorted(index.owners, item, side="right")
    near = [(index.vectors[a:b] @ v).max() for v, a, b in zip(flat, first, last, strict=True)]
    return np.maximum.reduceat(near, np.cumsum(counts) - counts).astype(np.float64)


def _finder(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for part in slices(batch.column("text")):
                coded = _coded(part)
                if not len(coded.keys):
                    continue
                best: dict[tuple[int, int], tuple[float, float, list[int]]] = {}
                tried: set[tuple[int, int, int]] = set()
                retrieved = {tuple(x) for x in _retrieved(coded, index)}
                for row, at, passage in chain(retrieved, _candidates(coded, index)):
                    item = index.items[at]
                    size = len(item.words)
                    middle = coded.firsts[row] + passage * BLOCK
                    low = max(coded.firsts[row], middle - size)
                    high = min(coded.firsts[row + 1], middle + 2 * BLOCK + size)
                    if (low, high, at) in tried:
                        continue
                    tried.add((low, high, at))
                    near = coded.keys[low:high]
                    share = lcs(item.words, near) / size
                    if share < LOOSE:
                        continue
                    answer = lcs(item.answer, near) / max(1, len(item.answer))
                    if share < SHARE:
                        leak = (
                            size >= LEAST
                            and answer >= KEPT
                            and (row, at, passage) in retrieved
                            and _paraphrase(item, near, index.weights)
                        )
                    elif size < LEAST:
                        leak = _unbroken(item, near, 1.0)
                    else:
                        leak = share >= SURE or answer >= ANSWER or _unbroken(item, near)
                    if leak:
                        known = best.get((row, at), (0.0, 0.0, []))
                        if (share, answer) > known[:2]:
                            best[row, at] = (share, answer, [passage])
                        elif (share, answer) == known[:2]:
                            known[2].append(passage)
                for row, at, passage in _verbatim(coded, index):
                    best.setdefault((row, at), (1.0, 1.0, []))[2].append(passage)
                if best:
                    rows = pa.array([part.first + r for r, _ in best])
                    share, answer, passages = zip(*best.values(), strict=True)
                    cosine = _cosines(coded, list(best), passages, index)
                    ids = [index.items[at].item_id for _, at in best]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(rows),
                            batch.column("text_hash").take(rows),
                            pa.array(ids, pa.int64()),
                            pa.array(cosine, pa.float64()),
                            pa.array(share, pa.float64()),
                            pa.array(answer, pa.float64()),
                        ],
                        names=[
                            "doc_id", "text_hash", "item_id", "cosine", "lcs_share", "answer_share",
                        ],
                    )

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """One row per document and item that it holds, with ``cosine`` and both shares."""
    spark = docs.sparkSession
    weights = idf_weights(docs) if weights is None else weights
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    blocks = -(-items.count() // (ITEMS // 2))  # so that a hash's uneven blocks stay below
    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    found = spark.createDataFrame([], _HITS)
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        index = build_index(items.where(mine), weights)
        if index is not None:
            shared = spark.sparkContext.broadcast(index)
            found = found.union(rows.mapInArrow(_finder(shared), _HITS))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item; all their columns are kept."""
    found = written(leaks(docs, benchmark), "leaks")
    bad = found.select(
        F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_text")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_leak_id")) & (
        F.xxhash64(F.col("text").cast("string")) == F.col("_leak_text")
    )
    return docs.join(bad, same, "left_anti")
