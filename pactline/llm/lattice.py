"""Probabilities of words summed over all their segmentations into given pieces.

A word is its bytes after a mark for its beginning. The pieces are those of a
public vocabulary that hold no mark inside, and all single bytes, so any word
has a segmentation. Words of one length go through the recursions together.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

MARK = b"\xff"  # no byte of UTF-8 text
_LOW = -1e30


class Pieces(NamedTuple):
    """The pieces as a trie, and the natural logarithm of each piece's probability.

    Nodes are numbered by depth. ``near`` has the children of the root and of its
    children for every byte (-1: none), ``edges`` all of them in order, as the
    parent's number and the byte, with ``children`` beside it; ``ends`` has the
    piece that ends at a node, or -1.
    """

    near: np.ndarray
    edges: np.ndarray
    children: np.ndarray
    ends: np.ndarray
    logs: np.ndarray


def _joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), offsets


def build(strings: list[bytes], weights: np.ndarray) -> Pieces:
    """Pieces with probabilities in proportion to ``weights``; no string is empty."""
    prefixes = sorted({s[:n] for s in strings for n in range(1, len(s) + 1)}, key=lambda s: (len(s), s))
    number = {b"": 0} | {s: n for n, s in enumerate(prefixes, 1)}
    edges = np.array([number[s[:-1]] << 8 | s[-1] for s in prefixes], dtype=np.int64)
    order = np.argsort(edges)
    children = np.arange(1, len(prefixes) + 1)
    ends = np.full(len(number), -1, dtype=np.int64)
    ends[[number[s] for s in strings]] = np.arange(len(strings))
    most = sum(len(s) < 2 for s in number)
    near = np.full((most, 256), -1, dtype=np.int64)
    here = (edges >> 8) < most
    near[edges[here] >> 8, edges[here] & 255] = children[here]
    return Pieces(near, edges[order], children[order], ends, np.log(weights / weights.sum()))


def load_pieces(path: str) -> Pieces:
    """The pieces of a sentencepiece file, weighed by the place they have in it.

    The order of a pair-merging vocabulary is its score; the weight falls as the
    inverse of the place.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    strings = [MARK, *(bytes([b]) for b in range(255))]
    seen = set(strings)
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        text = (MARK if piece[0] == "▁" else b"") + piece.lstrip("▁").encode()
        if "▁" not in piece[1:] and text and text == text.lower() and text not in seen:
            seen.add(text)
            strings.append(text)
    return build(strings, 1.0 / (10 + np.arange(len(strings))))


def _groups(data: np.ndarray, offsets: np.ndarray):
    """Words of one length at a time: their places and a row of bytes for each, marked."""
    sizes = np.diff(offsets)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            size = int(sizes[places[0]])
            step = max(1, (1 << 18) // (size + 1))
            for i in range(0, len(places), step):
                some = places[i : i + step]
                rows = np.full((len(some), size + 1), MARK[0], dtype=np.uint8)
                rows[:, 1:] = data[offsets[some][:, None] + np.arange(size)]
                yield some, rows


class Arcs(NamedTuple):
    """Pieces of one length in a grid of words: where they begin, which they are.

    ``logs`` has a row per first byte and a column per word, ``_LOW`` for none.
    """

    length: int
    starts: np.ndarray
    words: np.ndarray
    pieces: np.ndarray
    logs: np.ndarray


def _arcs(rows: np.ndarray, pieces: Pieces) -> list[Arcs]:
    """All pieces in the words; a place is followed only as far as a piece begins like it."""
    count, size = rows.shape
    flat, found = rows.ravel(), []
    place = np.arange(count * size)
    node = np.zeros(len(place), dtype=np.int64)
    start = place % size
    for length in range(1, size + 1):
        byte = flat[place + length - 1].astype(np.int64)
        if length <= 2:
            node = pieces.near[node, byte]
            alive = node >= 0
        else:
            edge = node << 8 | byte
            at = np.minimum(np.searchsorted(pieces.edges, edge), len(pieces.edges) - 1)
            alive = pieces.edges[at] == edge
            node = pieces.children[at]
        place, node, start = place[alive], node[alive], start[alive]
        if not len(place):
            break
        piece = pieces.ends[node]
        whole = piece >= 0
        if whole.any():
            starts, words, piece = start[whole], place[whole] // size, piece[whole]
            logs = np.full((size - length + 1, count), _LOW)
            logs[starts, words] = pieces.logs[piece]
            found.append(Arcs(length, starts, words, piece, logs))
        more = start + length < size
        place, node, start = place[more], node[more], start[more]
    return found


def _sum_logs(terms: list[np.ndarray]) -> np.ndarray:
    stack = np.stack(terms)
    top = stack.max(axis=0)
    return top + np.log(np.exp(stack - top).sum(axis=0))


def _forward(arcs: list[Arcs], count: int, size: int) -> np.ndarray:
    ahead = np.full((size + 1, count), _LOW)
    ahead[0] = 0.0
    for end in range(1, size + 1):
        ahead[end] = _sum_logs(
            [ahead[end - a.length] + a.logs[end - a.length] for a in arcs if a.length <= end]
        )
    return ahead


def _backward(arcs: list[Arcs], count: int, size: int) -> np.ndarray:
    behind = np.full((size + 1, count), _LOW)
    behind[size] = 0.0
    for start in range(size - 1, -1, -1):
        behind[start] = _sum_logs(
            [behind[start + a.length] + a.logs[start] for a in arcs if start + a.length <= size]
        )
    return behind


def word_logs(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Natural log of each word's probability, over all segmentations."""
    out = np.zeros(len(offsets) - 1)
    for some, rows in _groups(data, offsets):
        out[some] = _forward(_arcs(rows, pieces), *rows.shape)[-1]
    return out


def expected_counts(
    data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, pieces: Pieces
) -> np.ndarray:
    """How often each piece is expected in the words, under the pieces' probabilities."""
    total = np.zeros(len(pieces.logs))
    for some, rows in _groups(data, offsets):
        count, size = rows.shape
        arcs = _arcs(rows, pieces)
        ahead, behind = _forward(arcs, count, size), _backward(arcs, count, size)
        whole = ahead[size]
        for a in arcs:
            share = ahead[a.starts, a.words] + pieces.logs[a.pieces]
            share += behind[a.starts + a.length, a.words] - whole[a.words]
            total += np.bincount(
                a.pieces, weights=np.exp(share) * weights[some][a.words], minlength=len(total)
            )
    return total


def from_counts(pieces: Pieces, counts: np.ndarray) -> Pieces:
    """The pieces with probabilities in proportion to counts; none becomes impossible."""
    counts = counts + 0.01
    return pieces._replace(logs=np.log(counts / counts.sum()))
