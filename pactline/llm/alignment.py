"""Alignment of two tokenizers over the same text by pointer jumping.

Tokenizer A is byte-level BPE over a space and the text, B is sentencepiece over
the text (which adds the space itself). Both must give the bytes back, so their
tokens are two divisions of one run of bytes. Every token points to the token of
the other side that overlaps it and reaches farthest to the right; a token of A
that ends where a token of B ends points to itself. Doubling the pointers until
nothing moves brings every token to the last one of its component, which names
its group.

Texts fall into chunks at every space after a character that is no white space.
Both tokenizers always divide there, so a chunk's alignment does not depend on
its neighbours; a worker aligns each different chunk once and remembers it in
bounded memory. Texts with white space outside ASCII are one chunk.

A link is an overlapping pair of tokens. How many documents hold a pair of ids
is counted over the corpus from the documents' distinct pairs, in the map tasks
first. The pairs most documents hold, ``HEAD`` at most, go to all tasks; rows of
the others, which are in few documents each, meet their counts in a join. So no
pair is a hot key, and no table grows in the tasks.

Defined cases: texts that are null, empty, or that a tokenizer does not give
back byte for byte (U+2581 in the text) have no tokens: zeros, and '' instead of
a digest. Rows that repeat a ``doc_id``, or have none, are documents of their
own. An empty table gives an empty result. Columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import texts, written
from pactline.llm.encoder import wide_spaced
from pactline.llm.words import SPACE, Slice, slices, span_hashes

# Pairs of ids that are sent to all tasks at most: 20 MB.
HEAD = 1 << 20
# Bytes of aligned chunks a worker remembers; it starts anew beyond that.
REMEMBERED = 48 << 20
# Bits of an id of B in a pair's number; rows of a batch take what is left above.
_BITS = 26

_ROWS = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, links array<bigint>"
)
_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """This worker's aligner for two tokenizer files."""
    key = byte_path, piece_path
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def _byte_letters() -> dict[str, int]:
    """The letters byte-level BPE writes bytes with: printable ones, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Pool(NamedTuple):
    """Byte strings one after another."""

    data: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, items: list[bytes]) -> Pool:
        sizes = np.fromiter(map(len, items), np.int64, len(items))
        return cls(
            np.frombuffer(b"".join(items), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        )

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings ``at`` as one run of bytes, and their sizes."""
        first, sizes = self.begins[at], self.begins[at + 1] - self.begins[at]
        return self.data[runs(first, sizes)], sizes


def runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``sizes`` many."""
    ahead = np.cumsum(sizes) - sizes
    return np.repeat(first - ahead, sizes) + np.arange(int(sizes.sum()))


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the token of A its component ends with.

    Both sides divide the same bytes; ``ends`` are where their tokens end.
    """
    count = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    last = ends_b[over_a] == ends_a
    point = np.concatenate([np.where(last, np.arange(count), count + over_a), over_b])
    while True:
        further = point[point]
        if np.array_equal(further, point):
            return point[:count], point[count:]
        point = further


def overlaps(
    ends_a: np.ndarray, sizes_a: np.ndarray, ends_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a token of A and a token of B that share a byte."""
    first = np.searchsorted(ends_b, ends_a - sizes_a, side="right")
    count = np.searchsorted(ends_b, ends_a) - first + 1
    return np.repeat(np.arange(len(ends_a)), count), runs(first, count)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` consecutive values each."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = Pool.of([bytes(letters.get(c, 0) for c in name) for name in names])
        pieces = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                pieces.append(bytes([int(piece[3:-1], 16)]))
            else:
                pieces.append(piece.replace("▁", " ").encode())
        self.bytes_b = Pool.of(pieces)
        self.space = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.proofs = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int64)
        # Tokens of A and of B, groups, links (0 tokens: not given back) of every chunk.
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.begins = np.zeros(1, dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.strings: list[bytes] = []
        self.held = 0

    def _tokens(self, chunks: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Flat ids and counts per chunk of both tokenizers."""
        texts_ = [c.decode() for c in chunks]
        found_a = [e.ids for e in self.a.encode_batch_fast(texts_, add_special_tokens=False)]
        found_b = self.b.encode([t[1:] for t in texts_], num_threads=1)
        flat, counts = [], []
        # Nothing is no text to B, but a last space is a piece.
        found_b = [ids or [self.space] for ids in found_b]
        for found in (found_a, found_b):
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            counts.append(sizes)
            flat.append(np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())))
        return flat, counts

    def align(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Counts, pairs of all links, and groups as text, of chunks that start with a space."""
        (ids_a, ids_b), (count_a, count_b) = self._tokens(chunks)
        data = Pool.of(chunks)
        size = np.diff(data.begins)
        good = np.ones(len(chunks), dtype=bool)
        sizes = []
        for ids, counts, pool in ((ids_a, count_a, self.bytes_a), (ids_b, count_b, self.bytes_b)):
            out, each = pool.take(ids)
            sizes.append(each)
            made = _sums(each, counts)
            good &= made == size
            # Chunks of another length are out already; the others' bytes are compared.
            same = np.flatnonzero(made == size)
            at = np.repeat(same, size[same])
            mine = out[runs((np.cumsum(made) - made)[same], size[same])]
            differ = mine != data.data[runs(data.begins[same], size[same])]
            good[at[differ]] = False
        keep_a, keep_b = np.repeat(good, count_a), np.repeat(good, count_b)
        ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
        size_a, size_b = sizes[0][keep_a], sizes[1][keep_b]
        count_a, count_b = np.where(good, count_a, 0), np.where(good, count_b, 0)
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        last_a, last_b = terminals(ends_a, ends_b)
        link_a, link_b = overlaps(ends_a, size_a, ends_b)
        pairs = (ids_a[link_a] << _BITS) | ids_b[link_b]
        chunk_a = np.repeat(np.arange(len(chunks)), count_a)
        own = last_a == np.arange(len(last_a))
        counts = np.stack(
            [
                count_a,
                count_b,
                np.bincount(chunk_a[own], minlength=len(chunks)),
                np.bincount(chunk_a[link_a], minlength=len(chunks)),
            ],
            axis=1,
        )
        return counts, pairs, _groups(counts, ids_a, ids_b, last_a, last_b)

    def _learn(self, keys: np.ndarray, proofs: np.ndarray, chunks: list[bytes]) -> None:
        if self.held > REMEMBERED:
            self._forget()
        counts, pairs, strings = self.align(chunks)
        at = np.searchsorted(self.keys, keys)
        places = np.arange(len(keys)) + len(self.strings)
        self.keys = np.insert(self.keys, at, keys)
        self.proofs = np.insert(self.proofs, at, proofs)
        self.places = np.insert(self.places, at, places)
        self.counts = np.concatenate([self.counts, counts])
        self.begins = np.append(self.begins, self.begins[-1] + np.cumsum(counts[:, 3]))
        self.pairs = np.append(self.pairs, pairs)
        self.strings += strings
        # 64 bytes of numbers a chunk, some 40 of a bytes object and its place.
        self.held += sum(map(len, strings)) + 104 * len(strings) + pairs.nbytes

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        return at, known

    def places_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where this worker remembers each chunk; what is new is aligned first."""
        keys, proofs = span_hashes(data, starts, ends), span_hashes(data, starts, ends, lane=1)
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)

        def learn(at: np.ndarray) -> None:
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            self._learn(keys[at], proofs[at], [buffer[a:b] for a, b in spans])

        _, known = self._find(distinct)
        if not known.all():
            buffer = data.tobytes()
            learn(sample[~known])
            if not self._find(distinct)[1].all():  # memory was cleared: learn the whole slice
                self._forget()
                learn(sample)
        at = self._find(distinct)[0][which]
        if (self.proofs[at] != proofs).any():  # hashes met: every chunk on its own
            self._forget()
            buffer = data.tobytes()
            counts, pairs, self.strings = self.align(
                [buffer[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            )
            self.counts, self.pairs = counts, pairs
            self.begins = np.concatenate([[0], np.cumsum(counts[:, 3])])
            self.held = REMEMBERED + 1
            return np.arange(len(starts))
        return self.places[at]

    def documents(self, part: Slice) -> Documents:
        """Counts, groups and links of every row of a slice of texts."""
        rows = part.last - part.first
        sizes = np.diff(part.offsets)
        # A space before every text.
        offsets = part.offsets + np.arange(rows + 1)
        data = np.full(int(offsets[-1]), 32, dtype=np.uint8)
        filled = np.ones(len(data), dtype=bool)
        filled[offsets[:-1]] = False
        data[filled] = part.data
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = (data[1:] == 32) & ~SPACE[data[:-1]]
        for r in wide_spaced(part):
            begins[offsets[r] : offsets[r + 1]] = False
        begins[offsets] = True
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(offsets, starts, side="right") - 1
        some = sizes[row] > 0
        starts, ends, row = starts[some], ends[some], row[some]

        place = self.places_of(data, starts, ends)
        counts = self.counts[place]
        lossless = sizes > 0
        lossless[row[counts[:, 0] == 0]] = False
        keep = lossless[row]
        place, row, counts = place[keep], row[keep], counts[keep]
        total = np.stack(
            [np.bincount(row, weights=counts[:, i], minlength=rows) for i in range(4)], axis=1
        ).astype(np.int64)
        bounds = np.searchsorted(row, np.arange(rows + 1))
        digests, strings, at = [], self.strings, place.tolist()
        for r in range(rows):
            if lossless[r]:
                groups = b";".join([strings[i] for i in at[bounds[r] : bounds[r + 1]]])
                digests.append(hashlib.sha256(groups).hexdigest())
            else:
                digests.append("")
        links = self.pairs[runs(self.begins[place], counts[:, 3])]
        keys = np.sort(links | (np.repeat(row, counts[:, 3]) << (2 * _BITS)))
        edge = np.ones(len(keys), dtype=bool)
        edge[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(edge)
        keys = keys[first]
        return Documents(
            total,
            digests,
            keys & ((1 << 2 * _BITS) - 1),
            np.diff(np.append(first, len(edge))),
            np.searchsorted(keys >> (2 * _BITS), np.arange(rows + 1)),
        )


class Documents(NamedTuple):
    """What the rows of a slice hold; row ``i`` has pairs ``bounds[i]`` to ``bounds[i + 1]``."""

    counts: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    links: np.ndarray
    bounds: np.ndarray


def _groups(
    counts: np.ndarray,
    ids_a: np.ndarray,
    ids_b: np.ndarray,
    last_a: np.ndarray,
    last_b: np.ndarray,
) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every chunk, from the component each token is in."""
    text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    group = np.flatnonzero(last_a == np.arange(len(last_a)))
    stops_a = np.searchsorted(last_a, group, side="right").tolist()
    stops_b = np.searchsorted(last_b, group, side="right").tolist()
    out, a, b, g = [], 0, 0, 0
    for n in counts[:, 2].tolist():
        parts = []
        for i in range(g, g + n):
            stop_a, stop_b = stops_a[i], stops_b[i]
            parts.append(f"{','.join(text_a[a:stop_a])}|{','.join(text_b[b:stop_b])}")
            a, b = stop_a, stop_b
        out.append(";".join(parts).encode())
        g += n
    return out


def _reader(byte_path: str, piece_path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, first = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch.column("text")):
                rows = part.last - part.first
                found = worker.documents(part)
                bounds = pa.array(found.bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(first, first + rows)),
                        batch.column("doc_id").slice(part.first, rows),
                        *(pa.array(found.counts[:, i]) for i in range(4)),
                        pa.array(found.digests, pa.string()),
                        pa.ListArray.from_arrays(bounds, pa.array(found.pairs)),
                        pa.ListArray.from_arrays(bounds, pa.array(found.links)),
                    ],
                    names=[
                        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                        "groups_sha256", "pairs", "links",
                    ],
                )
                first += rows

    return read


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per document: counts, digest of its groups, distinct pairs and their links."""
    return texts(docs).mapInArrow(_reader(byte_path, piece_path), _ROWS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (id of A above ``_BITS`` bits of B), ``docs`` that hold it, whether it is ``best``.

    The best pairs of an id of A are those that most documents hold. There are
    as many rows as pairs of ids that ever overlap, far fewer than links.
    """
    pairs = aligned.select(F.explode("pairs").alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counted = written(counted, "pairs")
    first = F.shiftright("pair", _BITS)
    most = counted.groupBy(first.alias("_a")).agg(F.max("docs").alias("_most"))
    return counted.join(most, first == F.col("_a")).select(
        "pair", "docs", (F.col("docs") == F.col("_most")).alias("best")
    )


def frequent(pairs: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs are in as many documents."""
    level = F.floor(F.log2(F.col("docs").cast("double"))).cast("int")
    sizes = pairs.groupBy(level.alias("level")).count().collect()  # 63 rows at most
    held = 0
    for row in sorted(sizes, reverse=True):
        held += row["count"]
        if held > most:
            return 1 << (row["level"] + 1)
    return 1


def _lookup(keys: np.ndarray, docs: np.ndarray, best: np.ndarray, others: bool):
    """Sums over the pairs of ``keys``, or the rows of all other pairs."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            pairs = batch.column("pairs").flatten().to_numpy()
            links = batch.column("links").flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)
            if others:
                row = np.repeat(batch.column("row").to_numpy(), sizes)
                columns = [row[~known], pairs[~known], links[~known]]
                yield pa.RecordBatch.from_arrays(
                    list(map(pa.array, columns)), names=["row", "pair", "links"]
                )
                continue
            weight = np.where(known, links, 0)
            here = [
                _sums(weight * table[at] if len(keys) else weight, sizes) for table in (best, docs)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in _KEPT), *map(pa.array, here)],
                names=[*_KEPT, "n_best", "count_sum"],
            )

    return look


_KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def score(aligned: DataFrame, pairs: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` over its links instead of the pairs."""
    least = frequent(pairs, head)
    top = pairs.where(F.col("docs") >= least).toArrow().sort_by("pair")  # ``head`` rows at most
    tables = [top.column(c).to_numpy() for c in ("pair", "docs", "best")]
    tables[2] = tables[2].astype(np.int64)
    kept = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in _KEPT)
    found = aligned.mapInArrow(
        _lookup(*tables, others=False), f"{kept}, n_best bigint, count_sum bigint"
    )
    if least > 1:
        rare = aligned.select("row", "pairs", "links").mapInArrow(
            _lookup(*tables, others=True), "row bigint, pair bigint, links bigint"
        )
        # No pair is in as many as ``least`` documents here, so none is a hot key.
        sums = (
            rare.join(pairs.where(F.col("docs") < least).hint("merge"), "pair")
            .groupBy("row")
            .agg(
                F.sum(F.col("links") * F.col("best").cast("bigint")).alias("_best"),
                F.sum(F.col("links") * F.col("docs")).alias("_sum"),
            )
        )
        found = found.join(sums, "row", "left").select(
            *_KEPT,
            (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        )
    return found


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, head: int = HEAD
) -> DataFrame:
    """Every document's groups and links, with its links' counts over the corpus."""
    aligned = written(align(docs, byte_path, piece_path), "aligned")
    pairs = written(pair_counts(aligned), "best-pairs")
    return score(aligned, pairs, head).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
