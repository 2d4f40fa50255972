"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Every document is its ids and an end id. Longer ones are cut into pieces of
``capacity`` ids, of which the first may be shorter. Tasks encode the texts and
write one narrow row per piece, numbered within its task and length. The
histogram of lengths, at most ``capacity`` rows, decides all bins by a
configuration linear program (``configuration_lp``). Its solution is a table of
slots: so many pieces of one length go to so many sequences at one place. A
piece's rank among those of its length finds its slot; ranks are prefix sums
over tasks, so no length is gathered or sorted, however many pieces it has.

Defined cases: a null text is an empty one and holds the end id alone; rows that
repeat a ``doc_id``, or have none, are packed each on their own; an empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import texts, written
from pactline.llm.configuration_lp import Configuration, pack
from pactline.llm.encoder import encoder
from pactline.llm.words import slices

CAPACITY = 2048
_PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "task int, nth bigint"
)
_PACKED = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint"
)


def _cutter(path: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = encoder(path), np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch.column("text")):
                flat, counts = coder.encode(part)
                sizes = counts + 1
                ends = np.cumsum(sizes)
                ids = np.full(int(ends[-1]), end_id, dtype="<u4")
                own = np.ones(len(ids), dtype=bool)
                own[ends - 1] = False
                ids[own] = flat
                pieces = (sizes + capacity - 1) // capacity
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                # All pieces are full but the first, which takes what is over.
                stop = sizes[row] - (pieces[row] - 1 - piece) * capacity
                start = np.maximum(stop - capacity, 0)
                length = stop - start
                base = (ends - sizes)[row]
                sums = [
                    zlib.crc32(ids[a:b].tobytes())
                    for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)
                ]
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty_like(length)
                nth[order] = np.arange(len(row)) - np.searchsorted(ordered, ordered)
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                ids_of = batch.column("doc_id").slice(part.first, part.last - part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(row), task, dtype=np.int32)),
                        pa.array(nth),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return cut


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """One row per piece: ``start`` and ``length`` in its document, checksum of its ids.

    ``nth`` numbers the pieces of one length within ``task``.
    """
    return texts(docs).mapInArrow(_cutter(tokenizer, end_id, capacity), _PIECES)


def slots(bins: list[tuple[Configuration, int]]) -> np.ndarray:
    """Columns length, first rank, first sequence, sequences, place; in order of rank."""
    rows, taken, sequence = [], {}, 0
    for lengths, times in bins:
        place = 0
        for length, copies in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, times, place))
            taken[length] = rank + times * copies
            place += length * copies
        sequence += times
    out = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _placer(table: np.ndarray, capacity: int):
    bounds = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(length), dtype=np.int64)
            for n in np.unique(length).tolist():
                here = length == n
                ranks = table[bounds[n] : bounds[n + 1], 1]
                at[here] = bounds[n] + np.searchsorted(ranks, rank[here], side="right") - 1
            _, first, sequence, times, offset = table[at].T
            copy, bin_ = np.divmod(rank - first, times)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(sequence + bin_),
                    pa.array(offset + copy * length),
                ],
                names=[
                    "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                ],
            )

    return place


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    The driver holds the histogram (``capacity`` rows at most) and the slots,
    whose number depends on the lengths there are and not on the documents.
    """
    cut = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counted = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("_count"))
    found = counted.groupBy("length").agg(F.sum("_count").alias("n")).toArrow()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    histogram[found.column("length").to_numpy()] = found.column("n").to_numpy()
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counted.select(
        "task", "length", F.coalesce(F.sum("_count").over(ahead), F.lit(0)).alias("_base")
    )
    ranked = cut.join(bases, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("_base")).alias("rank")
    )
    table = slots(pack(histogram, capacity))
    return ranked.mapInArrow(_placer(table, capacity), _PACKED)
