"""Document probability under a subword lattice, learned from the training documents.

1. ``word_counts``: every training word and its count (one row per word).
2. Pieces come from a public vocabulary, which is not trained. Its file orders
   the pieces; that order is the first weight of each. Expectation-maximisation
   over all segmentations turns the weights into probabilities, in ``ROUNDS``
   rounds over every training word. A word counts once there, as the lattice spells words that are new or rare.
3. A word's probability is the lattice's sum over all its arcs: one whole-word
   arc with its count less a discount, and all segmentations into pieces, which
   share what the discount frees (absolute discounting, the discount from the
   words seen once and twice). The end of a text is a word without spelling.
   The forward recursion is in log space; a document's score is the sum of the
   logs of its words and its end.

Words seen at least once in ``FREQUENT`` training tokens are ``FREQUENT`` at
most; they are scored where the text is read. All rarer words meet their counts
in a join, where no word has more than that share of the training rows.

Defined cases: null counts as an empty text, which has its end alone; without a
training document every word is spelled and an end has probability one half;
rows that repeat a ``doc_id`` are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm import lattice
from pactline.llm.common import texts, written
from pactline.llm.words import Slice, SpanHasher, find_words, slices

FREQUENT = 1 << 16
ROUNDS = 9
_GATHERED = 1 << 16  # words a task works on at once
_HELD = 500_000  # distinct words a task gathers before it sends them

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123]


class Model(NamedTuple):
    counts: DataFrame
    frequent: list[tuple[bytes, int]]
    tokens: int
    words: int
    ends: int
    discount: float
    pieces: lattice.Pieces


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of bytes, A-Z folded, as an Arrow column of text."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_FOLD[data[places]])
    )


def _distinct(part: Slice):
    found = find_words(part)
    keys = SpanHasher(part.data, fold=True)(found.starts, found.ends)
    keys, sample, which, counts = np.unique(
        keys, return_index=True, return_inverse=True, return_counts=True
    )
    return found, keys, sample, which, counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def merged() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
        rows = rows.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()
        return rows.to_batches()[0]

    for batch in batches:
        for part in slices(batch.column("text")):
            found, _, sample, _, counts = _distinct(part)
            if len(counts):
                words = _strings(part.data, found.starts[sample], found.ends[sample])
                held.append(pa.RecordBatch.from_arrays([words, pa.array(counts)], ["word", "n"]))
                size += len(counts)
            if size > _HELD:
                held, size = [merged()], 0
                if held[0].num_rows > _HELD // 2:
                    yield _plain(held.pop())
    if held:
        yield _plain(merged())


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("word").cast(pa.string()), batch.column("n")], ["word", "n"]
    )


def word_counts(training: DataFrame) -> DataFrame:
    """``word``, ``n``: every word of the texts, A-Z folded, and how often it occurs."""
    found = training.select("text").mapInArrow(_count_words, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    part = next(slices(column, 1 << 62), None)
    return (part.data, part.offsets) if part else (np.zeros(0, np.uint8), np.zeros(1, np.int64))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in larger batches, as words of one length are worked on together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= _GATHERED:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _expecter(pieces: lattice.Pieces):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pieces.logs))
        for batch in _gathered(batches):
            data, offsets = _bytes_of(batch.column("word"))
            total += lattice.expected_counts(data, offsets, np.ones(len(offsets) - 1), pieces)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(total[place])], names=["piece", "n"]
        )

    return expect


def learn_pieces(counts: DataFrame, path: str, rounds: int = ROUNDS) -> lattice.Pieces:
    """Probabilities of the vocabulary's pieces in the training words, all of them in every round.

    The driver receives one number per piece and round.
    """
    pieces = lattice.load_pieces(path)
    for _ in range(rounds):
        sums = counts.select("word").mapInArrow(_expecter(pieces), "piece bigint, n double")
        found = sums.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        if not found.num_rows:
            return pieces
        total = np.zeros(len(pieces.logs))
        total[found.column("piece").to_numpy()] = found.column("n").to_numpy()
        pieces = lattice.from_counts(pieces, total)
    return pieces


def train(training: DataFrame, path: str, frequent: int = FREQUENT) -> Model:
    """Learn from the texts of ``training``; ``path`` is a sentencepiece file."""
    rows = texts(training)
    counts = written(word_counts(rows), "words")
    ends = rows.count()
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("words"),
        F.count(F.when(F.col("n") == 1, 1)).alias("once"),
        F.count(F.when(F.col("n") == 2, 1)).alias("twice"),
    ).first()
    tokens, words = sums["tokens"] + ends, sums["words"] + (ends > 0)
    top = counts.where(F.col("n") * frequent >= F.lit(max(tokens, 1))).collect()
    once, twice = sums["once"], sums["twice"]
    discount = once / (once + 2 * twice) if once else 0.5
    return Model(
        counts,
        sorted((r["word"].encode(), r["n"]) for r in top),
        tokens,
        words,
        ends,
        min(max(discount, 0.1), 0.9),
        learn_pieces(counts, path),
    )


def _word_scores(n: np.ndarray, spelled: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the smoothed counts and of the lattice, for words with ``n`` training tokens."""
    base = np.log10((n + 1) / (model.tokens + model.words + 1))
    if not model.tokens:
        return base, (np.log(0.5) + spelled) / np.log(10)
    whole = np.maximum(n - model.discount, 0) / model.tokens
    free = model.discount * max(model.words, 1) / model.tokens
    with np.errstate(divide="ignore"):
        return base, np.logaddexp(np.log(whole), np.log(free) + spelled) / np.log(10)


class _Table(NamedTuple):
    """What a task needs to score frequent words where it reads them."""

    keys: np.ndarray
    base: np.ndarray
    score: np.ndarray
    end_base: float
    end_score: float


def _frequent_table(model: Model) -> _Table:
    data, offsets = lattice._joined([w for w, _ in model.frequent])
    keys = SpanHasher(data, fold=True)(offsets[:-1], offsets[1:])
    n = np.array([n for _, n in model.frequent], dtype=np.float64)
    base, score = _word_scores(n, lattice.word_logs(data, offsets, model.pieces), model)
    order = np.argsort(keys)
    end = np.log10((model.ends + 1) / (model.tokens + model.words + 1))
    if model.ends:
        end_score = np.log10((model.ends - model.discount) / model.tokens)
    else:
        end_score = np.log10(0.5)
    return _Table(keys[order], base[order], score[order], float(end), float(end_score))


_SPLIT = (
    "row bigint, doc_id bigint, word string, n bigint, known bigint, base double, score double"
)


def _splitter(found: _Table, end_known: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch.column("text")):
                words, keys, sample, which, _ = _distinct(part)
                rows = part.last - part.first
                ids = batch.column("doc_id").slice(part.first, rows)
                at = np.minimum(np.searchsorted(found.keys, keys), max(len(found.keys) - 1, 0))
                common = found.keys[at] == keys if len(found.keys) else np.zeros(len(keys), bool)
                owner = words.rows
                mine = common[which]
                place = at[which[mine]]
                known = np.bincount(owner[mine], minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(rows)),
                        ids,
                        pa.nulls(rows, pa.string()),
                        pa.array(known + 1),
                        pa.array(known + end_known),
                        pa.array(
                            np.bincount(owner[mine], found.base[place], rows) + found.end_base
                        ),
                        pa.array(
                            np.bincount(owner[mine], found.score[place], rows) + found.end_score
                        ),
                    ],
                    names=["row", "doc_id", "word", "n", "known", "base", "score"],
                )
                pairs, n = np.unique(
                    owner[~mine] * len(keys) + which[~mine], return_counts=True
                )
                if len(pairs):
                    owner, word = np.divmod(pairs, len(keys))
                    spelled = _strings(
                        part.data, words.starts[sample[word]], words.ends[sample[word]]
                    )
                    none = pa.nulls(len(n), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row + owner),
                            pa.nulls(len(n), pa.int64()),
                            spelled.cast(pa.string()),
                            pa.array(n),
                            pa.nulls(len(n), pa.int64()),
                            none,
                            none,
                        ],
                        names=["row", "doc_id", "word", "n", "known", "base", "score"],
                    )
                row += rows

    return split


def _speller(model: Model):
    fixed = model._replace(counts=None, frequent=[])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            data, offsets = _bytes_of(batch.column("word"))
            n = batch.column("seen").to_numpy()
            logs = lattice.word_logs(data, offsets, fixed.pieces)
            base, score = _word_scores(n.astype(np.float64), logs, fixed)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    pa.array((n > 0).astype(np.int64)),
                    pa.array(base),
                    pa.array(score),
                ],
                names=["word", "word_known", "word_base", "word_score"],
            )

    return spell


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    table = _frequent_table(model)
    split = written(
        texts(docs).mapInArrow(_splitter(table, int(model.ends > 0)), _SPLIT), "tokens"
    )
    rare = split.where("word is not null").select("row", "word", "n")
    spelled = (
        rare.select("word")
        .distinct()
        .join(model.counts.withColumnRenamed("n", "seen"), "word", "left")
        .select("word", F.coalesce("seen", F.lit(0)).alias("seen"))
        .mapInArrow(
            _speller(model),
            "word string, word_known bigint, word_base double, word_score double",
        )
    )
    scored = rare.join(spelled, "word").groupBy("row").agg(
        F.sum("n").alias("_n"),
        F.sum(F.col("n") * F.col("word_known")).alias("_known"),
        F.sum(F.col("n") * F.col("word_base")).alias("_base"),
        F.sum(F.col("n") * F.col("word_score")).alias("_score"),
    )
    zero = F.lit(0)
    whole = split.where("word is null").join(scored, "row", "left")
    return whole.select(
        "doc_id",
        (F.col("n") + F.coalesce("_n", zero)).alias("n_tokens"),
        (F.col("known") + F.coalesce("_known", zero)).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("_score", zero)).alias("score"),
    )
