"""Substring dedup over a de Bruijn graph of words, compacted by Spark joins.

The graph's edges are the windows of ``WINDOW`` words of all texts, its nodes
the runs of one word less that a window begins and ends with. Only edges that
occur in several documents matter, and they are never all sent:

1. Each text falls into stretches: neighbouring windows that share a minimizer,
   the word run of ``RUN`` words with the smallest hash inside a window. Equal
   windows have equal minimizers, so a window can repeat only if its minimizer
   does. ``repeated_minimizers`` keeps those found in two documents.
2. ``stretches`` sends only the stretches of repeated minimizers, with the nodes
   they pass. A Bloom filter of fixed size thins them where the text is read.
3. ``resolve`` looks at each minimizer. If all its stretches pass the same nodes,
   they are one path, whose source is the first of them. The others' edges are
   told apart: ``edges`` joins every edge with its first document and place.
4. ``paths`` compacts: edges of a stretch that follow each other there and in
   their source document become one run, a join gives every document its runs,
   and runs that go on from each other in the document and in the source join
   up. Where the graph branches, the source changes and the path ends.
5. ``remove`` drops the covered words. Every compacted path and its place in the
   source document are both read again, and their words' digests must agree.
   Texts that a second filter knows to have no path are finished where they are
   read and never move.

An edge is repeated for a document if its first document has a smaller id.

Defined cases: a null text has no words; rows that repeat a ``doc_id`` are each
judged against smaller ids only; rows without an id come after all others; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import bit_filter, in_filter, texts, written
from pactline.llm.words import find_words, gram_hashes, signed, slices, span_hashes

WINDOW = 13
RUN = 5
_LAST = 2**63 - 1


def _identified(docs: DataFrame) -> DataFrame:
    """``rank`` (the id, none last) and ``row`` (of id and text) beside id and text."""
    return texts(docs).select(
        "doc_id",
        "text",
        F.coalesce("doc_id", F.lit(_LAST)).alias("rank"),
        F.xxhash64("doc_id", "text").alias("row"),
    )


def _minimizers(hashes: np.ndarray, row: np.ndarray, window: int):
    """First window, number of windows, row and minimizer of every stretch."""
    count = len(hashes) - window + 1
    if count <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    run = min(RUN, window)
    least, have = gram_hashes(hashes, run), 1
    while have < window - run + 1:
        step = min(have, window - run + 1 - have)
        least, have = np.minimum(least[:-step], least[step:]), have + step
    least = least[:count]
    inside = row[:count] == row[window - 1 :]
    new = np.ones(count, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:count] != row[: count - 1])
    starts = np.flatnonzero(new & inside)
    # A stretch ends where the next begins or where its text has no window left.
    edge = np.append(np.flatnonzero(new | ~inside), count)
    ends = edge[np.searchsorted(edge, starts, side="right")]
    return starts, ends - starts, row[starts], least[starts]


def _finder(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                words = find_words(part)
                hashes = span_hashes(part.data, words.starts, words.ends)
                _, _, row, least = _minimizers(hashes, words.rows, window)
                both, at = np.unique(least, return_index=True)
                # Of equal ones in a slice the smallest and the largest document say all.
                rank = batch.column("rank").to_numpy()[part.first + row]
                low, high = np.full(len(both), _LAST), np.full(len(both), -(2**63))
                place = np.searchsorted(both, least)
                np.minimum.at(low, place, rank)
                np.maximum.at(high, place, rank)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(both)), pa.array(low), pa.array(high)],
                    names=["key", "low", "high"],
                )

    return find


def repeated_minimizers(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key``: the minimizers found in at least two documents."""
    found = docs.select("text", "rank").mapInArrow(
        _finder(window), "key bigint, low bigint, high bigint"
    )
    ends = found.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return ends.where("low < high").select("key")


_STRETCH = "key bigint, rank bigint, row bigint, first int, size int, nodes binary"


def _sender(window: int, shared):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ranks, rows = (batch.column(c).to_numpy() for c in ("rank", "row"))
            for part in slices(batch.column("text")):
                words = find_words(part)
                hashes = span_hashes(part.data, words.starts, words.ends)
                starts, sizes, row, least = _minimizers(hashes, words.rows, window)
                hit = in_filter(bits, least)
                starts, sizes, row, least = starts[hit], sizes[hit], row[hit], least[hit]
                if not len(starts):
                    continue
                nodes = (gram_hashes(hashes, window - 1) >> np.uint64(32)).astype("<u4")
                cuts = np.concatenate([[0], np.cumsum(sizes + 1)])
                at = np.repeat(starts - cuts[:-1], sizes + 1) + np.arange(cuts[-1])
                packed = pa.BinaryArray.from_buffers(
                    pa.binary(),
                    len(sizes),
                    [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(nodes[at])],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(least)),
                        pa.array(ranks[part.first + row]),
                        pa.array(rows[part.first + row]),
                        pa.array((starts - words.firsts[row]).astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                        packed,
                    ],
                    names=["key", "rank", "row", "first", "size", "nodes"],
                )

    return send


def stretches(docs: DataFrame, keys: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stretches of repeated minimizers (and of a few others that pass the filter).

    ``key``, the document (``rank``, ``row``), its first window, their number and
    the nodes passed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(keys))
    rows = docs.select("text", "rank", "row")
    return rows.mapInArrow(_sender(window, shared), _STRETCH)


def _source() -> Column:
    return F.min(F.struct("rank", "row", "first")).alias("s")


def resolve(found: DataFrame) -> DataFrame:
    """Each stretch of a repeated minimizer with its source, if that is plain.

    Where all stretches of a minimizer pass the same nodes, ``nodes`` is null and
    the source is the first of them; the first itself is left out.
    """
    digest = F.xxhash64("nodes")
    known = (
        found.groupBy("key")
        .agg(
            (F.min(digest) == F.max(digest)).alias("alone"),
            _source(),
            F.max("rank").alias("high"),
        )
        .where("s.rank < high")
        .select(
            "key",
            "alone",
            F.col("s.rank").alias("low"),
            F.col("s.row").alias("source"),
            F.col("s.first").alias("source_first"),
        )
    )
    rows = found.join(written(known, "minimizers"), "key")
    plain = F.col("alone")
    return rows.where(~plain | (F.col("low") < F.col("rank"))).select(
        "rank",
        "row",
        "first",
        "size",
        F.when(plain, F.col("source")).alias("source"),
        F.when(plain, F.col("source_first")).alias("source_first"),
        F.when(~plain, F.col("key")).alias("key"),
        F.when(~plain, F.col("nodes")).alias("nodes"),
    )


_EDGE = (
    "class bigint, key bigint, place int, left bigint, right bigint, rank bigint, row bigint, "
    "at int, high bigint"
)


def _unpacker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column("nodes").cast(pa.large_binary())
        offsets = np.frombuffer(nodes.buffers()[1], np.int64)
        offsets = offsets[nodes.offset : nodes.offset + len(nodes) + 1]
        flat = np.frombuffer(b"".join(nodes.to_pylist()), "<u4").astype(np.int64)
        cuts = (offsets - offsets[0]) // 4
        sizes = np.diff(cuts) - 1
        which = np.repeat(np.arange(len(sizes)), sizes)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = cuts[:-1][which] + nth
        rows = pa.array(which)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("class").take(rows),
                batch.column("key").take(rows),
                pa.array(nth.astype(np.int32)),
                pa.array(flat[left]),
                pa.array(flat[left + 1]),
                batch.column("rank").take(rows),
                batch.column("row").take(rows),
                pa.array((batch.column("first").to_numpy()[which] + nth).astype(np.int32)),
                batch.column("high").take(rows),
            ],
            names=["class", "key", "place", "left", "right", "rank", "row", "at", "high"],
        )


def edges(classes: DataFrame) -> DataFrame:
    """The classes' edges that start in a smaller document, with their ``source``."""
    windows = classes.mapInArrow(_unpacker, _EDGE)
    source = F.min(F.struct("rank", "row", "at")).alias("source")
    known = windows.groupBy("key", "left", "right").agg(source, F.max("high").alias("most"))
    known = known.where("source.rank < most").drop("most")
    found = windows.select("class", "key", "place", "left", "right", "high").join(
        known, ["key", "left", "right"]
    )
    return found.where("source.rank < high").select("class", "place", "source.*")


_RUNS = "array<struct<place: int, size: int, rank: bigint, row: bigint, at: int>>"


def _told_apart(stretch: DataFrame) -> DataFrame:
    """Runs of the stretches whose minimizer has several contexts."""
    stretch = stretch.withColumn("class", F.xxhash64("key", "nodes"))
    classes = stretch.groupBy("class", "key", "nodes").agg(_source(), F.max("rank").alias("high"))
    classes = classes.select("class", "key", "nodes", "s.*", "high")
    item = F.struct("place", "rank", "row", "at")
    lines = edges(classes).groupBy("class").agg(F.sort_array(F.collect_list(item)).alias("line"))
    runs = lines.mapInArrow(_compact, f"class bigint, runs {_RUNS}")
    placed = stretch.select("class", "rank", "row", "first").join(runs, "class")
    placed = placed.select(F.col("rank").alias("_rank"), "row", "first", F.explode("runs").alias("run"))
    return placed.where("run.rank < _rank").select(
        "row",
        (F.col("first") + F.col("run.place")).alias("first"),
        F.col("run.size").alias("size"),
        F.col("run.row").alias("source"),
        F.col("run.at").alias("source_first"),
    )


def paths(resolved: DataFrame) -> DataFrame:
    """``row``, ``first``, ``size`` (windows), ``source``, ``source_first``: repeated paths.

    ``resolved`` are the stretches from ``resolve``, in a written table.
    """
    plain = resolved.where("nodes is null").select(
        "row", "first", "size", "source", "source_first"
    )
    placed = plain.unionByName(_told_apart(resolved.where("nodes is not null")))
    line = Window.partitionBy("row", "source", F.col("source_first") - F.col("first"))
    ordered = line.orderBy("first")
    before = F.lag(F.col("first") + F.col("size")).over(ordered)
    joined = placed.withColumn("_new", F.when(before == F.col("first"), 0).otherwise(1))
    joined = joined.withColumn("_nth", F.sum("_new").over(ordered))
    shift = (F.col("source_first") - F.col("first")).alias("_shift")
    return (
        joined.select("*", shift)
        .groupBy("row", "source", "_shift", "_nth")
        .agg(F.min("first").alias("first"), F.sum("size").cast("int").alias("size"))
        .select(
            "row",
            "first",
            "size",
            "source",
            (F.col("first") + F.col("_shift")).alias("source_first"),
        )
    )


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = batch.column("line")
        flat = lines.flatten()
        columns = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in
                   ("place", "rank", "row", "at")}
        owner = np.repeat(np.arange(len(lines)), lines.value_lengths().to_numpy())
        new = np.ones(len(owner), dtype=bool)
        same = owner[1:] == owner[:-1]
        for c in ("place", "at"):
            same &= columns[c][1:] == columns[c][:-1] + 1
        new[1:] = ~(same & (columns["row"][1:] == columns["row"][:-1]))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(owner)))
        names = ("place", "size", "rank", "row", "at")
        values = [sizes.astype(np.int32) if c == "size" else columns[c][heads] for c in names]
        runs = pa.StructArray.from_arrays([pa.array(v) for v in values], names=list(names))
        cuts = np.searchsorted(owner[heads], np.arange(len(lines) + 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("class"),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
            ],
            names=["class", "runs"],
        )


_KEPT = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, "
    "checks array<struct<path: bigint, digest: string>>"
)


_READ = "doc_id bigint, row bigint, text string, n_words bigint, kept_sha256 string"


def _reader(shared):
    """Digests of texts without a path; the others keep their text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            hit = in_filter(bits, batch.column("row").to_numpy())
            texts_, counts, digests = [], [], []
            for text, later in zip(batch.column("text").to_pylist(), hit.tolist(), strict=True):
                words = [] if later else (text or "").encode().split()
                texts_.append((text or "") if later else None)
                counts.append(len(words))
                digests.append(None if later else hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(texts_, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "row", "text", "n_words", "kept_sha256"],
            )

    return read


def _remover(window: int, with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("text", "own", "asked"))
            for text, own, asked in zip(*columns, strict=True):
                words = (text or "").encode().split()
                gone, checks = np.zeros(len(words), dtype=bool), []
                for span in own or ():
                    last = span["first"] + span["size"] + window - 1
                    gone[span["first"] : last] = True
                for span in [*(own or ()), *(asked or ())]:
                    seen = words[span["first"] : span["first"] + span["size"] + window - 1]
                    digest = hashlib.md5(b" ".join(seen), usedforsecurity=False).hexdigest()
                    checks.append({"path": span["path"], "digest": digest})
                if own:
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                else:
                    kept = words
                whole = b" ".join(kept)
                out.append(
                    (
                        len(words),
                        int(gone.sum()),
                        hashlib.sha256(whole).hexdigest(),
                        whole.decode() if with_text else None,
                        checks,
                    )
                )
            n, removed, sha, kept_texts, checks = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(kept_texts, pa.string()),
                    pa.array(
                        checks,
                        pa.list_(pa.struct([("path", pa.int64()), ("digest", pa.string())])),
                    ),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "checks"],
            )

    return remove


def remove(docs: DataFrame, found: DataFrame, window: int, with_text: bool = False) -> DataFrame:
    """Texts without the covered words, each path checked against its source.

    ``docs`` as ``_identified`` makes them, ``found`` from ``paths``, written.
    """
    spark = docs.sparkSession
    path = F.xxhash64("source", "source_first", "size").alias("path")
    own = found.groupBy("row").agg(F.collect_list(F.struct("first", "size", path)).alias("own"))
    asked = found.select("source", "source_first", "size", path).distinct()
    asked = asked.groupBy(F.col("source").alias("row")).agg(
        F.collect_list(F.struct(F.col("source_first").alias("first"), "size", "path")).alias("asked")
    )
    spans = own.join(asked, "row", "full")
    if with_text:
        plain = None
        rows = docs.select("doc_id", "text", "row")
    else:
        involved = F.explode(F.array("row", "source")).alias("key")
        shared = spark.sparkContext.broadcast(bit_filter(found.select(involved)))
        read = docs.select("doc_id", "text", "row").mapInArrow(_reader(shared), _READ)
        read = written(read, "read")
        plain = read.where("text is null").select(
            "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256"
        )
        rows = read.where("text is not null").select("doc_id", "text", "row")
    rows = rows.join(spans, "row", "left").drop("row")
    kept = written(rows.mapInArrow(_remover(window, with_text), _KEPT), "kept")
    checks = kept.select(F.explode("checks").alias("c")).groupBy("c.path")
    wrong = checks.agg(
        F.min("c.digest").alias("low"), F.max("c.digest").alias("high")
    ).where("low <> high")
    if not wrong.isEmpty():
        raise RuntimeError("two different word sequences met in all hashes; change the seeds")
    kept = kept.drop("checks")
    return kept if plain is None else kept.drop("kept_text").unionByName(plain)


def deduplicate(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (and ``kept_text``) per document."""
    docs = _identified(docs)
    keys = written(repeated_minimizers(docs, window), "minimizers")
    resolved = written(resolve(stretches(docs, keys, window)), "stretches")
    return remove(docs, written(paths(resolved), "paths"), window, with_text)


ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
         unnest([array_to_string(w[j:j + 12], ' ') FOR j IN range(1, len(w) - 11)]) AS x
  FROM split WHERE len(w) >= 13
),
firsts AS (SELECT x, min(doc_id) AS first_doc FROM windows GROUP BY x),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
  FROM windows JOIN firsts USING (x) WHERE first_doc < doc_id
),
removed AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN js IS NULL THEN w
              ELSE [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(js, k)] END, ' '), ''))
         AS kept_sha256
FROM split s LEFT JOIN removed USING (doc_id)
"""
