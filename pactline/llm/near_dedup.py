"""Near-duplicates: fast similarity sketches, banding, exact verification.

1. ``sketches`` turns each text into its set of word shingles (64-bit hashes)
   and the set into ``SIZE`` coordinates: in round i every shingle falls into a
   hashed place and leaves i plus a fraction there, the smallest stays; after
   ``SIZE`` rounds, round SIZE + i serves place i alone. So every coordinate is
   filled, small sets included, and the share of equal coordinates is as
   concentrated around the Jaccard similarity as independent samples would be.
   A set stops taking part once all its places are full.
2. Documents with one set (its size and a 128-bit digest) become one class.
3. ``BANDS`` bands of ``ROWS`` coordinates: classes that agree in a band share
   a bucket. At the threshold of 0.8 a pair misses every band with probability
   (1 - 0.8**ROWS)**BANDS = 1.3e-7.
4. In every bucket one class, the one that meets most others over all buckets,
   is paired with each other class: a star, never all pairs. ``verify`` confirms
   links on the full shingle sets. Linked classes become components.
5. Buckets that still hold several components are compared by their sketches in
   blocks of ``BLOCK`` rows, across components only. Documents that may link, as
   far as sketches tell, meet in groups, and those are compared on full sets,
   in blocks again. So a bucket of any size loses no link, no task holds more
   than two blocks, and a task sends a spanning forest instead of pairs.

Links are 100 * |intersection| >= percent * |union|.

Defined cases: a null text or one without words has an empty set and links with
nothing; fewer words than a shingle make one shingle of all of them. Where ids
repeat or are missing, the search is over distinct pairs of id and text: rows
with one id are one document, linked by any of its texts; every text without an
id is a document of its own, its ``component_id`` the smallest id it reaches or
null, and of a component without any id one text stays. An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import bit_filter, in_filter, texts, written
from pactline.llm.links import components
from pactline.llm.words import (
    Slice,
    find_words,
    gram_hashes,
    mix,
    signed,
    slices,
    span_hashes,
)

BANDS = 40
ROWS = 5
SIZE = BANDS * ROWS
BLOCK = 400
# Sketches of a pair at the threshold agree in fewer places with probability 1e-9.
SPREAD = 6.0

_SKETCHED = (
    "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, "
    "marks binary"
)
_OPEN = np.uint64(2**64 - 1)
_seeds = np.random.default_rng(77).integers(1, 2**63, size=4 * SIZE, dtype=np.uint64)


def shingle_sets(part: Slice, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within a row, and where each row begins."""
    found = find_words(part)
    hashes = span_hashes(part.data, found.starts, found.ends, fold=True)
    counts, rows = found.counts, len(found.firsts) - 1
    grams = gram_hashes(hashes, words)
    row = found.rows
    place = np.arange(len(hashes)) - found.firsts[row] if len(hashes) else row
    full = np.flatnonzero(place + words <= counts[row])
    keys, owner = [grams[full]], [row[full]]
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        if len(short):
            at = found.firsts[short]
            total = gram_hashes(hashes, n)[at]
            keys.append(mix(total + np.uint64(n)))
            owner.append(short)
    keys, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    if len(keys):
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(rows + 1))


def sketch(keys: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """``SIZE`` coordinates per set; an empty set has zeros."""
    sets = len(firsts) - 1
    owner = np.repeat(np.arange(sets), np.diff(firsts))
    values = keys
    out = np.full(sets * SIZE, _OPEN)
    served = np.zeros(sets * SIZE, dtype=np.uint64)
    out.reshape(sets, SIZE)[np.diff(firsts) == 0] = 0
    for i in range(2 * SIZE):
        todo = (out.reshape(sets, SIZE) == _OPEN).any(axis=1)
        if not todo.any():
            break
        if not todo.all():
            open_ = todo[owner]
            owner, values = owner[open_], values[open_]
        drawn = mix(values ^ _seeds[i]) >> np.uint64(1)
        place = owner * SIZE + (
            (drawn % np.uint64(SIZE)).astype(np.int64) if i < SIZE else i - SIZE
        )
        free = out[place] == _OPEN
        place, drawn = place[free], drawn[free]
        np.minimum.at(out, place, drawn)
        served[place] = i
    return (out ^ mix(served)).reshape(sets, SIZE)


def _sketcher(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch.column("text")):
                keys, firsts = shingle_sets(part, words)
                rows = len(firsts) - 1
                counts = np.diff(firsts)
                digests = []
                for lane in (1, 2):
                    total = np.zeros(len(keys) + 1, dtype=np.uint64)
                    np.cumsum(mix(keys ^ _seeds[-lane]), out=total[1:])
                    digests.append(signed(np.diff(total[firsts])))
                coordinates = sketch(keys, firsts)
                bands = gram_bands(coordinates) ^ mix(band * np.uint64(2) + np.uint64(1))
                marks = (mix(coordinates) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, rows),
                        pa.array(counts),
                        *map(pa.array, digests),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(rows + 1) * BANDS, pa.int32()),
                            pa.array(signed(bands.ravel())),
                        ),
                        pa.array([m.tobytes() for m in marks], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "marks"],
                )

    return run


def gram_bands(coordinates: np.ndarray) -> np.ndarray:
    """One key per band from its ``ROWS`` coordinates."""
    grouped = coordinates.reshape(len(coordinates), BANDS, ROWS)
    total = np.zeros(grouped.shape[:2], dtype=np.uint64)
    for i in range(ROWS):
        total += mix(grouped[:, :, i] + _seeds[i]) * (_seeds[ROWS + i] | np.uint64(1))
    return mix(total)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Set size, set digest, band keys and one byte per coordinate, for each document."""
    return texts(docs).mapInArrow(_sketcher(words), _SKETCHED)


def _verifier(words: int, percent: int):
    def sets_of(column: pa.Array) -> list[np.ndarray]:
        found = []
        for part in slices(column):
            keys, firsts = shingle_sets(part, words)
            found += np.split(keys, firsts[1:-1])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = sets_of(batch.column("text_a")), sets_of(batch.column("text_b"))
            keep = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                either = len(x) + len(y) - both
                keep.append(both > 0 and 100 * both >= percent * either)
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield chosen.select(["a", "b"])

    return run


def _sifter(shared):
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(shared.value, batch.column("doc_id").to_numpy())))

    return sift


def _first_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``text``. A filter of fixed size keeps most other texts out of the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(
        bit_filter(nodes.select(F.col("node").alias("key")))
    )
    wanted = nodes.select(F.col("node").alias("doc_id"))
    rows = texts(docs).where("doc_id is not null")
    rows = rows.mapInArrow(_sifter(shared), "doc_id bigint, text string")
    rows = rows.join(wanted, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("node"))
    return rows.agg(F.min("text").alias("text"))


def verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose whole shingle sets meet the threshold."""
    ends = F.explode(F.array("a", "b")).alias("node")
    whole = written(_first_texts(docs, pairs.select(ends).distinct()), "texts")
    left = whole.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = whole.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_verifier(words, percent), "a bigint, b bigint")


def _least_agreement(percent: int) -> float:
    """Equal places that sketches of a link have, but for a chance of 1e-9."""
    share = percent / 100
    return SIZE * share - SPREAD * np.sqrt(SIZE * share * (1 - share))


def _likely(percent: int):
    limit = _least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SIZE)
                for c in ("marks_a", "marks_b")
            )
            near = (one == two).sum(axis=1) >= limit
            yield batch.filter(pa.array(near)).select(["a", "b"])

    return run


def likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches do not rule out."""
    left = marks.select(F.col("node").alias("a"), F.col("marks").alias("marks_a"))
    right = marks.select(F.col("node").alias("b"), F.col("marks").alias("marks_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "marks_a", "marks_b")
    return rows.mapInArrow(_likely(percent), "a bigint, b bigint")


class _Forest:
    """Joins rows of a block; keeps an edge only where it brings two trees together."""

    def __init__(self, labels: np.ndarray):
        self.labels = np.unique(labels, return_inverse=True)[1]
        self.edges: list[tuple[int, int]] = []

    def join(self, i: int, others: np.ndarray) -> None:
        labels, at = np.unique(self.labels[others], return_index=True)
        for label, k in zip(labels, at, strict=True):
            if label != self.labels[i]:
                self.edges.append((i, int(others[k])))
                self.labels[self.labels == label] = self.labels[i]


def _edges(forest: _Forest, node: np.ndarray) -> pd.DataFrame:
    ends = np.array(forest.edges, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": node[ends[:, 0]], "b": node[ends[:, 1]]})


def _comparer(percent: int):
    limit = _least_agreement(percent)

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, one, two = key
        rows = rows.sort_values("node", kind="stable")
        marks = np.frombuffer(b"".join(rows["marks"]), np.uint8).reshape(len(rows), SIZE)
        node, root, block = (rows[c].to_numpy() for c in ("node", "root", "block"))
        forest = _Forest(np.arange(len(rows)))
        right = np.flatnonzero(block == two)
        for i in np.flatnonzero(block == one):
            other = right[root[right] != root[i]]
            if one == two:
                other = other[other > i]
            if len(other):
                forest.join(i, other[(marks[other] == marks[i]).sum(axis=1) >= limit])
        return _edges(forest, node)

    return compare


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a group (with its size ``_n``) once for each pair of blocks they belong to."""
    blocks = F.ceil(F.col("_n") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks).alias("block")
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("_other")
    names = [c for c in rows.columns if c != "_n"]
    rows = rows.select(*names, own, "_n").select(*names, "block", partner)
    one, two = F.least("block", "_other").alias("one"), F.greatest("block", "_other").alias("two")
    return rows.select(*names, "block", one, two)


def _across(members: DataFrame, roots: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Edges that join all documents of different components that may be links.

    A task compares the sketches of two blocks of a bucket and sends a spanning
    forest of the pairs that may link, so at most one edge per row.
    """
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = known.groupBy("key").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    mixed = mixed.where("_low < _high").select("key", "_n")
    rows = known.join(mixed, "key").join(marks, "node")
    return (
        _in_blocks(rows.select("key", "node", "root", "marks", "_n"))
        .groupBy("key", "one", "two")
        .applyInPandas(_comparer(percent), "a bigint, b bigint")
        .distinct()
    )


def _prover(words: int, percent: int):
    def prove(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, one, two = key
        rows = rows.sort_values("node", kind="stable")
        node, root, block = (rows[c].to_numpy() for c in ("node", "root", "block"))
        keys, firsts = [], [np.zeros(1, dtype=np.int64)]
        for part in slices(pa.array(rows["text"], pa.large_string())):
            found, cuts = shingle_sets(part, words)
            keys.append(found)
            firsts.append(cuts[1:] + firsts[-1][-1])
        keys, firsts = np.concatenate(keys), np.concatenate(firsts)
        sizes = np.diff(firsts)
        _, places = np.unique(keys, return_inverse=True)
        forest = _Forest(root)
        right = np.flatnonzero(block == two)
        inside = np.zeros(len(keys) + 1, dtype=bool)
        for i in np.flatnonzero(block == one):
            if not (forest.labels[right] != forest.labels[i]).any():
                continue
            own = places[firsts[i] : firsts[i + 1]]
            inside[own] = True
            both = np.add.reduceat(inside[places], firsts[:-1], dtype=np.int64)
            inside[own] = False
            linked = 100 * both >= percent * (sizes + sizes[i] - both)
            forest.join(i, right[linked[right]])
        return _edges(forest, node)

    return prove


def _prove(edges: DataFrame, roots: DataFrame, docs: DataFrame, words: int, percent: int):
    """Links between components among the documents that ``edges`` join, on full sets.

    Documents joined by edges are compared in blocks, each with its text, and a
    task sends a spanning forest of the links it finds.
    """
    groups = components(edges).withColumnRenamed("root", "group")
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    whole = _first_texts(docs, groups.select("node"))
    rows = groups.join(sizes, "group").join(roots, "node", "left").join(whole, "node")
    rows = rows.select("group", "node", F.coalesce("root", "node").alias("root"), "text", "_n")
    return (
        _in_blocks(rows)
        .groupBy("group", "one", "two")
        .applyInPandas(_prover(words, percent), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest document reachable), ``kept``."""
    docs = texts(docs)
    times = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if times.where("n > 1 or doc_id is null").isEmpty():
        return _by_id(docs, words, percent)
    digest = F.coalesce(F.sha2("text", 256), F.lit("")).alias("_digest")
    keyed = written(keys_of(docs.groupBy("doc_id", digest).agg(F.min("text").alias("text"))), "keyed")
    found = written(_by_id(keyed.select(F.col("_key").alias("doc_id"), "text"), words, percent), "found")
    own = keyed.select("doc_id", "_key", "_digest")
    first = own.where("doc_id is not null").groupBy("doc_id").agg(F.min("_key").alias("b"))
    same_id = own.join(first, "doc_id").select(F.col("_key").alias("a"), "b")
    near = found.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    roots = components(near.union(same_id)).withColumnRenamed("root", "_root")
    sized = found.select(F.col("doc_id").alias("_key"), "n_shingles")
    rooted = own.join(roots, F.col("_key") == F.col("node"), "left").join(sized, "_key")
    rooted = rooted.withColumn("_root", F.coalesce("_root", "_key"))
    # Keys follow the ids, so a root is the row of the smallest id.
    tops = own.select(F.col("_key").alias("_root"), F.col("doc_id").alias("component_id"))
    rooted = rooted.join(tops, "_root").select(
        F.col("doc_id").alias("_id"), "_digest", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("_key") == F.col("_root"))
        .alias("kept"),
    )
    rows = docs.select("doc_id", digest.alias("_own"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    return rows.join(rooted, same).select("doc_id", "n_shingles", "component_id", "kept")


def keys_of(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``_digest`` and more) with a ``_key`` that follows them, no id last."""
    order = F.col("doc_id").asc_nulls_last(), F.col("_digest")
    return (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_key", F.monotonically_increasing_id())
    )


def _by_id(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``near_duplicates`` where every row has an id of its own."""
    known = written(sketches(docs, words), "sketches")
    full = known.where("n_shingles > 0")
    # Equal sets have equal sketches, so any row's will do.
    classes = full.groupBy("n_shingles", "set_a", "set_b").agg(
        F.min("doc_id").alias("node"),
        F.first("bands").alias("bands"),
        F.first("marks").alias("marks"),
    )
    classes = written(classes, "classes")
    rows = classes.select("node", F.explode("bands").alias("key")).distinct()
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(rows.join(crowded, "key"), "buckets")

    popular = members.groupBy("node").agg(F.sum("n").alias("met"))
    rank = F.struct("met", (-F.col("node")).alias("least"))
    centres = (
        members.join(popular, "node")
        .groupBy("key")
        .agg((-F.max(rank)["least"]).alias("centre"))
    )
    stars = members.join(centres, "key").where("node <> centre")
    ends = F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")
    marks = classes.groupBy("node").agg(F.first("marks").alias("marks"))
    pairs = written(likely(stars.select(*ends).distinct(), marks, percent), "pairs")
    links = written(verify(pairs, docs, words, percent), "verified")
    roots = written(components(links), "roots")
    rest = written(_across(members.select("key", "node"), roots, marks, percent), "pairs")
    if not rest.isEmpty():
        more = written(_prove(rest, roots, docs, words, percent), "verified")
        roots = components(links.union(more))

    ids = classes.join(roots, "node", "left").select(
        "n_shingles", "set_a", "set_b", F.coalesce("root", "node").alias("_class_root")
    )
    found = known.join(ids, ["n_shingles", "set_a", "set_b"], "left")
    root = F.coalesce("_class_root", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        root.alias("component_id"),
        F.col("doc_id").eqNullSafe(root).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
  FROM split
),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n
  FROM items p JOIN items q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared
  JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a
),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)
"""
