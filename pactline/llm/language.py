"""Language of whole texts: nearest of several TF-IDF centroids per language.

A text becomes counts of its byte n-grams (``GRAM`` bytes, hashed to ``WIDTH``
places, A-Z folded, other ASCII signs read as spaces), damped by a logarithm,
weighed by inverse document frequency and scaled to length one. Document
frequencies are counted over all training documents. The centroids of a
language come from spherical k-means over at most ``SAMPLE`` of its training
documents, chosen by a hash; this bound is a parameter. A text goes to the
language of the nearest centroid by cosine, and is rejected if it is farther
from that centroid than anything of the sample, by a factor.

Defined cases: a null text and one without a letter are ``und`` with score 0
and rejected; so is every text where nothing could be learned; equal cosines go
to the first language by code point; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import hash_sample, texts
from pactline.llm.words import Slice, slices

GRAM = 3
# Bytes whose n-grams are counted at once.
BLOCK = 1 << 18
WIDTH = 4096
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 12
# A text is rejected below this share of the lowest cosine met in the sample.
SLACK = 0.5
# A text with fewer n-grams than this is naturally farther; its limit shrinks as the root.
ENOUGH = 200
UNKNOWN = "und"

_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = _CLASS[97:123]
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray
    owners: np.ndarray
    centroids: np.ndarray
    limits: np.ndarray


def _counts(part: Slice) -> np.ndarray:
    """Hashed n-gram counts, a row per text."""
    rows = part.last - part.first
    ends = part.offsets + 2 * np.arange(rows + 1)  # a space before and after each text
    letters = np.full(ends[-1], 32, dtype=np.uint8)
    for r in range(rows):
        first, last = part.offsets[r : r + 2]
        letters[ends[r] + 1 : ends[r + 1] - 1] = part.data[first:last]
    letters = _CLASS[letters]
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    # A long text is counted piece by piece, so it takes a few bytes per byte.
    for first in range(0, len(letters) - GRAM + 1, BLOCK):
        size = min(BLOCK, len(letters) - GRAM + 1 - first)
        code = np.zeros(size, dtype=np.uint32)
        for i in range(first, first + GRAM):
            code = code * np.uint32(0x9E3779B1) + letters[i : i + size] * np.uint32(0x85EBCA6B)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code >>= np.uint32(32 - (WIDTH.bit_length() - 1))
        low = int(np.searchsorted(ends, first, side="right")) - 1
        high = int(np.searchsorted(ends, first + size, side="left"))
        cuts = np.clip(ends[low : high + 1], first, first + size)
        row = np.repeat(np.arange(high - low), np.diff(cuts))
        inside = ends[low + 1 + row] - np.arange(first, first + size) >= GRAM
        keys = row[inside] * WIDTH + code[inside]
        found = np.bincount(keys, minlength=(high - low) * WIDTH)
        out[low:high] += found.reshape(high - low, WIDTH)
    return out


def _vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts, dtype=np.float32) * weights
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, docs = np.zeros(WIDTH, dtype=np.int64), 0
    for batch in batches:
        for part in slices(batch.column("text")):
            found += (_counts(part) > 0).sum(axis=0)
            docs += part.last - part.first
    if docs:
        places = pa.array(np.arange(-1, WIDTH))
        yield pa.RecordBatch.from_arrays(
            [places, pa.array(np.append([docs], found))], names=["place", "n"]
        )


def idf_weights(training: DataFrame) -> np.ndarray:
    """Inverse document frequency of each place, over all rows; ``WIDTH`` sums."""
    sums = training.select("text").mapInArrow(_frequencies, "place bigint, n bigint")
    found = {r["place"]: r["n"] for r in sums.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    docs = found.get(-1, 0)
    seen = np.array([found.get(i, 0) for i in range(WIDTH)], dtype=np.float64)
    return (np.log((1 + docs) / (1 + seen)) + 1).astype(np.float32)


def _kmeans(vectors: np.ndarray, most: int) -> np.ndarray:
    """Spherical k-means; starts from texts far from those already chosen."""
    chosen = [0]
    while len(chosen) < min(most, len(vectors)):
        nearest = (vectors @ vectors[chosen].T).max(axis=1)
        chosen.append(int(nearest.argmin()))
    centroids = vectors[chosen]
    for _ in range(ROUNDS):
        owner = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[owner == k].sum(axis=0) for k in range(len(centroids))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    return centroids


def _cluster(weights: np.ndarray, most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        counts = [_counts(p) for p in slices(pa.array(rows["text"], pa.large_string()))]
        vectors = _vectors(np.concatenate(counts), weights)
        vectors = vectors[vectors.any(axis=1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "lowest": []})
        centroids = _kmeans(vectors, most)
        lowest = float((vectors @ centroids.T).max(axis=1).min())
        return pd.DataFrame(
            {
                "lang": rows["lang"].iloc[0],
                "centroid": [c.astype(np.float64).tolist() for c in centroids],
                "lowest": lowest,
            }
        )

    return cluster


def train(
    training: DataFrame, sample: int = SAMPLE, clusters: int = CENTROIDS, slack: float = SLACK
) -> Model:
    """Learn from ``doc_id``, ``text`` and ``lang``; rows with a null in the last two are left out.

    The driver receives ``WIDTH`` frequencies and ``clusters`` centroids per language.
    """
    rows = texts(training, "lang").where("text is not null and lang is not null")
    weights = idf_weights(rows)
    chosen = hash_sample(rows, "lang", sample, seed=9)
    found = (
        chosen.groupBy("lang")
        .applyInPandas(
            _cluster(weights, clusters), "lang string, centroid array<double>, lowest double"
        )
        .collect()
    )
    found.sort(key=lambda r: (r["lang"].encode(), list(r["centroid"])))
    languages = sorted({r["lang"] for r in found}, key=str.encode)
    place = {lang: i for i, lang in enumerate(languages)}
    return Model(
        languages,
        weights,
        np.array([place[r["lang"]] for r in found], dtype=np.int64),
        np.array([r["centroid"] for r in found], dtype=np.float32).reshape(len(found), WIDTH),
        np.array([r["lowest"] * slack for r in found], dtype=np.float32),
    )


def _has_letter(part: Slice) -> np.ndarray:
    rows = part.last - part.first
    row = np.repeat(np.arange(rows), np.diff(part.offsets))
    found = np.bincount(row[_LETTER[part.data]], minlength=rows) > 0
    for r in np.flatnonzero(~found & (np.diff(part.offsets) > 0)):
        text = part.data[part.offsets[r] : part.offsets[r + 1]].tobytes().decode()
        found[r] = any(map(str.isalpha, text))
    return found


def _classifier(model: Model):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch.column("text")):
                letters = _has_letter(part)
                rows = part.last - part.first
                best = np.full(rows, len(model.languages))
                score, rejected = np.zeros(rows), np.ones(rows, dtype=bool)
                if len(model.owners):
                    counts = _counts(part)
                    cosines = _vectors(counts, model.weights) @ model.centroids.T
                    nearest = cosines.argmax(axis=1)
                    near = np.clip(cosines[np.arange(rows), nearest], 0, 1)
                    best = np.where(letters, model.owners[nearest], best)
                    score = np.where(letters, near, 0.0)
                    short = np.sqrt(np.minimum(1, counts.sum(axis=1) / ENOUGH))
                    rejected = ~letters | (near < model.limits[nearest] * short)
                own = batch.slice(part.first, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.columns,
                        pa.array(names[best], pa.string()),
                        pa.array(score.astype(np.float64)),
                        pa.array(rejected),
                    ],
                    names=[*own.schema.names, "lang_pred", "score", "rejected"],
                )

    return classify


_FOUND = "lang_pred string, score double, rejected boolean"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine) and ``rejected`` for every whole text."""
    found = texts(docs).mapInArrow(_classifier(model), f"doc_id bigint, text string, {_FOUND}")
    return found.drop("text")


def accept(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """Id, text and the named columns of the documents that are not rejected."""
    rows = texts(docs, *more)
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    found = rows.mapInArrow(_classifier(model), f"{kinds}, {_FOUND}")
    return found.where(~F.col("rejected")).select(*rows.columns)
