"""Toxic spans by a linear-chain conditional random field, and document scores from it.

1. ``token_statistics`` counts, over all training documents, how often each
   feature occurs in toxic and in clean ones. A token's features are its word
   (A-Z folded, without signs at its ends) and its first ``PREFIXES`` bytes.
   Tasks count per distinct word before anything is sent.
2. ``lexicon`` keeps the features that speak most clearly for toxic documents,
   ``LEXICON`` at most, with their log odds. The odds label the tokens: in toxic
   documents those whose best feature has odds above ``LABEL_ODDS`` are toxic.
3. ``train`` fits the field (two tags, transitions, weights of the odds) to those
   labels, and a logistic curve from marginals to document labels, on at most
   ``SAMPLE`` documents per class of at most ``SAMPLE_BYTES`` each.
4. ``score`` runs forward and backward over every whole text and returns the
   document's score and the spans whose tokens are more likely toxic than not.

All texts of a batch form one chain whose links are cut between texts, so a
long text costs no more per word than a short one.

Defined cases: a null or empty text has no spans and scores what the curve
gives a text without tokens; documents without a label are not learned from;
with no label of either class every score is 0; repeated rows count each time;
a document with several labels counts once per label; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import hash_sample, texts, written
from pactline.llm.words import (
    SLICE_BYTES,
    Slice,
    SpanHasher,
    find_words,
    signed,
    slices,
    trimmed,
)

PREFIXES = (5, 6, 7)
LEXICON = 1 << 16
LEAST_COUNT = 5
LEAST_CLEAR = 4.0  # standard deviations above what chance gives
LABEL_ODDS = 2.0
SAMPLE = 400
SAMPLE_BYTES = 50_000
STEPS = 40
_COLUMN = 256  # tokens of a column of the chain
_NONE = np.uint64(0)


class Model(NamedTuple):
    keys: np.ndarray
    odds: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    curve: np.ndarray


class Tokens(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    which: np.ndarray
    features: np.ndarray
    counts: np.ndarray


def _tokens(part: Slice) -> Tokens:
    """Words without signs at their ends, and the features of each distinct word."""
    words = find_words(part)
    starts, ends = trimmed(part, words)
    hasher = SpanHasher(part.data, fold=True)
    keys, sample, which, counts = np.unique(
        hasher(starts, ends), return_index=True, return_inverse=True, return_counts=True
    )
    first, last = starts[sample], ends[sample]
    columns = [keys]
    for size in PREFIXES:
        salt = np.uint64(size * 0x9E3779B97F4A7C15 % 2**64)
        key = hasher(first, np.minimum(first + size, last)) ^ salt
        columns.append(np.where(last - first > size, key, _NONE))
    return Tokens(words.starts, words.ends, words.firsts, which, np.stack(columns, 1), counts)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for toxic in (0, 1):
            rows = batch.filter(pa.compute.equal(batch.column("toxic"), toxic))
            for part in slices(rows.column("text"), 4 * SLICE_BYTES):
                tokens = _tokens(part)
                # Under the key of no feature: all tokens.
                flat = np.append(tokens.features.ravel(), _NONE)
                each = np.append(np.repeat(tokens.counts, tokens.features.shape[1]), 0)
                keys, place = np.unique(flat, return_inverse=True)
                n = np.bincount(place, weights=each, minlength=len(keys)).astype(np.int64)
                n[keys == _NONE] = tokens.counts.sum()
                zero = np.zeros(len(n), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys)), *map(pa.array, (n, zero) if toxic else (zero, n))],
                    names=["key", "toxic", "clean"],
                )


def token_statistics(training: DataFrame) -> DataFrame:
    """``key``, ``toxic``, ``clean``: occurrences of each feature by class; key 0 has all tokens."""
    found = training.select("text", "toxic").mapInArrow(
        _counter, "key bigint, toxic bigint, clean bigint"
    )
    return found.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(statistics: DataFrame, most: int = LEXICON) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log odds of the features that speak for toxic documents, sorted by key."""
    totals = statistics.where("key = 0").first()
    if totals is None or not totals["toxic"] or not totals["clean"]:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    share = totals["toxic"] / totals["clean"]
    expected = F.col("clean") * F.lit(share)
    rows = statistics.where((F.col("key") != 0) & (F.col("toxic") >= LEAST_COUNT)).select(
        "key",
        F.log((F.col("toxic") + 0.5) / (expected + 0.5)).alias("odds"),
        ((F.col("toxic") - expected) / F.sqrt(expected + 1)).alias("clear"),
    )
    clear = rows.where((F.col("odds") > 0.5) & (F.col("clear") >= LEAST_CLEAR))
    chosen = clear.orderBy(F.desc("clear"), "key").limit(most).collect()
    keys = np.array([r["key"] for r in chosen], dtype=np.int64).view(np.uint64)
    odds = np.array([r["odds"] for r in chosen], dtype=np.float64)
    order = np.argsort(keys)
    return keys[order], odds[order]


def _odds(tokens: Tokens, keys: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """For each token the odds of its word and the best odds of its prefixes."""
    if not len(keys):
        return np.zeros((len(tokens.which), 2))
    at = np.minimum(np.searchsorted(keys, tokens.features), len(keys) - 1)
    found = np.where(keys[at] == tokens.features, odds[at], 0.0)
    return np.stack([found[:, 0], found[:, 1:].max(axis=1)], 1)[tokens.which]


def _steps(score: np.ndarray, heads: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The 2x2 link into each token; a text's first token ignores what is before it."""
    scale = np.maximum(score, 0)
    emit = np.stack([np.exp(-scale), np.exp(score - scale)], 1)
    links = np.exp(transition[None, :2, :]).repeat(len(score), 0)
    links[heads] = np.exp(transition[2])[None, None, :]
    return links * emit[:, None, :]


def _forward(links: np.ndarray) -> np.ndarray:
    """Scaled forward vectors of a chain of 2x2 links, all columns of it at once."""
    n = len(links)
    columns = max(1, -(-n // _COLUMN))
    padded = np.zeros((columns * _COLUMN, 2, 2))
    padded[:n] = links
    padded[n:] = np.eye(2)
    grid = padded.reshape(columns, _COLUMN, 2, 2).transpose(1, 2, 3, 0).copy()
    total = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, columns)).copy()
    for link in grid:
        total = total[:, 0, None] * link[None, 0] + total[:, 1, None] * link[None, 1]
        total /= total.sum(axis=(0, 1))
    entry = np.empty((2, columns))
    state = np.array([0.5, 0.5])
    for c in range(columns):
        entry[:, c] = state
        state = state @ total[:, :, c]
        state = state / state.sum()
    out = np.empty((_COLUMN, 2, columns))
    state = entry
    for i, link in enumerate(grid):
        state = state[0] * link[0] + state[1] * link[1]
        state /= state.sum(axis=0)
        out[i] = state
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


def _marginals(score: np.ndarray, heads: np.ndarray, transition: np.ndarray):
    """P(toxic) per token, and of each pair of neighbours in one text the four joint ones."""
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2)), np.zeros(0, dtype=np.int64)
    links = _steps(score, heads, transition)
    ahead = _forward(links)
    # Backward is forward over the turned chain: into token t comes its successor's link.
    # A text's last token starts anew, as the next link does not depend on it.
    turned = np.ones((n, 2, 2))
    turned[1:] = links[1:][::-1].transpose(0, 2, 1)
    behind = _forward(turned)[::-1]
    both = ahead * behind
    toxic = both[:, 1] / both.sum(axis=1)
    inner = np.ones(n, dtype=bool)
    inner[heads] = False
    t = np.flatnonzero(inner)
    joint = ahead[t - 1][:, :, None] * links[t] * behind[t][:, None, :]
    return toxic, joint / joint.sum(axis=(1, 2), keepdims=True), t


def _heads(firsts: np.ndarray) -> np.ndarray:
    return firsts[:-1][np.diff(firsts) > 0]


def _fit_field(x: np.ndarray, y: np.ndarray, heads: np.ndarray):
    """Maximum likelihood of the tags by Adam; returns emission and transition weights."""
    design = np.column_stack([x, np.ones(len(x))])
    inner = np.ones(len(y), dtype=bool)
    inner[heads] = False
    t = np.flatnonzero(inner)
    seen = np.zeros((3, 2))
    np.add.at(seen, (y[t - 1], y[t]), 1)
    np.add.at(seen, (np.full(len(heads), 2), y[heads]), 1)
    target = design.T @ y
    start = np.zeros(design.shape[1] + 6)
    start[:2], start[2] = 1.0, -4.0
    weights, first, second = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, STEPS + 1):
        emission, transition = weights[:-6], weights[-6:].reshape(3, 2)
        toxic, joint, _ = _marginals(design @ emission, heads, transition)
        expected = np.vstack([joint.sum(axis=0), [[(1 - toxic[heads]).sum(), toxic[heads].sum()]]])
        slope = np.append(target - design.T @ toxic, (seen - expected).ravel()) / max(1, len(heads))
        slope -= 1e-3 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights = weights + 0.15 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-9
        )
    return weights[:-6], weights[-6:].reshape(3, 2)


def _summary(toxic: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """What a document's marginals say: expected toxic tokens, their share, the clearest one."""
    counts = np.diff(firsts)
    rows = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(rows, weights=toxic, minlength=len(counts))
    most = np.zeros(len(counts))
    np.maximum.at(most, rows, toxic)
    share = total / np.maximum(counts, 1)
    return np.column_stack(
        [np.log1p(total), np.log1p(100 * share), most, np.log1p(counts), np.ones(len(counts))]
    )


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - 0.5 * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(x.shape[1])
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def train(training: DataFrame, sample: int = SAMPLE, most: int = LEXICON) -> Model:
    """Learn from ``doc_id``, ``text`` and ``toxic`` (0 or 1); other rows are left out."""
    rows = texts(training, "toxic").where("toxic in (0, 1) and text is not null")
    # Read three times below, and what made it may be a join of texts.
    rows = written(rows.withColumn("toxic", F.col("toxic").cast("int")), "labelled")
    keys, odds = lexicon(token_statistics(rows), most)
    short = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    chosen = hash_sample(short, "toxic", sample, seed=6).select("doc_id", "toxic", "text").collect()
    chosen.sort(key=lambda r: (r["toxic"], r["doc_id"] is None, r["doc_id"] or 0, r["text"]))
    labels = np.array([r["toxic"] for r in chosen], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(keys, odds, np.zeros(3), np.zeros((3, 2)), np.zeros(0))
    found, firsts = [], [np.zeros(1, dtype=np.int64)]
    for part in slices(pa.array([r["text"] for r in chosen], pa.large_string())):
        tokens = _tokens(part)
        found.append(_odds(tokens, keys, odds))
        firsts.append(tokens.firsts[1:] + firsts[-1][-1])
    x, firsts = np.concatenate(found), np.concatenate(firsts)
    of = np.repeat(labels, np.diff(firsts))
    y = ((x.max(axis=1) > LABEL_ODDS) & (of == 1)).astype(np.int64)
    emission, transition = _fit_field(x, y, _heads(firsts))
    score = np.column_stack([x, np.ones(len(x))]) @ emission
    toxic, _, _ = _marginals(score, _heads(firsts), transition)
    return Model(keys, odds, emission, transition, _fit_curve(_summary(toxic, firsts), labels))


def _tagger(model: Model):
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                tokens = _tokens(part)
                x = _odds(tokens, model.keys, model.odds)
                if len(model.curve):
                    score = np.column_stack([x, np.ones(len(x))]) @ model.emission
                    toxic, _, _ = _marginals(score, _heads(tokens.firsts), model.transition)
                    logit = _summary(toxic, tokens.firsts) @ model.curve
                    scores = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                else:
                    toxic, scores = np.zeros(len(x)), np.zeros(part.last - part.first)
                rows = part.last - part.first
                bad = np.flatnonzero(toxic >= 0.5)
                # Places in characters: bytes that begin one.
                begun = np.append(0, np.cumsum((part.data & 0xC0) != 0x80))
                row = np.searchsorted(tokens.firsts, bad, side="right") - 1
                base = begun[part.offsets[row]]
                cuts = np.searchsorted(row, np.arange(rows + 1))
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(begun[tokens.starts[bad]] - base, pa.int64()),
                        pa.array(begun[tokens.ends[bad]] - base, pa.int64()),
                    ],
                    names=["start", "end"],
                )
                own = batch.column("doc_id").slice(part.first, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        own,
                        pa.array(scores),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
                    ],
                    names=["doc_id", "score", "spans"],
                )

    return tag


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``spans`` (character offsets of toxic tokens) for every text."""
    return texts(docs).mapInArrow(
        _tagger(model),
        "doc_id bigint, score double, spans array<struct<start: bigint, end: bigint>>",
    )
