import random
import zlib

import numpy as np
import pytest
from llm_texts import docs_frame, sentence
from tokenizers import Tokenizer

from pactline.llm import configuration_lp, packing
from pactline.llm.queries import tokenizer


def covered(bins, capacity):
    total = np.zeros(capacity + 1, dtype=np.int64)
    for lengths, times in bins:
        assert sum(n * c for n, c in lengths) <= capacity and times > 0
        for n, c in lengths:
            total[n] += c * times
    return total


@pytest.mark.parametrize("low, high, most", [(1, 65, 1.02), (10, 40, 1.04), (18, 22, 1.02)])
def test_bins_cover_the_histogram_and_are_few(low, high, most):
    rng = np.random.default_rng(low)
    counts = np.bincount(rng.integers(low, high, 20_000), minlength=65)
    bins = configuration_lp.pack(counts, 64)
    assert (covered(bins, 64) == counts).all()
    together = 64 // low  # no bin holds more items
    best = max(-(-int(counts @ np.arange(65)) // 64), counts[33:].sum(), 20_000 // together)
    assert sum(times for _, times in bins) <= best * most + 3


def test_solution_covers_every_length_exactly():
    counts = np.zeros(33, dtype=np.int64)
    counts[[3, 7, 11, 32]] = [1000, 10, 1, 5]
    total = np.zeros(33)
    for lengths, amount in configuration_lp.solve(counts, 32):
        for n, c in lengths:
            total[n] += c * amount
    assert np.allclose(total, counts)


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(1)
    lengths, prices = np.array([3, 5, 8, 13]), rng.random(4)
    best = [0.0]
    for size in range(1, 41):
        fits = [best[size - n] + p for n, p in zip(lengths, prices, strict=True) if n <= size]
        best.append(max([best[-1], *fits]))
    assert np.allclose(configuration_lp.knapsack(lengths, prices, 40).best, best)


def check(rows, docs, capacity):
    """Pieces hold exactly the documents' ids, and every sequence is gapless."""
    coder = Tokenizer.from_file(tokenizer())
    coder.encode_special_tokens = True
    want = []
    for i, text in docs:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or min(len(ids), capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            want.append((i is None, i or 0, n, a, b - a, crc))
    got = sorted((r[0] is None, r[0] or 0, *r[1:5]) for r in rows)
    assert got == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 128, 2048])
def test_pieces_are_whole_and_sequences_gapless(llm, capacity):
    rng = random.Random(capacity)
    docs = [(i, sentence(rng, rng.choice([0, 1, 3, 20, 90, 700]))) for i in range(300)]
    docs += [(7, "again the same id"), (None, "no id"), (None, None), (900, None)]
    frame = llm.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    rows = packing.pack_documents(frame, tokenizer(), capacity).collect()
    found = check(rows, docs, capacity)
    tokens = sum(r.length for r in rows)
    assert found <= -(-tokens // capacity) * 1.1 + 2


def test_one_length_for_all(llm):
    docs = docs_frame(llm, ["same words here"] * 1000).repartition(7)
    rows = packing.pack_documents(docs, tokenizer(), 64).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000
    size = rows[0].length
    assert len({r.sequence_id for r in rows}) == -(-1000 // (64 // size))


def test_odd_rows(odd, odd_rows):
    rows = packing.pack_documents(odd, tokenizer()).collect()
    check(rows, [r[:2] for r in odd_rows], 2048)


def test_empty_table(empty):
    assert packing.pack_documents(empty, tokenizer()).count() == 0
