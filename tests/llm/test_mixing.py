import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_texts import sentence
from pyspark.sql import functions as F

from pactline.llm import mixing
from pactline.llm.common import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes, weights=(5, 2, 1), epochs=3):
    """Share by weight; whoever is above its stop gets the stop, and the rest is shared again."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > epochs * sizes[s]}
        if not over:
            return found | share
        for s in over:
            found[s] = Fraction(epochs * sizes[s])
            left -= found[s]
        open_ -= over
    return found


def key(doc_id):
    name = f"mix:{'' if doc_id is None else doc_id}"
    return int(hashlib.md5(name.encode()).hexdigest()[:10], 16)


def mix_by_hand(rows):
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    out = []
    for source, target in targets_by_hand(sizes).items():
        budget, total = math.floor(target), sizes[source]
        epochs, rest = divmod(budget, total) if total else (0, 0)
        own = sorted(
            (r for r in rows if r[1] == source),
            key=lambda r: (key(r[0]), r[0] is not None, r[0] or 0, r[2]),
        )
        for doc_id, _, size in own:
            part = max(0, min(size, rest))
            rest -= size
            out.append((doc_id, size, total, round(float(target), 4), epochs * size + part))
    return Counter(out)


def rows_of(found):
    picked = found.select("doc_id", "size", "source_size", "target", "taken").collect()
    return Counter((r[0], r[1], r[2], round(r[3], 4), r[4]) for r in picked)


@pytest.mark.parametrize("seed", range(4))
def test_mix_matches_the_rule(llm, monkeypatch, seed):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    monkeypatch.setattr(mixing, "_RANGES_PER_GROUP", 3)
    rng = random.Random(seed)
    names = ["a", "B", "é", "zz", None, "", "a b"][: rng.randint(1, 7)]
    rows = []
    for i in range(rng.choice([3, 200])):
        source = names[0] if rng.random() < 0.4 else rng.choice(names)
        rows.append((i, source, rng.choice([0, 1, 5, 300])))
    frame = written(llm.createDataFrame(rows, "doc_id bigint, source string, size bigint"), "t")
    found = mixing.take(frame)
    assert rows_of(found) == mix_by_hand(rows) == rows_of(mixing.take(frame))
    taken = defaultdict(int)
    for r in found.collect():
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for r in found.select("source", "target").distinct().collect():
        assert 0 <= r["target"] - taken[r["source"]] < 1


def test_mix_of_odd_rows(llm, odd, odd_rows, empty):
    sized = written(mixing.sizes(odd), "t")
    rows = [(i, s, len(WORD.findall(t or ""))) for i, t, _, s, *_ in odd_rows]
    assert sum(rows_of(mixing.take(sized)).values()) == len(rows)
    assert sum(r["taken"] for r in mixing.take(sized).collect()) <= sum(r[2] for r in rows)
    docs = mixing.mix(odd, sized)
    assert docs.columns == odd.columns
    words = sum(len(WORD.findall(r["text"])) for r in docs.collect())
    assert words == sum(r["taken"] for r in mixing.take(sized).collect())
    none = written(mixing.sizes(empty), "t")
    assert mixing.take(none).collect() == [] and mixing.mix(empty, none).collect() == []


def test_cut_keeps_whole_words_from_the_start(llm):
    rng = random.Random(1)
    texts = [(i, f"  {sentence(rng, 9)} \n", "ab"[i % 2]) for i in range(20)]
    docs = llm.createDataFrame(texts, "doc_id bigint, text string, source string")
    sized = written(mixing.sizes(docs), "t")
    taken = {r["doc_id"]: r["taken"] for r in mixing.take(sized).collect()}
    found = defaultdict(list)
    for r in mixing.mix(docs, sized).collect():
        found[r["doc_id"]].append(r["text"])
    for i, text, _ in texts:
        epochs, rest = divmod(taken[i], 9)
        expected = [text] * epochs
        if rest:
            expected.append(re.match(r"(\s*\S+){%d}" % rest, text).group())
        assert sorted(found[i]) == sorted(expected)


def test_ranges_of_a_source_of_any_size(llm):
    last = (1 << 40) - 1
    keys = [(k, n) for k in (0, last // 2, last) for n in (1, 7, 10**13)]
    rows = llm.createDataFrame(keys, "k bigint, n bigint")
    for r in rows.select("k", "n", mixing.range_of(F.col("k"), F.col("n")).alias("r")).collect():
        assert 0 <= r.r < r.n and abs(r.r - r.k * r.n // (1 << 40)) <= r.n // 10**12
