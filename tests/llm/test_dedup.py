import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import docs_frame, sentence

from pactline.llm import exact_dedup, near_dedup, substring_dedup
from pactline.llm.common import written
from pactline.llm.links import components
from pactline.llm.words import slices


def fold(text):
    return (text or "").encode().lower().decode()


def words_of(text, lower=True):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def shingles(text, n):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near_by_hand(texts, n):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 80 * len(x | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = sentence(rng, 1) + str(rng.randrange(10**6))
    return " ".join(w)


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_match_all_pairs(llm, n):
    rng = random.Random(n)
    base = [sentence(rng, rng.choice([1, 3, 30, 120])) for _ in range(40)]
    texts = base + [edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(120)]
    texts += [base[-1]] * 5 + ["", None, "one", "ONE"]
    hub = sentence(rng, 100)
    texts += [edited(rng, hub, 2) for _ in range(60)] + [hub.upper()]
    found = near_dedup.near_duplicates(docs_frame(llm, texts), words=n)
    assert sorted(tuple(r) for r in found.collect()) == near_by_hand(texts, n)


def test_crowded_bucket_is_compared_in_blocks(llm, monkeypatch):
    """One bucket holds several groups that a star around one document cannot link."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(5)
    core = sentence(rng, 60)
    texts = [core]
    for _ in range(5):
        branch = f"{core} {sentence(rng, 25)}"
        texts += [edited(rng, branch, 1) for _ in range(12)]
    found = near_dedup.near_duplicates(docs_frame(llm, texts), words=4)
    assert sorted(tuple(r) for r in found.collect()) == near_by_hand(texts, 4)


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, size=s).astype(np.uint64)) for s in (1, 2, 7, 500)]
    keys = np.concatenate(sets)
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    assert (near_dedup.sketch(keys, firsts) != 0).all()
    both = rng.integers(0, 2**63, size=800).astype(np.uint64)
    x = np.concatenate([both, rng.integers(0, 2**63, size=100).astype(np.uint64)])
    y = np.concatenate([both, rng.integers(0, 2**63, size=100).astype(np.uint64)])
    a, b = near_dedup.sketch(np.concatenate([x, y]), np.array([0, 900, 1800]))
    assert abs((a == b).mean() - 0.8) < 0.12


def test_near_duplicates_of_odd_rows(llm, odd, empty):
    found = near_dedup.near_duplicates(odd).collect()
    by_id = defaultdict(list)
    for r in found:
        by_id[r["doc_id"]].append(r)
    assert len(found) == 16
    assert {r["component_id"] for r in by_id[2]} == {1}
    assert by_id[7][0]["component_id"] == 6 and not by_id[7][0]["kept"]
    assert by_id[3][0]["kept"] and by_id[4][0]["n_shingles"] == 0 and by_id[4][0]["kept"]
    assert near_dedup.near_duplicates(empty).collect() == []


def test_near_copies_under_repeated_and_missing_ids(llm):
    rng = random.Random(31)
    one, two, three = (sentence(rng, 60) for _ in range(3))
    rows = [
        (5, one), (5, two), (7, one + " more"), (9, two + " more"), (5, one),
        (1, three), (None, three + " more"), (None, "alone here now yes"), (None, "alone here now yes"),
        (None, None), (12, "something else is here"),
    ]
    found = near_dedup.near_duplicates(
        llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3), words=4
    ).collect()
    assert len(found) == len(rows)
    got = sorted({(r.doc_id or 0, r.component_id or 0, r.kept, r.n_shingles) for r in found})
    assert got == [
        (0, 0, True, 0), (0, 0, True, 1), (0, 1, False, 58), (1, 1, True, 57), (5, 5, True, 57),
        (7, 5, False, 58), (9, 5, False, 58), (12, 12, True, 1),
    ]


def test_components_of_long_and_bushy_links(llm):
    links = [(i, i + 1) for i in range(70)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    random.Random(1).shuffle(links)
    found = components(llm.createDataFrame(links, "a bigint, b bigint"))
    assert {r["node"]: r["root"] for r in found.collect()} == {
        **{i: 0 for i in range(71)},
        **{1000 + i: 1000 for i in range(50)},
    }


def test_exact_groups(llm, odd, odd_rows, empty):
    found = exact_dedup.deduplicate(odd).collect()
    groups = defaultdict(list)
    for i, t, *_ in odd_rows:
        groups[fold(t)].append(i)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, keep, len(ids), i == keep, sha) for i in ids)
    assert Counter(tuple(r) for r in found) == expected
    assert exact_dedup.deduplicate(empty).collect() == []


def test_only_ascii_letters_fold(llm):
    found = exact_dedup.deduplicate(docs_frame(llm, ["ÉA", "Éa", "éa", "İ", "i̇"]))
    assert {r["doc_id"]: r["keep_id"] for r in found.collect()} == {0: 1, 1: 1, 2: 2, 3: 3, 4: 4}


def test_state_goes_on_with_later_arrivals(llm, tmp_path):
    arrived, state, updates = (str(tmp_path / x) for x in ("in", "state", "out"))
    for texts, first in ((["a", "b", "A"], 0), (["a", "c"], 10), (["B"], 20)):
        exact_dedup.digest_texts(docs_frame(llm, texts, first)).write.mode("append").parquet(arrived)
        rows = llm.readStream.schema(exact_dedup.ARRIVALS).parquet(arrived)
        exact_dedup.stream_digests(rows, state, updates)
    found = exact_dedup.latest(llm, updates).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in found) == [(10, 3), (11, 1), (20, 2)]


def windows_by_hand(rows, n):
    firsts = {}
    for i, t in rows:
        w = words_of(t, lower=False)
        for k in range(len(w) - n + 1):
            x = tuple(w[k : k + n])
            firsts[x] = min(firsts.get(x, 2**63), 2**63 - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = words_of(t, lower=False)
        gone = set()
        for k in range(len(w) - n + 1):
            if firsts[tuple(w[k : k + n])] < (2**63 - 1 if i is None else i):
                gone.update(range(k, k + n))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [3, 13])
def test_repeated_passages_match_all_windows(llm, window):
    rng = random.Random(window)
    passages = [sentence(rng, rng.choice([12, 13, 14, 60])).split() for _ in range(12)]
    texts = []
    for _ in range(80):
        w = sentence(rng, rng.randrange(0, 60)).split()
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[a : a + rng.randrange(1, len(p) + 1)]
        texts.append("  ".join(w))
    texts += [texts[3], "la " * 40, "la " * 60, "a b " * 30, "b a " * 20, None, ""]
    found = substring_dedup.deduplicate(docs_frame(llm, texts), window)
    assert Counter(tuple(r) for r in found.collect()) == windows_by_hand(
        list(enumerate(texts)), window
    )


def test_repeated_passages_of_odd_rows(llm, odd, odd_rows, empty):
    found = substring_dedup.deduplicate(odd, 4).collect()
    assert Counter(tuple(r) for r in found) == windows_by_hand([r[:2] for r in odd_rows], 4)
    assert substring_dedup.deduplicate(empty).collect() == []


def test_paths_lie_in_their_sources(llm):
    rng = random.Random(9)
    shared = sentence(rng, 80)
    texts = [f"{sentence(rng, 20)} {shared} {sentence(rng, 9)}" for _ in range(4)]
    docs = substring_dedup._identified(docs_frame(llm, texts)).cache()
    keys = substring_dedup.repeated_minimizers(docs)
    found = written(substring_dedup.resolve(substring_dedup.stretches(docs, keys)), "test")
    rows = {r["row"]: r["text"].split() for r in docs.collect()}
    spans = substring_dedup.paths(found).collect()
    assert len(spans) == 3  # one whole passage in each later document
    for s in spans:
        size = s["size"] + 12
        own = rows[s["row"]][s["first"] : s["first"] + size]
        assert own == rows[s["source"]][s["source_first"] : s["source_first"] + size]
        assert size == 80


def test_kept_texts_are_those_of_the_digests(llm):
    rng = random.Random(10)
    shared = sentence(rng, 30)
    docs = docs_frame(llm, [f"{sentence(rng, 5)} {shared}" for _ in range(4)] + [None])
    rows = substring_dedup.deduplicate(docs, with_text=True).collect()
    short = substring_dedup.deduplicate(docs)
    assert Counter(tuple(r) for r in short.collect()) == Counter(tuple(r)[:4] for r in rows)
    for r in rows:
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_shingle_sets_match_words():
    texts = ["a b c d e", "A B C D E", "a b", "", "a a a a a a"]
    sets = []
    for part in slices(pa.array(texts), 8):
        keys, firsts = near_dedup.shingle_sets(part, 4)
        sets += np.split(keys, firsts[1:-1])
    assert [len(s) for s in sets] == [len(shingles(t, 4)) for t in texts]
    assert (sets[0] == sets[1]).all()
