import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import docs_frame, sentence

from pactline.llm import decontamination, language, lattice, lm_scores, toxicity
from pactline.llm.common import hash_sample
from pactline.llm.queries import tokenizer
from pactline.llm.words import slices


def words_of(text):
    return (text or "").encode().lower().split()


def segmentations(text):
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        yield [text[a:b] for a, b in itertools.pairwise(at)]


@pytest.fixture(scope="module")
def few_pieces():
    long = b"seventeen and more"
    strings = [lattice.MARK, *(bytes([b]) for b in range(255)), lattice.MARK + b"th", b"he", b"the"]
    strings.append(long.replace(b" ", b""))
    weights = np.arange(1.0, len(strings) + 1)
    pieces = lattice.build(strings, weights)
    logs = np.log(weights / weights.sum())
    by_string = dict(zip(strings, logs.tolist(), strict=True))
    return pieces, by_string, {s: n for n, s in enumerate(strings)}


def test_lattice_sums_all_segmentations(few_pieces):
    pieces, by_string, place = few_pieces
    words = [b"the", b"a", b"thethe", "éh".encode(), b"seventeenandmore"]
    data, offsets = lattice._joined(words)
    got = lattice.word_logs(data, offsets, pieces)
    weights = np.arange(1.0, 6.0)
    counts = np.zeros(len(pieces.logs))
    for word, weight, found in zip(words, weights, got, strict=True):
        ways = []
        for parts in segmentations(lattice.MARK + word):
            if all(p in by_string for p in parts):
                ways.append((math.exp(sum(by_string[p] for p in parts)), parts))
        total = sum(p for p, _ in ways)
        assert found == pytest.approx(math.log(total))
        for p, parts in ways:
            for part in parts:
                counts[place[part]] += weight * p / total
    assert lattice.expected_counts(data, offsets, weights, pieces) == pytest.approx(counts)


def test_long_words_do_not_underflow(few_pieces):
    data, offsets = lattice._joined([b"z" * 5000])
    assert -1e6 < lattice.word_logs(data, offsets, few_pieces[0])[0] < -1000


@pytest.mark.parametrize("frequent", [1 << 16, 20])
def test_counts_and_base_scores(llm, odd, odd_rows, frequent):
    rng = random.Random(1)
    texts = [sentence(rng, 30) for _ in range(60)]
    train = docs_frame(llm, texts[:40]).unionByName(odd.select("doc_id", "text"))
    rows = docs_frame(llm, texts).unionByName(odd.select("doc_id", "text"))
    model = lm_scores.train(train, tokenizer("piece_bpe_32k.model"), frequent)
    found = lm_scores.score(rows, model).collect()
    tokens = [(i, [*words_of(t), None]) for i, t in enumerate(texts)]
    tokens += [(i, [*words_of(t), None]) for i, t, *_ in odd_rows]
    counts = Counter(w for _, t in tokens[:40] + tokens[60:] for w in t)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (i is None, i or 0, len(t), sum(w in counts for w in t),
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
        for i, t in tokens
    )
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"],
         round(r["base_score"], 6))
        for r in found
    )
    assert got == expected
    assert {r["train_tokens"] for r in found} == {n}
    assert all(r["score"] < 0 for r in found)


def test_scores_do_not_depend_on_where_words_are_scored(llm):
    rng = random.Random(2)
    rows = docs_frame(llm, [sentence(rng, 30) for _ in range(30)])
    path = tokenizer("piece_bpe_32k.model")
    both = []
    for frequent in (1 << 16, 10):
        model = lm_scores.train(rows, path, frequent)
        both.append({r["doc_id"]: r["score"] for r in lm_scores.score(rows, model).collect()})
    assert both[0] == pytest.approx(both[1])


def test_word_probabilities_do_not_exceed_one(llm):
    rng = random.Random(4)
    rows = docs_frame(llm, [sentence(rng, 30) for _ in range(30)])
    model = lm_scores.train(rows, tokenizer("piece_bpe_32k.model"))
    seen = model.counts.collect()
    known = {r["word"]: r["n"] for r in seen}
    new = {"".join(p) for k in (1, 2) for p in itertools.product("abcdefghinorst", repeat=k)}
    words = sorted(known) + sorted(new - set(known))
    data, offsets = lattice._joined([w.encode() for w in words])
    n = np.array([known.get(w, 0) for w in words], dtype=float)
    logs = lm_scores._word_scores(n, lattice.word_logs(data, offsets, model.pieces), model)[1]
    end = (model.ends - model.discount) / model.tokens
    assert 0.5 < (10**logs).sum() + end <= 1


def test_scores_without_training(llm, odd, empty):
    path = tokenizer("piece_bpe_32k.model")
    model = lm_scores.train(empty, path)
    found = lm_scores.score(odd, model).collect()
    assert len(found) == 16
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in found)
    assert lm_scores.score(empty, model).collect() == []


def test_pieces_are_learned_from_all_words_in_every_round(llm):
    rng, path = random.Random(8), tokenizer("piece_bpe_32k.model")
    words = sorted({"".join(rng.choices("abdeilnorstu", k=rng.randint(4, 8))) for _ in range(24_000)})
    assert len(words) > 20_000
    data, offsets = lattice._joined([w.encode() for w in words])
    wanted = lattice.load_pieces(path)
    for _ in range(lm_scores.ROUNDS):
        found = lattice.expected_counts(data, offsets, np.ones(len(words)), wanted)
        wanted = lattice.from_counts(wanted, found)
    counts = llm.createDataFrame([(w, 1) for w in words], "word string, n bigint").repartition(3)
    assert lm_scores.learn_pieces(counts, path).logs == pytest.approx(wanted.logs)


def chain_by_hand(score, transition):
    """P(toxic) of every token of one text, over all taggings."""
    total, toxic = 0.0, np.zeros(len(score))
    for tags in itertools.product([0, 1], repeat=len(score)):
        value = transition[2, tags[0]] + sum(s * t for s, t in zip(score, tags, strict=True))
        value += sum(transition[a, b] for a, b in itertools.pairwise(tags))
        total += math.exp(value)
        toxic += np.array(tags) * math.exp(value)
    return toxic / total


def test_marginals_match_all_taggings(monkeypatch):
    monkeypatch.setattr(toxicity, "_COLUMN", 4)
    rng = np.random.default_rng(0)
    sizes = [1, 9, 2, 10, 5]
    scores = [rng.normal(size=n) * 3 for n in sizes]
    transition = rng.normal(size=(3, 2))
    heads = np.cumsum([0, *sizes[:-1]])
    got, joint, _ = toxicity._marginals(np.concatenate(scores), heads, transition)
    assert got == pytest.approx(np.concatenate([chain_by_hand(s, transition) for s in scores]))
    assert joint.sum(axis=(1, 2)) == pytest.approx(np.ones(len(joint)))


def test_toxic_words_are_found(llm):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        w = sentence(rng, 30).split()
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["Vilex!", "snarf", "(grubbo)"]))
        rows.append((i, " ".join(w), int(bad)))
    schema = "doc_id bigint, text string, toxic int"
    frame = llm.createDataFrame(rows, schema)
    model = toxicity.train(frame.where("doc_id < 400"))
    found = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    wrong = tokens = 0
    for i, text, bad in rows[400:]:
        assert (found[i]["score"] >= 0.7) == bool(bad)
        tagged = Counter(text[s["start"] : s["end"]] for s in found[i]["spans"])
        toxic = Counter(w for w in text.split() if w in ("Vilex!", "snarf", "(grubbo)"))
        assert toxic <= tagged
        wrong += (tagged - toxic).total()
        tokens += len(text.split())
    assert wrong <= tokens / 500  # chance words of a small training set


def test_toxicity_of_odd_rows(llm, odd, empty):
    model = toxicity.train(odd)
    found = toxicity.score(odd, model).collect()
    assert len(found) == 16 and all(0 <= r["score"] <= 1 for r in found)
    untrained = toxicity.train(empty)
    assert {r["score"] for r in toxicity.score(odd, untrained).collect()} == {0.0}
    assert toxicity.score(empty, model).collect() == []


def test_languages_held_out(llm):
    rng = random.Random(7)
    parts = {"aa": ["ka", "to", "mi", "ne"], "bb": ["sch", "ung", "ei", "ver"], "cc": ["ça", "é", "oi"]}
    rows = []
    for i in range(300):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(25)]
        rows.append((i, " ".join(words), lang))
    frame = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(frame.where("doc_id < 200"))
    odd = docs_frame(llm, [None, "", "123 !?", "ЖЩЮЯ ЪЫЭ" * 30, "to", "é"], 1000)
    found = {
        r["doc_id"]: r
        for r in language.identify(frame.select("doc_id", "text").union(odd), model).collect()
    }
    for i, _, lang in rows:
        assert found[i]["lang_pred"] == lang and not found[i]["rejected"]
        assert 0 < found[i]["score"] <= 1
    for i in (1000, 1001, 1002):
        assert found[i]["lang_pred"] == "und" and found[i]["rejected"]
    assert found[1003]["rejected"] and found[1003]["lang_pred"] in parts
    assert found[1004]["lang_pred"] == "aa" and not found[1004]["rejected"]
    kept = language.accept(frame.union(odd.selectExpr("*", "'x'")), model, "lang")
    assert kept.count() == 302 and kept.columns == ["doc_id", "text", "lang"]


def test_languages_of_odd_rows(llm, odd, empty):
    found = language.identify(odd, language.train(odd)).collect()
    assert len(found) == 16
    assert {r["lang_pred"] for r in found} == {"en", "und"}
    nothing = language.train(empty)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.identify(empty, nothing).collect() == []


def test_hash_sample_keeps_to_its_bound(llm):
    rows = llm.range(1000).selectExpr("id as doc_id", "if(id < 990, 'a', 'b') as lang")
    counts = Counter(r["lang"] for r in hash_sample(rows, "lang", 50, 1).collect())
    assert counts["b"] == 10 and 25 <= counts["a"] <= 50


def plain_lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y):
            last, row[j + 1] = row[j + 1], last + 1 if a == b else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_matches_the_table():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = (rng.integers(0, 6, size=rng.integers(0, 30)) for _ in range(2))
        assert decontamination.lcs(x, y) == plain_lcs(x.tolist(), y.tolist())


def benchmark_frame(llm, texts):
    rows = [(100 + i, t, "x") for i, t in enumerate(texts)]
    return llm.createDataFrame(rows, "item_id bigint, text string, cosine string")


def test_leaks_and_paraphrases(llm, monkeypatch):
    rng = random.Random(8)
    items = [sentence(rng, rng.choice([15, 30, 50])) + ". " + sentence(rng, 6) + "." for _ in range(30)]
    texts = [sentence(rng, rng.choice([20, 200])) for _ in range(150)]
    planted = {}
    for d in range(0, 150, 5):
        item = rng.randrange(30)
        w = items[item].upper().split()
        for k in range(0, len(w) - 8, 9):
            w[k] = sentence(rng, 1)  # a changed word in nine
        at = rng.randrange(len(texts[d].split()))
        own = texts[d].split()
        texts[d] = " ".join(own[:at] + w + own[at:])
        planted[d] = 100 + item
    docs, benchmark = docs_frame(llm, texts), benchmark_frame(llm, [*items, None, "", "a b"])
    for most in (decontamination.ITEMS, 20):
        monkeypatch.setattr(decontamination, "ITEMS", most)
        found = decontamination.leaks(docs, benchmark).collect()
        assert {r["doc_id"]: r["item_id"] for r in found} == planted
        assert len(found) == len(planted)
    kept = decontamination.decontaminate(docs, benchmark)
    assert {r["doc_id"] for r in kept.collect()} == set(range(150)) - set(planted)


def test_no_item_of_a_large_benchmark_is_lost(llm):
    rng = random.Random(18)
    vocabulary = sentence(rng, 2_000).split()
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([16, 30, 59]))) for _ in range(1_100)]
    hosts = [rng.choices(vocabulary, k=200) for _ in range(40)]
    texts = []
    for item in items:
        host = rng.choice(hosts)
        at = rng.randrange(len(host))
        texts.append(" ".join([*host[:at], item, *host[at:]]))
    docs, benchmark = docs_frame(llm, texts), benchmark_frame(llm, items)
    found = decontamination.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, 100 + i) for i in range(1_100)]
    assert {r["lcs_share"] for r in found} == {1.0}
    assert all(0 <= r["cosine"] < 1.001 for r in found)


def reworded(rng, text):
    """The sentences but the last in another order, and their words in another order."""
    *parts, answer = text.split(". ")
    parts = [" ".join(rng.sample(part.split(), len(part.split()))) for part in parts]
    return ". ".join([*rng.sample(parts, len(parts)), answer])


def test_paraphrases_with_the_answer_kept_are_found(llm):
    rng = random.Random(77)
    words = sorted({w for _ in range(40) for w in sentence(rng, 100).split() if len(w) > 3})
    items, docs, less = [], [], 0
    for i in range(60):
        sizes = [rng.randint(5, 9) for _ in range(rng.randint(2, 4))]
        said = [" ".join(rng.choices(words, k=n)) for n in (*sizes, 7)]
        items.append((i, ". ".join(said) + "."))
        text = reworded(rng, items[-1][1])
        known = decontamination._item(0, items[-1][1]).words
        less += decontamination.lcs(known, decontamination._item(0, text).words) < 0.7 * len(known)
        ends = [" ".join(rng.choices(words, k=rng.randint(20, 200))) for _ in range(2)]
        docs.append((i, f"{ends[0]} {text} {ends[1]}"))
    clean = [(1000 + i, " ".join(rng.choices(words, k=300))) for i in range(200)]
    # An answer alone, and an item without its answer, are no paraphrase.
    clean += [(2000 + i, f"{clean[i][1]} {t.split('. ')[-1]}") for i, t in items[:30]]
    found = decontamination.leaks(
        llm.createDataFrame(docs + clean, "doc_id bigint, text string").repartition(3),
        llm.createDataFrame(items, "item_id bigint, text string"),
    ).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert less > 50
    assert all(a == b for a, b in pairs) and len(pairs) >= 54
    assert sum(r.lcs_share < 0.7 for r in found) >= 45


def test_directions_are_those_of_an_exact_decomposition(llm):
    rng = random.Random(12)
    items = [(i, sentence(rng, 40)) for i in range(60)]
    frame = llm.createDataFrame(items, "item_id bigint, text string").repartition(3)
    part = next(slices(pa.array([t for _, t in items], pa.large_string())))
    coded = decontamination._coded(part)
    weights = np.random.default_rng(1).uniform(1, 5, decontamination.WIDTH)
    row, place, value, rows = decontamination._matrix(coded, weights)
    exact = np.zeros((rows, decontamination.WIDTH), dtype=np.float64)
    exact[row, place] = value
    places = np.unique(coded.places)
    rank, directions = decontamination.basis(frame, places, weights, most=20)
    best = (np.linalg.svd(exact[:, places], compute_uv=False)[:20] ** 2).sum()
    held = ((exact[:, places] @ directions) ** 2).sum()
    assert (rank[places] == np.arange(len(places))).all() and held > 0.9 * best
    assert np.allclose(directions.T @ directions, np.eye(20), atol=1e-4)


def test_short_items_are_found_whole(llm):
    rng = random.Random(21)
    vocabulary = list(dict.fromkeys(sentence(rng, 3_000).split()))
    sizes = [1, 2, 5, 7, *range(8, 21)] * 3
    words = iter(rng.sample(vocabulary, sum(sizes)))
    items = [[next(words) for _ in range(n)] for n in sizes]
    other = [w for w in vocabulary if w not in {x for item in items for x in item}]
    texts = []
    for item in items:
        host, at = rng.choices(other, k=200), rng.randrange(200)
        texts.append(" ".join([*host[:at], *item, *host[at:]]))
    texts += [" ".join(item) for item in items]
    texts += [" ".join([*item[:-1], "x", item[-1]]) for item in items if 1 < len(item) < 8]
    benchmark = benchmark_frame(llm, [" ".join(item) for item in items])
    found = decontamination.leaks(docs_frame(llm, texts), benchmark).collect()
    expected = [(i, 100 + i % len(items)) for i in range(2 * len(items))]
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == expected
    split = llm.createDataFrame([(1, " ".join(items[1])), (2, items[1][0]), (3, items[1][1])],
                                "doc_id bigint, text string")
    short = benchmark_frame(llm, [" ".join(items[1])])
    assert [r["doc_id"] for r in decontamination.leaks(split, short).collect()] == [1]


def test_a_changed_or_missing_answer_hides_no_copy(llm):
    rng = random.Random(22)
    vocabulary = sentence(rng, 2_000).split()
    items, texts = [], []
    for i in range(12):
        body, end = rng.choices(vocabulary, k=24), [f"end{i}", "b", "c", "d", "e", "f"][: 1 + i % 6]
        items.append(f"{' '.join(body)}. {' '.join(end)}.")
        kept = body + [[], ["other"] * len(end)][i // 6]
        texts.append(" ".join(rng.choices(vocabulary, k=90) + kept + rng.choices(vocabulary, k=90)))
    body = rng.choices(vocabulary, k=22)
    items.append(" ".join(body) + ". one two three four five six.")
    holes = ["x" if k == 11 else w for k, w in enumerate(body)]
    texts.append(" ".join(holes + ["another", "answer", "here"]))  # 21 of 28, not in one run
    texts.append(" ".join(holes + ["one", "two", "three"]))
    found = decontamination.leaks(docs_frame(llm, texts), benchmark_frame(llm, items)).collect()
    expected = [(i, 100 + i) for i in range(12)] + [(13, 112)]
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == expected


def test_leaks_of_odd_rows(llm, odd, empty):
    benchmark = benchmark_frame(llm, ["zero one two three four five six seven"])
    none = benchmark_frame(llm, ["a"]).limit(0)
    assert len(decontamination.leaks(odd, benchmark).collect()) == 4
    kept = decontamination.decontaminate(odd, benchmark)
    assert kept.count() == 12 and kept.columns == odd.columns
    assert decontamination.leaks(odd, none).collect() == []
    assert decontamination.leaks(empty, benchmark).collect() == []


def test_remainder_is_crc32_of_the_id(llm):
    from pactline.llm.common import remainder

    rows = llm.createDataFrame([(i,) for i in (0, 7, -3, 10**12)], "doc_id bigint")
    for r in rows.withColumn("m", remainder(7)).collect():
        assert r["m"] == zlib.crc32(str(r["doc_id"]).encode()) % 7
