import random
from collections import Counter

import pytest
from llm_texts import sentence
from test_dedup import near_by_hand
from test_mixing import mix_by_hand

import corpus_pipeline
from pactline.llm.common import written
from pactline.llm.queries import tokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(llm, tmp_path_factory):
    """Clean documents, copies, leaks and texts of no language, in a folder of tables."""
    rng = random.Random(12)
    items = [sentence(rng, 30) for _ in range(5)]
    base = [sentence(rng, rng.choice([40, 90])) for _ in range(120)]
    texts = base + [f"{rng.choice(base)} {sentence(rng, 1)}" for _ in range(20)]
    texts += [f"{sentence(rng, 20)} {i} {sentence(rng, 9)}" for i in items]
    texts += [None, "", "123 456 !?", "ЖЩЮЯЪЫЭФ " * 50]
    rows = [
        (i, t, "en" if i % 9 and i < 145 else None, f"s{i % 4}" if i % 4 else None, len(t or ""))
        for i, t in enumerate(texts)
    ]
    folder = str(tmp_path_factory.mktemp("tables"))
    llm.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    benchmark = [(i, t) for i, t in enumerate(items)]
    llm.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder, rows


def test_stages_against_brute_force(llm, corpus):
    folder, rows = corpus
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        found = written(stages[name](llm, docs, folder), "test")
        if name != "token_files":
            assert found.columns == list(corpus_pipeline.COLUMNS)
        return found, sorted(tuple(r) for r in found.collect())

    docs, kept = step("language", docs)
    assert [r[0] for r in kept] == list(range(145))
    docs, kept = step("near_dedup", docs)
    by_hand = near_by_hand([t for _, t, *_ in rows[:145]], 5)
    assert [r[0] for r in kept] == [i for i, _, _, own in by_hand if own]
    docs, kept = step("decontamination", docs)
    assert [r[0] for r in kept] == [i for i, _, _, own in by_hand if own and i < 140]
    before = kept
    docs, kept = step("mixing", docs)
    expected = mix_by_hand([(i, s, len(t.split())) for i, t, _, s, _ in before])
    words = Counter()
    for i, t, *_ in kept:
        words[i] += len(t.split())
    assert words == Counter({i: taken for (i, *_, taken), n in expected.items() if taken})
    _, ids = step("token_files", docs)
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer()).encode
    counts = sorted((i, len(encode(t, add_special_tokens=False).ids) + 1) for i, t, *_ in kept)
    assert sorted((r[0], r[2]) for r in ids) == counts


def test_run_gives_the_last_stage(llm, corpus):
    folder, _ = corpus
    found = corpus_pipeline.run(llm, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = found.orderBy("start").collect()
    assert rows and rows[0]["start"] == 0
    for a, b in zip(rows, rows[1:]):
        assert a["start"] + a["n_tokens"] == b["start"]


def test_stages_take_odd_rows(llm, odd, empty, corpus):
    folder, _ = corpus
    for start in (odd, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(llm, docs, folder), f"odd-{name}")
        assert docs.columns[0] == "doc_id"
        assert (docs.count() > 0) == (start is odd)


def test_repeated_documents_stay_once(llm, corpus):
    folder, _ = corpus
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, "x", "en", "s", 1)]
    docs = llm.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.drop_near_duplicates(llm, docs, folder).collect()
    assert sorted((r["doc_id"] is None, r["text"]) for r in found) == [(False, "a b c"), (True, "x")]


def test_other_texts_of_a_repeated_id_stay(llm, corpus):
    folder, _ = corpus
    rng = random.Random(14)
    a, b, c, d = (sentence(rng, 40) for _ in range(4))
    rows = [
        (1, a, "en", "s", 5), (1, b, "en", "s", 5), (1, b, "en", "s", 5), (1, None, "en", "s", 0),
        (2, c, "en", "t", 5), (2, f"{a} more", "en", "t", 5), (3, f"{c} more", None, None, None),
        (-4, d, "en", "t", 5), (-4, d, "en", "s", 5), (5, d, "en", "s", 5),
    ]
    docs = llm.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.drop_near_duplicates(llm, docs, folder)
    assert found.columns == list(corpus_pipeline.COLUMNS)
    expected = [rows[0], rows[1], rows[3], rows[4], rows[8]]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_queries_register_with_the_package():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert {n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)} == set()
    assert {"op2_near_duplicates", "op3_substring_dedup"} <= set(entry.oracle_sql())
