import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pactline.llm import simple8b, token_counts, token_files
from pactline.llm.encoder import Encoder
from pactline.llm.queries import tokenizer
from pactline.session import shared_folder


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer())
    found.encode_special_tokens = True
    return lambda t: found.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)),
                max_size=3000))
def test_simple8b_round_trip(values):
    values = np.array(values, dtype=np.uint64)
    words, offsets = simple8b.pack(values)
    assert simple8b.unpack(words, offsets, len(values)).tolist() == values.tolist()


def test_simple8b_packs_small_values_together():
    words, _ = simple8b.pack(np.zeros(2400, dtype=np.uint64))
    assert len(words) == 5 + 5 + 2  # two full blocks and the rest of the third


def test_new_chunks_share_calls_of_the_library(reference):
    import pyarrow as pa

    from pactline.llm.words import slices

    words = [f"{'abcdefgh'[n % 8]}{n}é" for n in range(3000)]
    texts = [" ".join(words), "\t".join(reversed(words)) + " \t", " \x85 a  b", "", "c\x1c d\n\n e"]
    coder, sent = Encoder(tokenizer()), []
    alone = coder._encode
    coder._encode = lambda texts: sent.extend(texts) or alone(texts)
    (part,) = slices(pa.array(texts))
    ids, counts = coder.encode(part)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [reference(t) for t in texts]
    assert len(sent) < 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab' 1\n\t!é 　\x1c日<|>", max_size=40), max_size=8))
def test_chunks_encode_like_whole_texts(reference, texts):
    import pyarrow as pa

    from pactline.llm.words import slices

    coder = _coder()
    got = []
    for part in slices(pa.array(texts, pa.string()), 50):
        flat, counts = coder.encode(part)
        got += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [reference(t) for t in texts]


_made = []


def _coder():
    if not _made:
        _made.append(Encoder(tokenizer()))
    return _made[0]


def _written(spark, docs):
    path = shared_folder(spark, "test-tokens")
    token_files.write_tokens(docs, path, tokenizer(), shards=3)
    return token_files.read_tokens(spark, path, with_ids=True)


def test_files_hold_every_text(llm, odd, odd_rows, reference):
    found = _written(llm, odd).orderBy("start").collect()
    assert len(found) == len(odd_rows)
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == Counter(
        (i, (*reference(t), 0)) for i, t, *_ in odd_rows
    )
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_no_documents_no_files(llm, empty):
    assert _written(llm, empty).collect() == []


def test_histogram_and_suffix_sums(llm, odd, odd_rows, reference):
    lengths = [len(reference(t)) for _, t, *_ in odd_rows]
    found = token_counts.suffix_sums(token_counts.length_histogram(odd, tokenizer())).cache()
    rows = {r["n_tokens"]: r for r in found.collect()}
    assert {k: r["n_docs"] for k, r in rows.items()} == Counter(lengths)
    for limit, r in rows.items():
        assert r["docs_longer"] == sum(x > limit for x in lengths)
        assert r["tokens_longer"] == sum(x for x in lengths if x > limit)
        assert r["kept_tokens"] == sum(min(x, limit) for x in lengths)
        assert r["kept_tokens"] + r["lost_tokens"] == r["total_tokens"] == sum(lengths)
        assert r["quantile"] == pytest.approx(sum(x <= limit for x in lengths) / len(lengths))
    for r in token_counts.at_limits(found, [0, 3, 6, 10**9]).collect():
        assert r["kept_tokens"] == sum(min(x, r["limit"]) for x in lengths)
        assert r["docs_longer"] == sum(x > r["limit"] for x in lengths)
    median = token_counts.at_quantiles(found, [0.5]).first()["n_tokens"]
    assert median == sorted(lengths)[(len(lengths) + 1) // 2 - 1]


def test_lengths_of_nothing(llm, empty):
    found = token_counts.suffix_sums(token_counts.length_histogram(empty, tokenizer()))
    assert found.where(F.lit(True)).collect() == []
