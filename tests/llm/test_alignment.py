import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_texts import docs_frame, sentence
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from pactline.llm import alignment
from pactline.llm.queries import tokenizer

BYTE, PIECE = tokenizer(), tokenizer("piece_bpe_32k.model")


def whole_tokens(text):
    """Ids and bytes of both tokenizers' tokens of one whole text, or nothing."""
    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    if not text:
        return [], []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    sign = {
        token: bytes([byte])
        for byte in range(256)
        for token in [ByteLevel(add_prefix_space=False).pre_tokenize_str(chr(byte))[0][0]]
        if byte < 128
    }
    made_a = [(i, a.id_to_token(i)) for i in ids_a]
    made_a = [(i, b"".join(sign.get(c) or _high(c) for c in t)) for i, t in made_a]
    made_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        made_b.append(
            (i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        )
    want = (" " + text).encode()
    if b"".join(x for _, x in made_a) != want or b"".join(x for _, x in made_b) != want:
        return [], []
    return made_a, made_b


def _high(letter):
    """The byte from 128 on that a letter of byte-level BPE stands for."""
    if ord(letter) < 256:
        return bytes([ord(letter)])
    rest = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)]
    return bytes([rest[ord(letter) - 256]])


def brute_force(docs):
    made, held = [], Counter()
    for i, text in docs:
        tokens_a, tokens_b = whole_tokens(text)
        spans = []
        for tokens in (tokens_a, tokens_b):
            at, out = 0, []
            for token, data in tokens:
                out.append((token, at, at + len(data)))
                at += len(data)
            spans.append(out)
        links = [
            (a, b) for a, s, e in spans[0] for b, t, f in spans[1] if max(s, t) < min(e, f)
        ]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            sides = [",".join(str(x) for x, s, e in side if low < e <= cut) for side in spans]
            groups.append("|".join(sides))
            low = cut
        held.update(set(links))
        made.append((i, spans, groups, links))
    top = Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [
        (
            i, len(spans[0]), len(spans[1]), len(groups), len(links),
            sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, spans, groups, links in made
    ]


def key(row):
    return [(x is None, str(x)) for x in row]


TEXTS = [
    None, "", " ", "  ", "a ", " a", "a  b", "a\n b\n\n c \t d", "\n", "tab\tand\rmore \x0b \x0c x",
    "U+2581 ▁ inside", "naïve café über straße", "日本語 テキスト　é", "x\xa0 y\xa0z",
    "<s> hi </s> <unk> <0x41> <|endoftext|> [CLS]", "emoji 👍🏽 done", "nul\x00byte", "é ﬁ ①",
    "1234567890 3.14159 a_b-c", "don't we'll THE The the", "word" * 50, "x" * 3000,
    "Привет, мир! ещё раз", "line one\nline two\n", " lead and trail  ",
]


@pytest.mark.parametrize("head", [0, 40, alignment.HEAD])
def test_equals_whole_texts(llm, head):
    rng = random.Random(5)
    docs = list(enumerate([*TEXTS, *(sentence(rng, n) for n in (1, 5, 30, 30, 200))]))
    docs += [(3, "the same id"), (None, "no id"), (None, "no id")]
    frame = llm.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    rows = [tuple(r) for r in alignment.align_documents(frame, BYTE, PIECE, head).collect()]
    assert sorted(rows, key=key) == sorted(brute_force(docs), key=key)


def test_pointer_jumping_finds_common_ends():
    rng = np.random.default_rng(2)
    for _ in range(200):
        ends = [
            np.append(np.flatnonzero(rng.random(40) < p), 40) + 1 for p in rng.random(2)
        ]
        found = alignment.terminals(*ends)
        both = np.intersect1d(*ends)
        for mine, last in zip(ends, found, strict=True):
            assert (ends[0][last] == both[np.searchsorted(both, mine)]).all()


def test_worker_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 20_000)
    import pyarrow as pa

    from pactline.llm.words import slices

    rng, worker = random.Random(9), alignment.Aligner(BYTE, PIECE)
    for _ in range(20):
        made = [sentence(rng, 60) for _ in range(10)]
        (part,) = slices(pa.array(made))
        found = worker.documents(part)
        fresh = alignment.Aligner(BYTE, PIECE).documents(part)
        assert found.digests == fresh.digests and (found.pairs == fresh.pairs).all()
        assert worker.held < 200_000


def test_meeting_hashes_change_nothing(monkeypatch):
    import pyarrow as pa

    from pactline.llm.words import slices, span_hashes

    (part,) = slices(pa.array(["one two three", "four five", "one two"]))
    want = alignment.Aligner(BYTE, PIECE).documents(part)
    monkeypatch.setattr(
        alignment, "span_hashes", lambda d, s, e, lane=0: span_hashes(d, s, e, lane=lane) >> (
            np.uint64(63) if lane == 0 else np.uint64(0)
        ),
    )
    found = alignment.Aligner(BYTE, PIECE).documents(part)
    assert found.digests == want.digests and (found.links == want.links).all()


def test_odd_rows(odd, odd_rows):
    rows = alignment.align_documents(odd, BYTE, PIECE).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r.n_a > 0 for r in rows) == sorted(bool(r[1]) for r in odd_rows)


def test_many_documents(llm):
    rng = random.Random(8)
    made = [sentence(rng, rng.randint(1, 30)) for _ in range(60)]
    rows = alignment.align_documents(docs_frame(llm, made), BYTE, PIECE).collect()
    assert sorted(map(tuple, rows)) == sorted(brute_force(enumerate(made)))


def test_empty_table(empty):
    assert alignment.align_documents(empty, BYTE, PIECE).count() == 0
