import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_texts import sentence  # noqa: E402

from pactline.llm.common import prepare  # noqa: E402

ODD_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, "
    "row string, rank string, key string, n bigint, rejected string, text_hash string, "
    "target string, taken string, toxic int"
)


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(3)
    long = " ".join(sentence(rng, 500) for _ in range(60))
    texts = [
        (1, "one two three four five six seven"),
        (1, "one two three four five six seven"),
        (1, "another text under the same id"),
        (2, "One Two Three Four Five Six Seven"),
        (None, "one two three four five six seven"),
        (None, None),
        (3, None),
        (4, ""),
        (5, " \t\n\r\x0b\x0c "),
        (6, long),
        (7, long),
        (8, "x" * 5000),
        (9, "日本語 テキスト　é ü  z"),
        (10, "!!! ### 123"),
        (11, "tab\tand  double  spaces\n\nand lines"),
        (-5, "a negative id"),
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None,
         0.5, "r", "k", "q", 1, "no", "h", "t", "u", None if n % 3 == 0 else n % 2)
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(llm, odd_rows):
    return llm.createDataFrame(odd_rows, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], ODD_SCHEMA)
