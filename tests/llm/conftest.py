"""Documents with every awkward case, for all operators."""

from __future__ import annotations

import pytest

import public_tokenizers
from guardwork.llm.shared import ship_package

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that an operator might use itself.
CLASHING = ("kept", "ids", "decoded", "size", "target", "copies", "spans", "node", "score", "digest", "part", "key_a")

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box quietly near old mills".split()
PROSE = " ".join(WORDS * 6)

AWKWARD = [
    None,
    "",
    " ",
    "\n\t \r\x0b\x0c",
    "one",
    "two words",
    "three small words",
    "exactly four words here",
    PROSE,
    PROSE,
    PROSE + " end",
    PROSE.upper(),
    "naïve façade — 東京 😀  double  spaces \n\nlines\n",
    "a" * 5000,
    "\n".join(["same line again"] * 30),
    "x y　z\x1cq",
    " ".join(f"w{i}" for i in range(3000)),
    "<|endoftext|> is plain text's friend, isn't it? it'll DO",
]


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture
def documents(llm):
    """Documents from texts, with ids 1, 2, ..., or from whole rows."""

    def build(texts=(), rows=(), clashing=False):
        rows = [*rows, *((i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts, 1))]
        df = llm.createDataFrame(rows, DOCUMENTS)
        if clashing:
            for name in CLASHING:
                df = df.selectExpr("*", f"'taken' AS {name}")
        return df

    return build


@pytest.fixture
def awkward(documents):
    """Awkward texts, with null ids and sources and repeated rows, and clashing columns."""
    rows = [(None, "no id at all", None, None, None), (None, PROSE, "en", "s1", 1), (77, PROSE, "en", "s1", 1)] + [
        (78, "said twice over and over by two rows", "de", "s2", None)
    ] * 2
    return documents(AWKWARD, rows, clashing=True)


@pytest.fixture(scope="session")
def byte_ranks():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="session")
def word_tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")
