"""Near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from guardwork.llm import near_duplicates as nd
from guardwork.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, size=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def expected(docs, size=4):
    sets = [(i, shingles(t, size)) for i, t in docs]
    above = {i: i for i, _ in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and 100 * len(s & t) >= 80 * len(s | t):
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return {i: (i, len(s), top(i), top(i) == i) for i, s in sets}


def check(df):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = nd.near_duplicates(df, 4).collect()
    assert {r.doc_id: tuple(r) for r in rows} == expected(docs)
    assert len(rows) == len(docs)


def family(rng, base, copies, changes):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("tile", [512, 4])
def test_families_of_copies(documents, monkeypatch, tile):
    """Copies of one text that are near some of the others only; with small tiles they meet in pairs."""
    monkeypatch.setattr(nd, "TILE", tile)
    rng = random.Random(5)
    texts = []
    for n in (40, 25, 3):
        texts += family(rng, [f"w{rng.randrange(500)}" for _ in range(120)], n, 7)
    rng.shuffle(texts)
    check(documents(texts))


def test_query_on_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = LLM_QUERIES["op3_near_duplicates"](spark, small).collect()
    assert {r.doc_id: tuple(r) for r in rows} == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_documents(awkward):
    rows = nd.near_duplicates(awkward, 4).collect()
    known = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id is not None]
    want = expected(list(dict(known).items()))
    assert len(rows) == awkward.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert tuple(r) == want[r.doc_id]


def test_borders_of_the_similarity(documents):
    # 4 of 5 shingles in common: 80 percent; 3 of 4: below.
    check(documents(["a b c d e f g", "a b c d e f g h", "p q r s t u", "p q r s t u v", "one", "ONE", "", None]))


def test_signatures_within_the_distance_meet_under_a_key():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, nd.SYMBOLS, np.uint16)
        b = a.copy()
        places = rng.choice(nd.SYMBOLS, 2 * nd.CHUNKS - 1, replace=False)
        b[places] ^= rng.integers(1, 1 << 16, len(places), np.uint16)
        keys = nd.index_keys(np.stack((a, b)))
        assert (keys[0] == keys[1]).any()


def test_components_of_a_long_chain(llm):
    links = llm.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = dict(map(tuple, nd.components(links).collect()))
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_kept_documents_keep_their_columns(awkward):
    kept = nd.without_near_duplicates(awkward, 5)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in nd.near_duplicates(awkward, 5).collect() if r.kept
    }


def test_one_row_of_each_group_stays(documents):
    """Repeated rows and rows without an id are no reason to keep a text more than once."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        *[(1, "repeated text of seven words right here", "en", "a", 1)] * 3,
        (1, "REPEATED text of seven words right here", "de", "b", 2),
        (2, "repeated text of seven words right here", "en", "a", 1),
        *[(None, "a text without an id that is repeated", "en", "a", 1)] * 3,
        (None, "a text WITHOUT an id that is repeated", "en", "b", 1),
        (None, long, "en", "a", 1),
        (None, long + " end", "en", "a", 1),
        (5, long, "en", "a", 1),
        (6, "another text of the id six", "en", "a", 1),
        (6, "nothing is common to both of these", "en", "a", 1),
        *[(None, None, None, None, None)] * 2,
    ]
    kept = nd.without_near_duplicates(documents(rows=rows, clashing=True), 4).collect()
    found = sorted(((r.doc_id, (r.text or "").lower()) for r in kept), key=str)
    assert found == sorted(
        [
            (1, rows[0][1]),
            (5, long),
            (6, "another text of the id six"),
            (6, "nothing is common to both of these"),
            (None, "a text without an id that is repeated"),
            (None, ""),
            (None, ""),
        ],
        key=str,
    )


def test_empty_table(documents):
    assert nd.near_duplicates(documents(), 4).collect() == []
