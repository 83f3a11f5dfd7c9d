"""Common extensions, runs and collapsed texts, against plain loops."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from guardwork.llm import periodic_runs as pr
from guardwork.llm.queries import LLM_QUERIES, periodic_runs_query


def plain_runs(words, repeats=4, least=6):
    """start, period and length of all runs."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((start, q, end - start) for (start, end), q in found.items())


def found_runs(words, **options):
    runs = pr.find_runs(np.array(words, np.int64), **options)
    return list(zip(runs.starts.tolist(), runs.periods.tolist(), runs.lengths.tolist(), strict=True))


def planted(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n else 0):
        start, period = rng.randrange(n), rng.randrange(1, max(2, n // 4))
        for i in range(start + period, min(n, start + period * rng.randrange(3, 9))):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("modulus", [2, 4, 8, 32, 64])
def test_cover_has_all_differences(modulus):
    cover, anchor = pr.difference_cover(modulus)
    assert all(anchor[d] in cover and (anchor[d] + d) % modulus in cover for d in range(modulus))
    assert len(cover) <= 2.5 * modulus**0.5 + 1


@pytest.mark.parametrize("modulus", [4, 32])
def test_common_extensions(modulus):
    rng = random.Random(modulus)
    for _ in range(60):
        n = rng.randrange(1, 300)
        words = [int(rng.random() < 0.05) for _ in range(n)]
        pairs = [(i, j) for i, j in ((rng.randrange(n + 1), rng.randrange(n + 1)) for _ in range(60)) if i != j]
        if not pairs:
            continue
        left, right = np.array(pairs).T

        def plain(i, j):
            k = 0
            while max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            return k

        assert pr.CommonExtensions(np.array(words), modulus).of(left, right).tolist() == [plain(i, j) for i, j in pairs]


def test_runs_against_plain_loops(monkeypatch):
    rng = random.Random(13)
    for pairs in (1 << 18, 40):
        monkeypatch.setattr(pr, "PAIRS", pairs)
        for _ in range(600):
            words = planted(rng, rng.randrange(150), rng.choice([1, 2, 3, 20]))
            assert found_runs(words) == plain_runs(words), words


def test_other_limits():
    rng = random.Random(14)
    for repeats, least in ((5, 1), (4, 1), (7, 30)):
        for _ in range(100):
            words = planted(rng, rng.randrange(120), 2)
            assert found_runs(words, repeats=repeats, least=least) == plain_runs(words, repeats, least)
    with pytest.raises(ValueError):
        pr.find_runs(np.zeros(9, np.int64), repeats=3)


def test_long_run_among_many_words():
    words = np.arange(300_000)
    words[1000:201_000] = 7 + np.arange(200_000) % 9_999
    runs = pr.find_runs(words)
    assert (9_999, 200_000) in zip(runs.periods.tolist(), runs.lengths.tolist(), strict=True)


def plain_report(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for start, q, length in runs for i in range(start + q, start + length)}
    best = (None, None, None)
    for start, q, length in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    lines = "".join(f"{start},{length},{q}\n" for start, q, length in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_on_all_documents(spark, small):
    rows = LLM_QUERIES["op13_periodic_runs"](spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    expected = [plain_report(d.doc_id, d.text) for d in docs]
    assert by_text(rows) == by_text(expected)
    assert sum(r.n_runs for r in rows) > 5


def test_query_on_awkward_documents(awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    rows = periodic_runs_query(awkward.sparkSession, str(tmp_path)).collect()
    assert by_text(rows) == by_text([plain_report(d.doc_id, d.text) for d in awkward.collect()])


def test_operator_keeps_columns_and_returns_texts(documents):
    docs = documents(["a b " * 5 + "c", None, "", "  x\ty ", "same " * 7, "no run here"], clashing=True)
    rows = pr.collapse_runs(docs.withColumnRenamed("kept", "runs")).orderBy("doc_id").collect()
    assert [r.collapsed for r in rows] == ["a b c", "", "", "x y", "same", "no run here"]
    assert [[tuple(x) for x in r.runs] for r in rows] == [[(0, 10, 2)], [], [], [], [(0, 7, 1)], []]
    assert rows[0].spans == "taken"


def test_empty_table(documents):
    assert pr.collapse_runs(documents()).collect() == []
