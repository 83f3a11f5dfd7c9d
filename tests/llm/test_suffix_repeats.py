"""Repeated strings against all strings of all documents."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from guardwork.llm import suffix_repeats as sr
from guardwork.llm.queries import LLM_QUERIES


def expected(docs, length):
    texts = [(d.doc_id, (d.text or "").encode()) for d in docs]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        covered = np.cumsum(gone)[: len(t)] > 0
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = int((covered & ~np.concatenate(([False], covered[:-1]))).sum()) if len(t) else 0
        out.append((doc_id, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(df, length):
    rows = sr.repeats_report(df, length).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected(df.collect(), length)
    assert all(r.n_kept == r.n_bytes - r.n_removed for r in rows)
    return rows


def texts_with_passages(rng, n, alphabet="abcdefgh"):
    passages = ["".join(rng.choices(alphabet, k=rng.randint(20, 120))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randint(0, 80))))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("length", [12, 40])
def test_passages(documents, length):
    texts = texts_with_passages(random.Random(length), 60)
    assert any(r.n_removed for r in check(documents(texts + texts[:3]), length))


def test_crowded_anchors_are_dealt_out_anew(documents, monkeypatch):
    """One passage within many different texts; few runs of an anchor are sorted in one task."""
    monkeypatch.setattr(sr, "MOST_RUNS", 3)
    rng = random.Random(14)
    passage = "".join(rng.choices("abcdefgh", k=38))
    texts = []
    for _ in range(60):
        before, after = ("".join(rng.choices("xyz", k=rng.randint(0, 6))) for _ in range(2))
        texts.append(before + passage + after)
    check(documents(texts), 40)


def test_runs_and_overlaps_within_one_text(documents):
    check(documents(["a" * 100, "ab" * 60, "abcabcabcabcabcabcabcabc", "x" * 19, "x" * 20, "x" * 21]), 20)


def test_characters_of_several_bytes(documents):
    check(documents(["é東😀" * 20, "東😀é" * 20, "日本語 текст"]), 13)


def test_awkward_documents(awkward):
    check(awkward, 400)
    check(awkward, 25)


def test_a_long_text_is_read_in_parts(documents, monkeypatch):
    monkeypatch.setattr(sr, "_PIECE", 64)
    monkeypatch.setattr(sr, "BLOCK_BYTES", 200)
    rng = random.Random(15)
    check(documents(texts_with_passages(rng, 8) + ["".join(texts_with_passages(rng, 8))]), 30)


def test_query_on_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = LLM_QUERIES["op10_suffix_repeats"](spark, small).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected(docs, 400)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in rows if "\ufffd" not in r.text)


def test_suffixes_are_sorted_as_bytes_are():
    rng = random.Random(16)
    length = 9
    data = bytes(rng.choices(b"ab", k=300))
    at = np.arange(len(data) - length)
    sets = np.sort(np.array([rng.randrange(7) for _ in at]))
    found = sr.Suffixes(np.frombuffer(data, np.uint8), length).sorted_within(at, sets)
    for s in range(7):
        got = [data[i : i + length] for i in found[sets == s]]
        assert got == sorted(data[i : i + length] for i in at[sets == s])
        assert sorted(found[sets == s]) == at[sets == s].tolist()


def test_a_collision_is_seen_and_settled_by_bytes(monkeypatch):
    """With every hash equal, all strings of a set look equal until their bytes are compared."""
    monkeypatch.setattr(sr, "prefix_hashes", lambda data: np.zeros(len(data) + 1, np.uint64))
    contents = [b"abcdefgh", b"abcdefgX", b"abcdefgh"]
    flags = sr.repeated_starts(np.zeros(3, int), np.zeros(3, int), np.ones(3, int), contents, 8)
    assert flags.tolist() == [True, False, True]


def test_a_large_batch_is_sorted_in_lots(monkeypatch):
    """Whole anchors of few runs at a time, however many rows a batch has."""
    monkeypatch.setattr(sr, "_SORT_RUNS", 10)
    rng = random.Random(17)
    anchors = np.sort(np.array([rng.randrange(60) for _ in range(400)]))
    rows = pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(range(400))], names=["anchor", "row"])
    lots = [lot.to_pydict() for lot in sr._lots(iter([rows.slice(0, 310), rows.slice(310, 1), rows.slice(311)]))]
    assert sum((lot["row"] for lot in lots), []) == list(range(400))
    assert sum((sorted(set(lot["anchor"])) for lot in lots), []) == sorted(set(anchors.tolist()))
    assert max(len(lot["row"]) for lot in lots) < 10 + max(Counter(anchors.tolist()).values())


def test_empty_table(documents):
    assert sr.repeats_report(documents(), 400).collect() == []
