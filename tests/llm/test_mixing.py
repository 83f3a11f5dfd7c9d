"""The mix against a queue simulated in Python."""

import re
from collections import defaultdict

import pytest

from guardwork.llm import mixing
from guardwork.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Targets by handing out the excess until no source is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    out, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in out]
        rest = total - sum(out.values())
        level = rest / sum(weights[s] for s in free) if free else 0
        above = [s for s in free if level * weights[s] > 3 * sizes[s]]
        if not above:
            return out | {s: level * weights[s] for s in free}
        out |= {s: 3.0 * sizes[s] for s in above}


def check(docs):
    rows = mixing.mix(docs).collect()
    given = [(d.doc_id, d.source, len(WORD.findall(d.text or ""))) for d in docs.collect()]
    assert sorted(((r.doc_id, r.source, r["size"]) for r in rows), key=str) == sorted(given, key=str)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, source, size in given:
        sizes[source] += size
        largest[source] = max(largest[source], size)
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
    # Whole documents: no source is off by more than its own and the others' last documents.
    slack = max(largest.values(), default=0)
    assert sum(sizes.values()) - sum(taken.values()) <= slack or not sizes
    assert sum(taken.values()) <= sum(sizes.values())
    return rows, expected, taken, largest


def test_awkward_documents(awkward):
    check(awkward)


def test_targets_are_bounded_and_the_excess_goes_on(documents):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate([("a", 1), ("b", 400), ("c", 3), ("d", 400), (None, 7)] * 3)]
    _, expected, _, _ = check(documents(rows=rows))
    assert expected["a"] == 9 and expected["c"] == 27


def test_sources_come_near_their_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    _, expected, taken, largest = check(docs)
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 2 * largest[source]


def test_query_is_the_operator_on_all_documents_and_repeats_itself(spark, small):
    first, again = (sorted(map(tuple, LLM_QUERIES["op2_weighted_mix"](spark, small).collect())) for _ in range(2))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert first == again
    assert [r[0] for r in first] == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_order_is_by_finish_time_and_ends_at_the_budget(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    queue = mixing.mix_order(docs).collect()
    finish = [r.finish for r in queue]
    assert finish == sorted(finish)
    sizes = [r["size"] for r in mixing.mix(docs).collect()]
    assert sum(r["size"] for r in queue) <= sum(sizes)
    by_source = defaultdict(int)
    target = {r.source: r.target for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    for r in queue:
        by_source[r.source] += r["size"]
        assert r.finish == pytest.approx(by_source[r.source] / target[r.source])


def test_documents_are_repeated_as_often_as_taken(documents):
    docs = documents([f"{'w ' * (5 * i)}" for i in range(1, 30)], clashing=True)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    counts = defaultdict(int)
    for r in repeated.collect():
        counts[r.doc_id] += 1
    assert counts == {i: n for i, n in taken.items() if n}


def test_empty_table_and_no_words(documents):
    assert mixing.mix(documents()).collect() == []
    assert [r.taken for r in mixing.mix(documents(["", None])).collect()] == [0, 0]


def plain_mix(rows, targets):
    """Copies of each document: the source whose next copy finishes first is served, till the budget is used up.

    rows: (place, doc_id, source, size, n) as the queue has them; targets by source.
    """
    queues = {}
    for place, doc_id, source, size, n in sorted(rows, key=lambda r: (r[0] % 2**64, r[1], r[3])):
        queues.setdefault(source, []).append((place, doc_id, size, n))
    sizes = {s: sum(size * n for *_, size, n in q) for s, q in queues.items()}
    heads = {s: [0, 0, 0] for s in queues}  # epoch, place in the queue, words before
    copies, used, budget = {}, 0, sum(sizes.values())
    while True:
        best = None
        for source, (epoch, at, before) in heads.items():
            if epoch < mixing.MOST_EPOCHS:
                place, doc_id, size, n = queues[source][at]
                finish = (epoch * sizes[source] + before + size * n) / targets[source] if targets[source] else 0.0
                key = (finish, source, epoch, place, doc_id, size)
                if best is None or key < best[0]:
                    best = key, size * n
        if best is None or used + best[1] > budget:
            return copies
        (_, source, epoch, _, doc_id, size), words = best
        used += words
        copies[doc_id, source, size] = copies.get((doc_id, source, size), 0) + 1
        head = heads[source]
        head[1] += 1
        head[2] += words
        if head[1] == len(queues[source]):
            heads[source] = [epoch + 1, 0, 0]


@pytest.mark.parametrize("parts", ["8", "3"])
def test_taken_is_that_of_a_plain_queue(spark, small, parts):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("source IS NOT NULL AND doc_id IS NOT NULL")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        queue = mixing.mix_queue(docs, 7).collect()
        found = {(r.doc_id, r.source, r["size"]): r.copies for r in mixing.mix(docs).collect() if r.copies}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(r.place, r.doc_id, r.source, r["size"], r.n) for r in queue]
    assert found == plain_mix(rows, {r.source: r.target for r in queue})


def test_too_many_sources_are_refused(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(documents(["a", "b", "c", "d"]))
