"""Statistics against plain Python, and the trees."""

import re
from collections import Counter

import numpy as np
import pytest

from guardwork.llm import quality_rules as qr
from guardwork.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def check(rows, docs):
    got = sorted(((r.doc_id, *(r[c] for c in qr.STATISTICS), r.base_failed) for r in rows), key=str)
    assert got == sorted(((d.doc_id, *plain(d.text)) for d in docs), key=str)
    assert not any(r.kept and r.base_failed for r in rows)


def forest_of(seed=0, rows=2000):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, len(qr.FEATURES)))
    y = (x[:, 1] - x[:, 2] + 0.3 * rng.normal(size=rows) > 0).astype(float)
    return qr.grow_forest(x, y, tuple(qr.FEATURES.values())), x, y


def test_awkward_documents(awkward):
    forest, _, _ = forest_of()
    check(qr.quality_rules(awkward, forest).collect(), awkward.collect())
    kept = qr.quality_filter(awkward, forest)
    assert kept.columns == awkward.columns
    assert kept.count() == qr.quality_rules(awkward, forest).where("kept").count()


def test_query_on_all_documents(spark, small):
    rows = LLM_QUERIES["op4_quality_rules"](spark, small).collect()
    check(rows, spark.read.parquet(f"{small}/documents.parquet").collect())


def test_forest_scores_as_its_nodes_walked_one_by_one():
    forest, x, _ = forest_of()

    def walk(row):
        total = forest.base
        for at in forest.roots:
            for _ in range(forest.depth):
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return total

    assert forest.score(x[:50]) == pytest.approx([walk(row) for row in x[:50]])


def test_forest_learns_and_falls_with_monotonic_features():
    forest, x, y = forest_of()
    assert ((forest.score(x) > 0) == y).mean() > 0.9
    for feature, direction in enumerate(qr.FEATURES.values()):
        if direction:
            moved = x[:100].copy()
            scores = []
            for value in np.linspace(-4, 4, 30):
                moved[:, feature] = value
                scores.append(forest.score(moved))
            assert (direction * np.diff(scores, axis=0) >= -1e-12).all()


def test_held_out_documents(spark, medium):
    """Fitted on half of the labels, the rules keep the good and drop most of the bad of the other half."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    forest = qr.fit_forest(docs, labels.where("doc_id % 2 = 0"))
    rows = qr.quality_rules(docs, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < 0.3


def test_kept_documents_by_walking_the_trees(spark, small):
    """Every document of the query again: its features down each tree, node by node."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    forest = qr.fit_forest(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = {r.doc_id: r for r in qr.quality_rules(docs, forest).collect()}
    for d in docs.collect():
        s = qr.statistics_of([(d.text or "").encode()])
        total = forest.base
        for at in forest.roots:
            while forest.left[at] != at:
                low = qr.features_of(s)[0, forest.feature[at]] <= forest.threshold[at]
                at = forest.left[at] if low else forest.right[at]
            total += forest.value[at]
        row = rows[d.doc_id]
        assert row.log_odds == pytest.approx(total)
        assert row.kept == (not row.base_failed and total >= qr.KEEP_LOG_ODDS)


def test_without_labels_the_base_rules_decide(documents, llm):
    docs = documents(["too short", "enough words to pass all of the base rules without trouble at all"])
    forest = qr.fit_forest(docs, llm.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r.kept for r in qr.quality_rules(docs, forest).collect()] == [False, True]


def test_empty_table(documents):
    assert qr.quality_rules(documents(), forest_of()[0]).collect() == []
