"""Exact top-k against all pairs."""

import math

import numpy as np
import pytest

from guardwork.llm import metric_tree as mt
from guardwork.llm.oracle import LLM_ORACLE_SQL
from guardwork.llm.queries import LLM_QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def usable(row):
    return row.vec_id is not None and row.embedding is not None and all(x is not None and math.isfinite(x) for x in row.embedding)


def expected(rows, k, every=20, scale=64):
    whole = [(r.vec_id, tuple(math.floor(scale * x) for x in r.embedding)) for r in rows if usable(r)]
    out = []
    for q, v in {w for w in whole if w[0] % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def check(df, k=20):
    got = sorted(map(tuple, mt.top_k(df, df.where("vec_id % 20 = 0"), k, 64).collect()))
    assert got == expected(df.collect(), k)


@pytest.mark.parametrize("shard_rows", [8192, 50])
def test_clusters_and_ties(llm, monkeypatch, shard_rows):
    monkeypatch.setattr(mt, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(mt, "QUERY_ROWS", 3)
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.05 * rng.normal(size=6)).round(1).tolist(), 0) for i in range(600)]
    rows += [(1000 + i, [0.5] * 6, 0) for i in range(200)]  # a third are the same
    check(llm.createDataFrame(rows, VECTORS))


def test_awkward_vectors(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (20, [1.0, 2.0], 0), (40, None, 0), (60, [nan, 1.0], 0), (80, [inf, 1.0], 0)]
    rows += [(100, [None, 1.0], 0), (None, [1.0, 1.0], 0), (1, [0.0, 0.0], 0), (2, [-0.01, -1.0], 0), (2, [-0.01, -1.0], 0)]
    rows += [(120, [1.0, 2.0, 3.0], 0), (3, [1.0, 0.0, 0.0], 0), (140, [], 0)]
    df = llm.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS id", "1 AS shard", "2 AS score", "3 AS bound")
    check(df)


def test_fewer_candidates_than_k(llm):
    check(llm.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], VECTORS))
    check(llm.createDataFrame([(0, [1.0], 0)], VECTORS))


def test_empty_table(llm):
    df = llm.createDataFrame([], VECTORS)
    assert mt.top_k(df, df, 20, 64).collect() == []


def test_tree_opens_few_pages_of_clusters():
    rng = np.random.default_rng(13)
    x = np.floor(64 * (np.repeat(rng.normal(size=(40, 16)), 100, axis=0) + 0.02 * rng.normal(size=(4000, 16))))
    tree = mt.MetricTree(np.arange(4000), x, mt.Space(float((x * x).sum(axis=1).max())))
    counted = []

    class Counting(np.ndarray):
        def __getitem__(self, rows):
            counted.append(np.size(rows))
            return np.asarray(super().__getitem__(rows))

    tree.vectors = x.view(Counting)
    for q in (7, 1234):
        counted.clear()
        who, found, score = tree.search(np.array([-1]), x[[q]], 20, np.array([-np.inf]))
        order = np.lexsort((np.arange(4000), -(x @ x[q])))[:20]
        assert found.tolist() == order.tolist() and score.tolist() == (x @ x[q])[order].tolist()
        assert sum(counted) < 2000 and not who.any()


def test_queries_answered_together_are_answered_as_alone():
    rng = np.random.default_rng(17)
    x = np.floor(64 * rng.normal(size=(900, 5))).round(-1)
    tree = mt.MetricTree(np.arange(900), x, mt.Space(float((x * x).sum(axis=1).max())))
    own, bounds = np.arange(0, 900, 20), np.where(np.arange(45) % 2, -np.inf, 9000.0)
    who, found, score = tree.search(own, x[own], 20, bounds)
    for i, q in enumerate(own):
        all_scores = x @ x[q]
        order = np.lexsort((np.arange(900), -all_scores))
        order = order[(order != q) & (all_scores[order] >= bounds[i])][:20]
        assert found[who == i].tolist() == order.tolist() and score[who == i].tolist() == all_scores[order].tolist()


def test_scores_found_rule_out_inner_nodes(monkeypatch):
    """Queries without a bound open few of many nodes, and a far query does not widen the others' ranges."""
    monkeypatch.setattr(mt, "PAGE", 32)
    rng = np.random.default_rng(18)
    x = np.floor(64 * (np.repeat(rng.normal(size=(60, 8)), 100, axis=0) + 0.02 * rng.normal(size=(6000, 8))))
    tree = mt.MetricTree(np.arange(6000), x, mt.Space(float((x * x).sum(axis=1).max())))
    counted, plain = [], mt.Space.distances
    monkeypatch.setattr(mt.Space, "distances", staticmethod(lambda a, b: counted.append(len(a) * len(b)) or plain(a, b)))
    own = np.arange(0, 6000, 40)
    who, found, score = tree.search(own, x[own], 20, np.full(len(own), -np.inf))
    for i, q in enumerate(own):
        order = np.lexsort((np.arange(6000), -(x @ x[q])))
        order = order[order != q][:20]
        assert found[who == i].tolist() == order.tolist() and score[who == i].tolist() == (x @ x[q])[order].tolist()
    nodes, open_ = 0, [tree.root]
    while open_:
        nodes, open_ = nodes + len(open_), [child for node in open_ for child in node.children]
    assert sum(counted) < 0.5 * nodes * len(own), (sum(counted), nodes * len(own))


def test_query_equals_brute_force_and_sql(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = sorted(map(tuple, LLM_QUERIES["op8_metric_tree"](spark, small).collect()))
    assert got == expected(rows, 20)
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{small}/embeddings.parquet')")
    assert sorted(con.execute(LLM_ORACLE_SQL["op8_metric_tree"]).fetchall()) == got


@pytest.mark.parametrize(("dimensions", "most"), [(64, 1 << 24), (64, (1 << 28) - 1), (3, 1 << 30), (1, (1 << 31) - 1)])
def test_large_components_are_scored_exactly(llm, dimensions, most):
    """Near the largest whole numbers; many scores differ in their last digits only."""
    rng = np.random.default_rng(most % 1000)
    rows = []
    for i in range(120):
        whole = np.where(rng.random(dimensions) < 0.5, -1, 1) * (most - rng.integers(0, 3, dimensions))
        rows.append((i, (np.abs(whole) if i % 2 else whole).astype(float).tolist(), 0))
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, mt.top_k(df, df.where("vec_id % 20 = 0"), 20, 1).collect()))
    assert got == expected(df.collect(), 20, scale=1)


@pytest.mark.parametrize("component", [1e9, 1e300, -1e300])
def test_vectors_whose_scores_are_no_longs_are_refused(llm, component):
    df = llm.createDataFrame([(0, [1.0, 2.0]), (1, [component, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2\\^62"):
        mt.top_k(df, df, 20, 64)
