"""The classifier on held-out labels, and the shrinking of sites."""

import math

import numpy as np
import pytest

from guardwork.llm import site_quality as sq
from guardwork.llm.queries import LLM_QUERIES


def test_held_out_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    evidence = sq.fit_evidence(docs, labels.where("doc_id % 2 = 0"))
    rows = sq.site_quality(docs, evidence, "source", "lang").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.toxic]
    dirty = [r.kept for r in rows if r.quality == 0 or r.toxic]
    assert np.mean(clean) > 0.95
    assert np.mean(dirty) < 0.25


def test_query_judges_all_documents(spark, small):
    rows = LLM_QUERIES["op7_site_quality"](spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    assert all(0 <= r.p_good <= 1 and r.kept == (r.p_good >= 0.5) for r in rows)


def test_evidence_from_tables_is_that_of_the_texts(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet").where("quality IN (0, 1)")
    rows = sorted(docs.join(labels, "doc_id").select("doc_id", "text", "quality", "toxic").collect())
    good = np.array([r.quality == 1 and not r.toxic for r in rows])
    plain = sq.fit([(r.text or "").encode() for r in rows], good)
    found = sq.fit_evidence(docs, labels)
    assert found.words.tolist() == plain.words.tolist() and len(plain.words) > 10
    for a, b in zip(found[1:], plain[1:], strict=True):
        assert a == pytest.approx(b, rel=1e-3, abs=1e-4)


def test_query_equals_plain_lists(spark, small):
    """The whole query again over lists: texts, evidence, means of hosts and paths, posteriors."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.collect()
    evidence = sq.fit_evidence(docs, spark.read.parquet(f"{small}/labels.parquet"))
    odds = evidence.log_odds([(r.text or "").encode() for r in rows])
    sites = [(r.source, r.lang, 1 / (1 + math.exp(-x))) for r, x in zip(rows, odds, strict=True)]
    means, all_mean = brute_means(sites), np.mean([p for *_, p in sites])

    def logit(p):
        p = min(max(p, sq._EDGE), 1 - sq._EDGE)
        return math.log(p / (1 - p))

    want = {}
    for r, x in zip(rows, odds, strict=True):
        host_mean, path_mean = means[r.source, r.lang]
        p_good = 1 / (1 + math.exp(-(x + logit(path_mean) - logit(all_mean))))
        want[r.doc_id] = (1 / (1 + math.exp(-x)), host_mean, path_mean, p_good, p_good >= sq.KEEP)
    for r in LLM_QUERIES["op7_site_quality"](spark, small).collect():
        assert (r.p_document, r.host_mean, r.path_mean, r.p_good) == pytest.approx(want[r.doc_id][:4], rel=1e-6)
        assert r.kept == want[r.doc_id][4]


def brute_means(rows):
    """host, path -> host and path means, by the same formulas over plain lists."""

    def worth(groups, parents):
        sizes = [len(g) for g in groups]
        n, k = sum(sizes), len(groups)
        if n <= k or k < 2:
            return sq.MOST_PRIOR
        noise = sum(sum((p - np.mean(g)) ** 2 for p in g) for g in groups) / (n - k)
        between = sum(len(g) * (np.mean(g) - m) ** 2 for g, m in zip(groups, parents, strict=True))
        own = (between - noise * (k - 1)) / (n - sum(s * s for s in sizes) / n)
        return sq.MOST_PRIOR if own <= 0 else min(max(noise / own, sq.LEAST_PRIOR), sq.MOST_PRIOR)

    hosts, paths = {}, {}
    for host, path, p in rows:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    all_mean = np.mean([p for _, _, p in rows])
    w = worth(list(hosts.values()), [all_mean] * len(hosts))
    host_mean = {h: (sum(g) + w * all_mean) / (len(g) + w) for h, g in hosts.items()}
    w = worth(list(paths.values()), [host_mean[h] for h, _ in paths])
    return {hp: (host_mean[hp[0]], (sum(g) + w * host_mean[hp[0]]) / (len(g) + w)) for hp, g in paths.items()}


def test_means_shrink_toward_the_level_above(llm):
    rng = np.random.default_rng(11)
    rows = []
    for h in range(8):
        for p in range(3):
            centre = rng.normal(h / 4 - 1, 0.5)
            host = None if h == 7 else f"h{h}"
            path = None if p == 2 else f"p{p}"
            rows += [(host, path, float(centre + rng.normal())) for _ in range(int(rng.integers(1, 60)))]
    documents = llm.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, host string, path string, log_odds double")
    got = {(r.host, r.path): (r.host_mean, r.path_mean) for r in sq.site_means(documents).collect()}
    want = brute_means([(h, p, 1 / (1 + math.exp(-x))) for h, p, x in rows])
    assert got.keys() == want.keys()
    for key, means in want.items():
        assert got[key] == pytest.approx(means)


def test_awkward_documents(awkward, llm):
    evidence = sq.fit([b"good text here"] * 20 + [b"bad idiot words"] * 20, np.array([True] * 20 + [False] * 20))
    rows = sq.site_quality(awkward, evidence, "source", "lang").collect()
    assert sorted((str(r.doc_id) for r in rows)) == sorted(str(d.doc_id) for d in awkward.collect())
    assert all(r.p_good is not None and not math.isnan(r.p_good) for r in rows)
    twice = [r for r in rows if r.doc_id == 78]
    assert twice[0] == twice[1]


def test_without_labels_the_evidence_is_even(documents, llm):
    docs = documents(["some text", None])
    evidence = sq.fit_evidence(docs, llm.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r.p_good for r in sq.site_quality(docs, evidence, "source", "lang").collect()] == [0.5, 0.5]


def test_empty_table(documents):
    evidence = sq.fit([], np.zeros(0, bool))
    assert sq.site_quality(documents(), evidence, "source", "lang").collect() == []
