"""The stages, each on what the one before has kept."""

from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as cp
from guardwork.llm import byte_bpe, mixing, near_duplicates, quality_rules, secret_scan


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_one_after_the_other(spark, small, byte_ranks):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns, before = docs.columns, docs
    after = {}
    for name, stage in cp.STAGES:
        out = stage(spark, before, small)
        assert [c for c in out.columns if c in columns] == columns
        after[name] = before = spark.createDataFrame(out.collect(), out.schema)
    names = [name for name, _ in cp.STAGES]
    good, single, clean, mix, coded = (after[n] for n in names)

    kept = {r.doc_id for r in quality_rules.quality_rules(docs, quality_rules.fit_forest(docs, labels)).collect() if r.kept}
    assert {r.doc_id for r in good.collect()} == kept
    first = {r.doc_id for r in near_duplicates.near_duplicates(good, 5).collect() if r.kept}
    assert {r.doc_id for r in single.collect()} == first
    assert clean.count() == single.count()
    spans = {r.doc_id: secret_scan.spans_of(r.text or "") for r in single.collect()}
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in single.collect():
        assert texts[r.doc_id] == secret_scan.redacted(r.text, spans[r.doc_id])
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect() if r.copies}
    assert Counter(r.doc_id for r in mix.collect()) == copies
    ranks = byte_bpe.read_ranks(byte_ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in coded.collect():
        assert r.ids == library.encode_ordinary(r.text) and r.decoded == r.text
    assert rows_of(cp.run(spark, small)) == rows_of(coded)


def test_clean_documents_stay(spark, medium):
    """Of the labelled documents, the good ones pass the quality rules."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    kept = {r.doc_id for r in cp.good_documents(spark, docs, medium).select("doc_id").collect()}
    good = [r.doc_id in kept for r in labels.where("quality = 1").collect()]
    assert np.mean(good) > 0.9
