"""The operators applied to the given tables, by query name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guardwork.llm import (
    byte_bpe,
    metric_tree,
    mixing,
    near_duplicates,
    packing,
    periodic_runs,
    quality_rules,
    secret_scan,
    site_quality,
    suffix_repeats,
    token_alignment,
    token_files,
    warc,
)
from guardwork.llm.shared import ship_package, table

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
END_ID = 2
SHINGLE_WORDS = 4
REPEAT_BYTES = 400
SEQUENCE_TOKENS = 2048
PACKED_END_ID = 0


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_RANKS)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_rules.fit_forest(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, forest)


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    return token_files.token_file_report(table(spark, sf_dir, "documents"), path, END_ID)


def near_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS)


def site_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources, and a source's languages its paths."""
    docs = table(spark, sf_dir, "documents")
    evidence = site_quality.fit_evidence(docs, table(spark, sf_dir, "labels"))
    return site_quality.site_quality(docs, evidence, "source", "lang")


def metric_tree_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return metric_tree.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


def suffix_repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.repeats_report(table(spark, sf_dir, "documents"), REPEAT_BYTES)


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    return packing.pack(table(spark, sf_dir, "documents"), path, PACKED_END_ID, SEQUENCE_TOKENS).drop("ids")


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_path, piece_path = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER)
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"), byte_path, public_tokenizers.PATTERN, piece_path)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """One document of ten repeats p of its words from word a on, as its id's crc32 h says; a null id changes nothing."""
    words = docs.withColumn("_h", F.expr("crc32(CAST(CAST(doc_id AS string) AS binary))")).withColumn(
        "_words", F.when(F.expr("_h % 10 = 0"), F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"))
    )
    numbers = words.withColumn("_a", F.expr("(_h div 10) % size(_words)")).withColumn(
        "_p", F.expr("1 + (size(_words) - _a) div (3 + (_h div 10) % 8)")
    )
    changed = "transform(sequence(0, size(_words) - 1), i -> _words[CAST(if(i < _a, i, _a + (i - _a) % _p) AS int)])"
    return numbers.withColumn(
        "text", F.expr(f"CASE WHEN size(_words) > 0 THEN array_join({changed}, ' ') ELSE text END")
    ).drop("_h", "_words", "_a", "_p")


#: Of runs by start, then period, the first of the greatest length / period.
_GREATEST_RUN = """
    aggregate(slice(runs, 2, greatest(size(runs), 1)), runs[0],
      (best, r) -> if(r.length * best.period > best.length * r.period, r, best))
"""


def periodic_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse_runs(planted)
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("_run", F.expr(f"CASE WHEN size(runs) > 0 THEN {_GREATEST_RUN} END")).selectExpr(
        "doc_id",
        "CAST(size(runs) AS long) AS n_runs",
        "_run.start AS start",
        "_run.length AS length",
        "_run.period AS period",
        "1000 * _run.length div _run.period AS exponent_milli",
        f"sha2(CAST({lines} AS binary), 256) AS runs_sha256",
        "sha2(CAST(collapsed AS binary), 256) AS collapsed_sha256",
    )


Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_byte_bpe": byte_bpe_query,
    "op2_weighted_mix": mix_query,
    "op3_near_duplicates": near_duplicates_query,
    "op4_quality_rules": quality_rules_query,
    "op5_secrets": secrets_query,
    "op6_token_files": token_files_query,
    "op7_site_quality": site_quality_query,
    "op8_metric_tree": metric_tree_query,
    "op9_warc": warc_query,
    "op10_suffix_repeats": suffix_repeats_query,
    "op11_packing": packing_query,
    "op12_token_alignment": alignment_query,
    "op13_periodic_runs": periodic_runs_query,
}

LLM_QUERIES = {name: shipped(query) for name, query in _QUERIES.items()}
