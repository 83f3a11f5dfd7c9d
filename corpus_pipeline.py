"""From raw documents to token ids: quality rules, near-duplicates, secrets, mix, BPE.

Each stage reads what the stage before has kept, from Parquet, and returns the columns of
documents; the last one adds their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from guardwork.llm import byte_bpe, mixing, near_duplicates, quality_rules, secret_scan
from guardwork.llm.queries import BYTE_RANKS
from guardwork.llm.shared import ship_package, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the trees reject; the trees are fitted on the labelled documents of sf_dir."""
    ship_package(spark)
    forest = quality_rules.fit_forest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.quality_filter(docs, forest)


#: Stages on word shingles take five words.
SHINGLE_WORDS = 5


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near-duplicates."""
    ship_package(spark)
    return near_duplicates.without_near_duplicates(docs, SHINGLE_WORDS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret by the name of its kind; no document goes."""
    ship_package(spark)
    return secret_scan.redact_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def with_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds `ids`, the byte-level BPE of the text, and `decoded`, the text they stand for."""
    ship_package(spark)
    path = public_tokenizers.path(BYTE_RANKS)
    return byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decode=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_documents),
    ("MinHash near-dedup", one_of_each),
    ("secret scans", without_secrets),
    ("mixing", mixed),
    ("byte-level BPE", with_token_ids),
]

#: The trees, the signatures and the transducer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
