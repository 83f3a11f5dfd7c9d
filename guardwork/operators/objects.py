"""Looking up internal objects and finding the missing ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.text import ci, same_name
from guardwork.plans.joins import only_matching
from guardwork.schemas import require


def objects_like(
    objects: DataFrame,
    pattern: str = fixed.FULLTEXT_PATTERN,
    object_type: str = fixed.INTERNAL_TABLE,
) -> DataFrame:
    """Objects of one type whose name fits the pattern, in any case."""
    return (
        require(objects, "objects")
        .where(same_name("object_type", object_type))
        .where(F.col("object_name").ilike(pattern))
        .select("server_id", "object_name")
    )


def expected_on(
    servers: DataFrame, names: Sequence[str] = fixed.FULLTEXT_TABLES
) -> DataFrame:
    """The expected names for each server."""
    return servers.select(
        "server_id",
        F.explode(F.array(*[F.lit(name) for name in names])).alias("object_name"),
    )


def objects_missing(
    expected: DataFrame,
    objects: DataFrame,
    object_type: str = fixed.INTERNAL_TABLE,
) -> DataFrame:
    """Expected objects that a server does not have.

    The inventory is first cut down to the expected names, without a shuffle while
    the expected list is small, and only distinct hits meet the anti join.
    """
    key = ["server_id", "_name"]
    wanted = require(expected, "expected_objects").withColumn("_name", ci("object_name"))
    present = (
        require(objects, "objects")
        .where(same_name("object_type", object_type))
        .withColumn("_name", ci("object_name"))
    )
    hits = only_matching(present, wanted, key, bound=wanted).select(*key).distinct()
    return wanted.join(hits, key, "left_anti").select("server_id", "object_name")
