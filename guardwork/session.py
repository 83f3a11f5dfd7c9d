"""Session settings for fleet jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# File sizes are compressed sizes: the factor keeps tables from being broadcast that are
# small only on disk.
# Adaptive execution merges small shuffle partitions, splits skewed ones and turns
# shuffle joins into broadcasts when a side turns out small.  Where every partition of
# one side is small it hashes that side, so the wide side of the join is not sorted.
SETTINGS = {
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("guardwork")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The shared folder that the cluster names for checkpoints; None if unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or None
