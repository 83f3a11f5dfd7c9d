"""Join shapes shared by the operators.

Two questions decide how a join scales here.  Does the small side fit into every
executor?  That is asked of the planner's size estimate and never assumed.  And can
one key hold a large part of the rows?  Then the key is split: by a salt where a
large table looks something up, by step ranges where a job meets its own steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.plans.rows import most_rows

SALTS = 16
STEPS_PER_RANGE = 100_000
# Bytes of a value in memory by type; a text counts as the planner counts it.
_WIDTH = {"boolean": 1, "integer": 4, "long": 8, "double": 8, "string": 20, "timestamp_ntz": 8}
UNKNOWN = 1 << 62
# Rows of one key that are worth dividing.
HEAVY_ROWS = 100_000
# Counters of the sketch that looks for them.
MOST_TRACKED = 100_000


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate; file scans report their file sizes.

    A session without a planner at hand (a client's) knows no size; nothing is hinted then.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return UNKNOWN
    return int(str(plan.stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; negative switches broadcasts off."""
    try:
        conf = df.sparkSession._jsparkSession.sessionState().conf()
    except AttributeError:
        return -1
    return int(conf.autoBroadcastJoinThreshold())


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row in memory, as the planner counts them."""
    return 8 + sum(_WIDTH.get(f.dataType.typeName(), 64) for f in df.schema.fields)


def fits_broadcast(bound: DataFrame) -> bool:
    """True if the table is known to stay below the broadcast threshold, by size and by rows.

    The size estimate of a stored table is that of its compressed files, which says little
    about a table that repeats itself.  So the rows that it can have at most are asked of
    stored metadata as well (``most_rows``); no job runs for that.  Where nothing is known
    there is no hint, and adaptive execution decides by the sizes it meets.
    """
    limit = broadcast_limit(bound)
    if limit <= 0 or estimated_bytes(bound) > limit:
        return False
    rows = most_rows(bound)
    return rows is not None and rows <= max(1, limit // row_bytes(bound))


def sized_by_rows(table: DataFrame, on: Sequence[str], times: int = 1) -> DataFrame:
    """The side of a join that is not known to be small, kept from a broadcast by file size.

    The planner broadcasts what is small as compressed files, without regard to its rows in memory
    or to how often a generator repeats them (``times``).  If the files, read for their keys at
    least, promise a broadcast that the rows may be too many for, a merge join is asked for.  All
    else is left to the planner: it takes joins for far larger than they are, and adaptive
    execution counts real bytes.
    """
    limit = broadcast_limit(table)
    if limit <= 0 or estimated_bytes(table.select(*on)) > limit:
        return table
    rows = most_rows(table)
    return table if rows is None or rows * times <= limit // row_bytes(table) else table.hint("merge")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    bound: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table of names: left, inner, left_semi or left_anti.

    Where the table is itself the result of joins, its size estimate is useless; then
    ``bound`` names a stored table that holds at least as many rows.

    A table below the broadcast threshold is broadcast.  A larger one is shuffled
    with a salt in the key: rows take a salt from the ``spread`` columns, the table
    is repeated once per salt, and a name that a third of the rows ask for (or rows
    that have no name at all) is divided over ``SALTS`` tasks.
    """
    on = list(on)
    if fits_broadcast(table if bound is None else bound):
        return rows.join(F.broadcast(table), on, how)
    salted_rows = rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(SALTS)).cast("int")
    )
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    salted_table = sized_by_rows(table, on, SALTS).withColumn("_salt", salts)
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")


def lookup_repeated(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    bound: DataFrame | None = None,
) -> DataFrame:
    """``lookup`` for rows that can be counted cheaply first.

    Keys of very many rows are divided over all shuffle partitions, and only their rows of
    the table are repeated.  They are found by a frequent-items sketch: its list holds a key
    a shuffle partition at most, and every key with more than a few partitions' share of the
    rows.  What the sketch gets wrong changes how keys are dealt out, never the result.  Rows without
    a key match nothing; they are divided as well.  ``bound`` is that of ``lookup``.
    """
    on = list(on)
    if fits_broadcast(table if bound is None else bound):
        return rows.join(F.broadcast(table), on, how)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(rows, on, parts)
    keyless = F.array_contains(F.array(*[F.col(c).isNull() for c in on]), True)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(parts)).cast("int")
    named = F.xxhash64(*[F.col(c) for c in on])
    divided = (
        rows.withColumn("_key_hash", named)
        .join(F.broadcast(heavy), "_key_hash", "left")
        .withColumn("_salt", F.when(F.col("_heavy") | keyless, part).otherwise(F.lit(0)))
    )
    repeated = (
        table.withColumn("_key_hash", named)
        .join(F.broadcast(heavy), "_key_hash", "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
                    F.array(F.lit(0))
                )
            ),
        )
    )
    divided, repeated = (df.drop("_heavy", "_key_hash") for df in (divided, repeated))
    if sized_by_rows(table, on) is not table:
        repeated = repeated.hint("merge")
    return divided.join(repeated, [*on, "_salt"], how).drop("_salt")


def heavy_keys(rows: DataFrame, on: Sequence[str], most: int) -> DataFrame:
    """Hashes of keys (``_key_hash``) with more than ``HEAVY_ROWS`` rows, at most ``most`` of them.

    The sketch keeps a bounded number of counters, whatever the number of keys.
    """
    tracked = min(MOST_TRACKED, max(64, 16 * most))
    sketch = F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {min(most, tracked)}, {tracked})")
    found = rows.agg(F.explode(sketch).alias("_found"))
    return found.where(F.col("_found.count") > HEAVY_ROWS).select(
        F.col("_found.item").alias("_key_hash"), F.lit(True).alias("_heavy")
    )


def only_matching(
    rows: DataFrame, keys: DataFrame, on: Sequence[str], bound: DataFrame
) -> DataFrame:
    """Drop rows that no key asks for, if that needs no shuffle; else keep all.

    ``keys`` must never hold more rows than ``bound``.  This is a reduction in
    front of an aggregation or join on the same keys, so keeping all is right too.
    """
    if fits_broadcast(bound):
        return rows.join(F.broadcast(keys.select(*on).distinct()), list(on), "left_semi")
    return rows


def join_bounded(
    rows: DataFrame, per_key: DataFrame, on: Sequence[str], bound: DataFrame, how: str = "left"
) -> DataFrame:
    """Join to at most one row per key, where neither side can have a hot key.

    ``per_key`` must hold no more rows than ``bound``; it is broadcast if that is small.
    """
    side = F.broadcast(per_key) if fits_broadcast(bound) else sized_by_rows(per_key, on)
    return rows.join(side, list(on), how)


def join_steps(
    steps: DataFrame, per_job: DataFrame, bound: DataFrame, how: str = "left"
) -> DataFrame:
    """Give every step the row of its job; ``per_job`` has one row per job at most.

    ``per_job`` must hold no more rows than ``bound`` and have a ``max_step_id``,
    which is dropped.  When small it is broadcast and the steps stay where they are.
    Otherwise the shuffle key is (server, job, range of step ids), so that a job with
    very many steps is divided over many tasks; nearly all jobs have a single range.

    ``how="right"`` keeps the steps of those jobs, and a row without a step for each job without a
    ``max_step_id``.
    """
    keys = ["server_id", "job_id"]
    if fits_broadcast(bound):
        if how == "right":
            stepless = per_job.where("max_step_id IS NULL").drop("max_step_id")
            found = join_steps(steps, per_job.where("max_step_id IS NOT NULL"), bound, "inner")
            return found.unionByName(stepless, allowMissingColumns=True)
        return steps.join(F.broadcast(per_job.drop("max_step_id")), keys, how)
    last_range = F.expr(f"(max_step_id - 1) div {STEPS_PER_RANGE}")
    ranged_jobs = sized_by_rows(per_job, keys).withColumn(
        "_range", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), last_range.cast("bigint")))
    ).drop("max_step_id")
    ranged_steps = steps.withColumn(
        "_range", F.expr(f"(step_id - 1) div {STEPS_PER_RANGE}").cast("bigint")
    )
    joined = ranged_steps.join(ranged_jobs, [*keys, "_range"], how)
    if how == "right":
        joined = joined.where("step_id IS NOT NULL OR _range IS NULL")  # not the ranges in a gap
    return joined.drop("_range")
