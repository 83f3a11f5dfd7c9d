"""Which jobs carry the guard, and is it set up right?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.text import ci, config_name
from guardwork.operators.guard import DEFAULT_GUARD, Guard
from guardwork.plans.joins import lookup
from guardwork.schemas import JOB_KEY, require


def guard_config_name(steps: DataFrame, guard: Guard = DEFAULT_GUARD) -> DataFrame:
    """The config name in each guard step; null where the command is unreadable."""
    return require(steps, "steps").where(guard.is_step_1() | guard.is_step_2()).select(
        *JOB_KEY, "step_id", config_name("command", guard.marker).alias("config_name")
    )


def guard_steps_found(
    jobs: DataFrame, steps: DataFrame, guard: Guard = DEFAULT_GUARD
) -> DataFrame:
    """Per job: the guard steps, their config names and the real start step.

    Both guard steps come from one scan and one aggregate.  At most two rows per job
    are left before the shuffle, and only the config name of the command is kept.
    """
    first, second = guard.is_step_1(), guard.is_step_2()
    heads = (
        require(steps, "steps")
        .where(F.col("step_id").isin(1, 2))
        .where(first | second)
        .select(
            *JOB_KEY,
            "step_id",
            "step_name",
            "on_success_step_id",
            config_name("command", guard.marker).alias("config"),
            F.col("command").isNotNull().alias("has_command"),
        )
    )

    unreadable = F.col("has_command") & F.col("config").isNull()

    def of_step(n: int, column):
        return F.max(F.when(F.col("step_id") == n, column))

    guards = heads.groupBy(*JOB_KEY).agg(
        of_step(1, F.col("step_name")).alias("guard_1_name"),
        of_step(2, F.col("step_name")).alias("guard_2_name"),
        of_step(1, F.col("config")).alias("config_name"),
        of_step(2, F.col("config")).alias("config_name_step_2"),
        of_step(1, F.col("on_success_step_id")).alias("guard_1_target"),
        of_step(1, unreadable).alias("guard_1_unreadable"),
        of_step(2, unreadable).alias("guard_2_unreadable"),
    )
    return (
        require(jobs, "jobs")
        .select(*JOB_KEY, "job_name", "start_step_id")
        .join(guards, JOB_KEY, "left")
        .select(
            *JOB_KEY,
            "job_name",
            "start_step_id",
            "guard_1_name",
            "guard_2_name",
            "config_name",
            "config_name_step_2",
            F.coalesce("guard_1_unreadable", F.lit(False)).alias("guard_1_unreadable"),
            F.coalesce("guard_2_unreadable", F.lit(False)).alias("guard_2_unreadable"),
            F.when(F.col("guard_1_name").isNotNull(), F.col("guard_1_target"))
            .otherwise(F.col("start_step_id"))
            .alias("real_start_step_id"),
        )
    )


# Different step numbers that jobs start on, up to which steps are compared with the list.
MOST_STARTS = 1_000


def _may_be_start(jobs: DataFrame, steps: DataFrame, guard: Guard) -> Column:
    """Is the step's number one that some job starts on?  A scalar subquery over the numbers.

    A job starts on its start step or, if guarded, on the target of its first step.  Most
    jobs start on one of a few numbers; a job that starts far behind adds its own number
    only.  With more than ``MOST_STARTS`` numbers every step may be a start.
    """
    of_jobs = jobs.select(F.col("start_step_id").cast("bigint").alias("start"))
    of_guards = steps.where(guard.is_step_1()).select(
        F.col("on_success_step_id").cast("bigint").alias("start")
    )
    starts = (
        of_jobs.union(of_guards)
        .where("start IS NOT NULL")
        .distinct()
        .limit(MOST_STARTS + 1)
        .select(F.collect_list("start").alias("starts"))
        .scalar()
    )
    listed = F.array_contains(starts, F.col("step_id").cast("bigint"))
    return (F.size(starts) > MOST_STARTS) | listed


def guard_audit(
    jobs: DataFrame,
    steps: DataFrame,
    run_config: DataFrame,
    guard: Guard = DEFAULT_GUARD,
) -> DataFrame:
    """One row per job: guard status, config and the step the job really starts on.

    The config is looked up while rows are still narrow.  The start step is joined on
    (server, job, step), so a job with very many steps is spread over the tasks; steps on
    whose number no job starts are dropped before they are shuffled.
    """
    configs = (
        require(run_config, "run_config")
        .groupBy("server_id", ci("config_name").alias("_config"))
        .agg(
            F.min("driver_database").alias("driver_database"),
            F.min("run_if_ungrouped").alias("run_if_ungrouped"),
            F.count(F.lit(1)).alias("_configs"),
        )
        .withColumns(
            {c: F.when(F.col("_configs") == 1, F.col(c)) for c in ("driver_database", "run_if_ungrouped")}
        )
    )
    found = guard_steps_found(jobs, steps, guard).withColumn("_config", ci("config_name"))
    with_config = lookup(found, configs, ["server_id", "_config"], spread=JOB_KEY, bound=run_config)

    second = ci("config_name_step_2")
    no_guard = F.col("guard_1_name").isNull() | (
        F.col("config_name").isNull() & ~F.col("guard_1_unreadable")
    )
    unreadable = F.col("guard_1_unreadable") | F.col("guard_2_unreadable")
    status = (
        F.when(no_guard, fixed.STATUS_NOT_SET_UP)
        .when(F.col("start_step_id") != 1, fixed.STATUS_BYPASSED)
        .when(unreadable, fixed.STATUS_UNREADABLE)
        .when(F.col("_configs").isNull(), fixed.STATUS_CONFIG_MISSING)
        .when(F.col("_configs") > 1, fixed.STATUS_CONFIG_AMBIGUOUS)
        .when(second.isNull() | (F.col("_config") != second), fixed.STATUS_NOT_SAME_CONFIG)
        .otherwise(fixed.STATUS_CONFIGURED)
    )
    judged = with_config.select(
        *JOB_KEY,
        "job_name",
        status.alias("status"),
        "config_name",
        "driver_database",
        "run_if_ungrouped",
        "real_start_step_id",
    )
    starts = steps.where(_may_be_start(jobs, steps, guard)).select(
        *JOB_KEY,
        F.col("step_id").alias("real_start_step_id"),
        F.col("step_name").alias("real_start_step_name"),
        F.col("subsystem").alias("real_start_subsystem"),
        F.col("database_name").alias("real_start_database_name"),
        F.col("command").alias("real_start_command"),
    )
    return judged.join(starts, [*JOB_KEY, "real_start_step_id"], "left").select(
        *judged.columns,
        "real_start_step_name",
        "real_start_subsystem",
        "real_start_database_name",
        "real_start_command",
    )
