"""Checks on a list of install requests, and the work list made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.functions.text import ci
from guardwork.operators.guard import DEFAULT_GUARD, Guard
from guardwork.plans.joins import lookup, lookup_repeated, only_matching
from guardwork.schemas import JOB_KEY, column_names, require

NAME_KEY = ["server_id", "_job"]


def named_requests(requests: DataFrame) -> DataFrame:
    """Requests' own columns with the lookup key of their job; a removal names no config."""
    own = [c for c in column_names("requests") if c in requests.columns]
    return requests.select(*own, ci("job_name").alias("_job"))


def named_jobs(jobs: DataFrame) -> DataFrame:
    """Job ids and start steps under the lookup key of the job's name."""
    return require(jobs, "jobs").select(
        "server_id", ci("job_name").alias("_job"), "job_id", "start_step_id"
    )


def _found(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests with the jobs of their name."""
    asked = named_requests(require(requests, "requests"))
    return lookup_repeated(asked, named_jobs(jobs), NAME_KEY, spread=["job_name", "config_name"])


def requests_empty(requests: DataFrame) -> DataFrame:
    """One row: is the request list empty?"""
    return requests.agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def requests_duplicate_jobs(requests: DataFrame) -> DataFrame:
    """Jobs that are requested more than once; one row per job with its lower-case name."""
    return (
        named_requests(require(requests, "requests"))
        .groupBy(*NAME_KEY)
        .agg(F.count(F.lit(1)).alias("n_requests"))
        .where(F.col("n_requests") > 1)
        .withColumnRenamed("_job", "job_name_key")
    )


def requests_missing_jobs(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests for jobs that do not exist."""
    names = named_jobs(jobs).select(*NAME_KEY)
    asked = named_requests(require(requests, "requests"))
    return lookup_repeated(
        asked, names, NAME_KEY, spread=["job_name", "config_name"], how="left_anti"
    ).select("server_id", "job_name")


def requests_jobs_without_steps(
    requests: DataFrame, jobs: DataFrame, steps: DataFrame
) -> DataFrame:
    """Requests for jobs that have no step.

    Step keys are made distinct before they are shuffled, so a job with very many
    steps contributes one key per task.
    """
    asked = _found(requests, jobs).select(*JOB_KEY, "job_name")
    with_steps = (
        only_matching(require(steps, "steps"), asked, JOB_KEY, bound=requests)
        .select(*JOB_KEY)
        .distinct()
    )
    return asked.join(with_steps, JOB_KEY, "left_anti").select("server_id", "job_name")


def requests_missing_configs(requests: DataFrame, run_config: DataFrame) -> DataFrame:
    """Requests for configs that do not exist."""
    configs = require(run_config, "run_config").select(
        "server_id", ci("config_name").alias("_config")
    )
    own = require(requests, "requests").select(*column_names("requests"))
    asked = own.withColumn("_config", ci("config_name"))
    return lookup(
        asked, configs, ["server_id", "_config"], spread=["job_name"], how="left_anti"
    ).select("server_id", "job_name", "config_name")


def install_worklist(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    guard: Guard = DEFAULT_GUARD,
) -> DataFrame:
    """Requested jobs that have a step 1, and whether their guard must go first."""
    asked = _found(requests, jobs).select(*JOB_KEY, "job_name", "config_name")
    first = (
        require(steps, "steps")
        .where(F.col("step_id") == 1)
        .select(*JOB_KEY, guard.is_step_1().alias("requires_drop"))
    )
    return asked.join(first, JOB_KEY)
