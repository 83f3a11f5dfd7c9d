"""May a job run on this server right now?

The answer depends only on the server and the config name.  So it is worked out once
per config, on tables that are small next to the jobs, and every request needs a
single lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.text import ci, same_name
from guardwork.plans.joins import lookup
from guardwork.schemas import require

OK = "ok"
BAD_STEP_ID = "bad_step_id"
CONFIG_MISSING = "config_missing"
DATABASE_MISSING = "database_missing"
AMBIGUOUS_CONFIG = "ambiguous_config"
AMBIGUOUS_DATABASE = "ambiguous_database"
AMBIGUOUS_ROLE = "ambiguous_role"
NOT_HERE = "not_here"

DOCUMENTED = "documented"
AS_WRITTEN = "as_written"


def local_replica_role(
    databases: DataFrame, replica_states: DataFrame, db_replica_states: DataFrame
) -> DataFrame:
    """The role that each database has on its own server.

    One row per grouped database.  ``role_rows`` counts the local rows found; where
    they do not agree, ``ambiguous`` is true and ``role_desc`` is null.
    """
    local = (
        require(db_replica_states, "db_replica_states")
        .where("is_local")
        .select("server_id", "replica_id", "group_id", "database_id")
    )
    roles = require(replica_states, "replica_states").select(
        "server_id", "replica_id", "group_id", "role_desc"
    )
    spread = ["server_id", "database_id"]
    per_database = (
        lookup(
            local, roles, ["server_id", "replica_id", "group_id"], spread=spread, how="inner"
        )
        .groupBy(*spread)
        .agg(
            F.count(F.lit(1)).cast("int").alias("role_rows"),
            F.count("role_desc").cast("int").alias("_known"),
            F.min("role_desc").alias("_first"),
            F.max("role_desc").alias("_last"),
        )
    )
    agree = (F.col("_first") == F.col("_last")) & (F.col("_known") == F.col("role_rows"))
    settled = agree | (F.col("_known") == 0)
    return (
        require(databases, "databases")
        .join(per_database, spread)
        .select(
            "server_id",
            "database_id",
            "database_name",
            F.when(settled, F.col("_first")).alias("role_desc"),
            "role_rows",
            (~F.coalesce(settled, F.lit(False))).alias("ambiguous"),
        )
    )


def _config_databases(run_config: DataFrame, databases: DataFrame) -> DataFrame:
    """Per config: its lookup key and whether its driver database is on the server."""
    present = (
        require(databases, "databases")
        .groupBy("server_id", ci("database_name").alias("_database"))
        .agg(F.min("database_id").alias("database_id"), F.count(F.lit(1)).alias("_databases"))
    )
    configs = (
        require(run_config, "run_config")
        .groupBy("server_id", ci("config_name").alias("_config"))
        .agg(
            F.min("driver_database").alias("driver_database"),
            F.min("run_if_ungrouped").alias("run_if_ungrouped"),
            F.count(F.lit(1)).alias("_configs"),
        )
        .withColumn("driver_database", F.when(F.col("_configs") == 1, F.col("driver_database")))
        .withColumn("_database", ci("driver_database"))
    )
    return lookup(
        configs, present, ["server_id", "_database"], spread=["_config"], bound=databases
    ).drop("_database")


def _config_roles(
    run_config: DataFrame,
    databases: DataFrame,
    replica_states: DataFrame,
    db_replica_states: DataFrame,
) -> DataFrame:
    """Per config: driver database, flag and the local role of that database."""
    roles = local_replica_role(databases, replica_states, db_replica_states).drop(
        "database_name", "role_rows"
    )
    return lookup(
        _config_databases(run_config, databases),
        roles,
        ["server_id", "database_id"],
        spread=["_config"],
        bound=databases,
    )


def _config_reason() -> Column:
    return (
        F.when(F.col("_configs") > 1, AMBIGUOUS_CONFIG)
        .when(F.col("driver_database").isNull(), CONFIG_MISSING)
        .when(F.col("database_id").isNull(), DATABASE_MISSING)
        .when(F.col("_databases") > 1, AMBIGUOUS_DATABASE)
    )


def _may_run(mode: str) -> Column:
    """The run rule; the modes differ only where the rule itself comes out unknown.

    Unknown means: the database is in no group and the flag is off.  As documented
    the job is then skipped; as written the error is not raised and the job runs.
    """
    if mode not in (DOCUMENTED, AS_WRITTEN):
        raise ValueError(f"mode must be {DOCUMENTED!r} or {AS_WRITTEN!r}, not {mode!r}")
    rule = same_name("role_desc", fixed.ROLE_PRIMARY) | (
        F.col("role_desc").isNull() & F.col("run_if_ungrouped")
    )
    return F.coalesce(rule, F.lit(mode == AS_WRITTEN))


def _run_reason(mode: str) -> Column:
    return (
        _config_reason()
        .when(F.coalesce("ambiguous", F.lit(False)), AMBIGUOUS_ROLE)
        .when(~_may_run(mode), NOT_HERE)
        .otherwise(OK)
    )


def _ask(
    asked: DataFrame, states: DataFrame, run_config: DataFrame, spread: list[str]
) -> DataFrame:
    """Give each row the state of its config, by one lookup; one state per config."""
    named = asked.withColumn("_config", ci("config_name"))
    return lookup(named, states, ["server_id", "_config"], spread, bound=run_config)


def config_check(
    requests: DataFrame, run_config: DataFrame, databases: DataFrame
) -> DataFrame:
    """The check of guard step 2: config and driver database exist, or the reason."""
    states = _config_databases(run_config, databases)
    asked = _ask(require(requests, "requests"), states, run_config, ["job_name"])
    reason = _config_reason().otherwise(OK)
    return asked.select(
        *requests.columns, "driver_database", reason.alias("reason")
    ).withColumn("passed", F.col("reason") == OK)


def run_decision(
    requests: DataFrame,
    run_config: DataFrame,
    databases: DataFrame,
    replica_states: DataFrame,
    db_replica_states: DataFrame,
    mode: str = DOCUMENTED,
) -> DataFrame:
    """The check of guard step 1: step 2's check, then whether the job runs here."""
    states = _config_roles(run_config, databases, replica_states, db_replica_states)
    return (
        _ask(require(requests, "requests"), states, run_config, ["job_name"])
        .select(
            *requests.columns,
            "driver_database",
            "role_desc",
            _run_reason(mode).alias("reason"),
        )
        .withColumn("runs", F.col("reason") == OK)
    )


def run_decision_as_written(
    requests: DataFrame,
    run_config: DataFrame,
    databases: DataFrame,
    replica_states: DataFrame,
    db_replica_states: DataFrame,
) -> DataFrame:
    """``run_decision`` where an unknown rule lets the job run."""
    return run_decision(
        requests, run_config, databases, replica_states, db_replica_states, AS_WRITTEN
    )


def run_outcome(
    requests: DataFrame,
    run_config: DataFrame,
    databases: DataFrame,
    replica_states: DataFrame,
    db_replica_states: DataFrame,
    mode: str = DOCUMENTED,
    guarded_servers: DataFrame | None = None,
) -> DataFrame:
    """How a guarded job ends: ``run``, ``skipped`` with success, or ``failed``.

    ``guarded_servers`` lists the servers that hold the guard procedure; on any other
    server both guard steps fail, so the job fails.
    """
    states = _config_roles(run_config, databases, replica_states, db_replica_states)
    asked = _ask(require(requests, "requests"), states, run_config, ["job_name"])
    outcome = (
        F.when(_run_reason(mode) == OK, "run")
        .when(_config_reason().isNull(), "skipped")
        .otherwise("failed")
    )
    if guarded_servers is not None:
        known = guarded_servers.select("server_id").distinct()
        known = known.withColumn("_guarded", F.lit(True))
        asked = lookup(asked, known, ["server_id"], spread=["job_name"])
        outcome = F.when(F.col("_guarded").isNull(), "failed").otherwise(outcome)
    return asked.select(*requests.columns, outcome.alias("outcome"))


def status_check(
    calls: DataFrame,
    run_config: DataFrame,
    databases: DataFrame,
    replica_states: DataFrame,
    db_replica_states: DataFrame,
    mode: str = DOCUMENTED,
) -> DataFrame:
    """Answer guard calls: rows with ``server_id``, ``step_id`` and ``config_name``.

    Step 1 asks for the run decision, step 2 only for the config check; any other
    step id, also null, is refused.
    """
    states = _config_roles(run_config, databases, replica_states, db_replica_states)
    others = [c for c in calls.columns if c != "server_id"]
    asked = _ask(calls, states, run_config, others)
    known_step = F.coalesce(F.col("step_id").isin(1, 2), F.lit(False))
    reason = (
        F.when(~known_step, BAD_STEP_ID)
        .when(F.col("step_id") == 1, _run_reason(mode))
        .otherwise(F.coalesce(_config_reason(), F.lit(OK)))
    )
    return asked.select(*calls.columns, reason.alias("reason")).withColumn(
        "passed", F.col("reason") == OK
    )
