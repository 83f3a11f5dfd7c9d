"""All queries by name, over one folder of given tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guardwork import operators as ops
from guardwork.session import shared_folder
from guardwork.sources.awkward import AwkwardFleet
from guardwork.sources.derived import DerivedFleet
from guardwork.sources.flow_store import FlowStore, Published
from guardwork.streaming import broken_folder, broken_so_far, refuse_grants, refused_so_far

FleetQuery = Callable[[DerivedFleet], DataFrame]

# The event table is streamed in as many files as its size asks for, so many of them a micro-batch.
FILE_RECORDS = 100_000
BATCH_FILES = 64


def _audit(f: DerivedFleet) -> DataFrame:
    return ops.guard_audit(f.jobs_installed, f.steps_installed, f.run_config)


def _states(f: DerivedFleet) -> tuple[DataFrame, ...]:
    return f.run_config, f.databases, f.replica_states, f.db_replica_states


def _installed(f: DerivedFleet) -> ops.Flow:
    return ops.install_guard_steps(f.requests, f.jobs_plain, f.steps_plain, f.run_config)


def _removed(f: DerivedFleet) -> ops.Flow:
    return ops.remove_guard_steps(f.requests, f.jobs_installed, f.steps_installed)


def _reinstalled(f: DerivedFleet) -> ops.Flow:
    return ops.install_guard_steps(
        f.requests, f.jobs_installed, f.steps_installed, f.run_config
    )


def _duplicates(f: DerivedFleet) -> DataFrame:
    """The request list with the jobs that start on step 2 asked for once more."""
    again = f.jobs_plain.where("start_step_id = 2").select(
        "server_id", "job_name", F.lit("ASIA").alias("config_name")
    )
    return ops.requests_duplicate_jobs(f.requests.unionByName(again))


def _streamed_grants(f: DerivedFleet) -> DataFrame:
    """The event table as a file stream, run to its end."""
    run = _run_stream(f, f.given("events"), f.as_grant_events)
    return refused_so_far(f.spark, f"{run}/output")


def _streamed_broken(f: DerivedFleet) -> DataFrame:
    """The documents that a stream could not read."""
    run = _run_stream(
        f,
        f.given("events"),
        lambda events: AwkwardFleet.as_awkward_events(f.as_grant_events(events)),
    )
    return broken_so_far(f.spark, broken_folder(f"{run}/output"))


def _run_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors reach; only a session on this machine may do without a
    shared one."""
    folder = shared_folder(spark)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = f"file://{tempfile.mkdtemp(prefix='guardwork-')}"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _published(f: DerivedFleet, change: Callable[[FlowStore], Published]) -> ops.Flow:
    """A change of the installed tables, as a reader of the store finds it."""
    store = FlowStore(f.spark, _run_folder(f.spark, "flow"))
    store.create(f.jobs_installed, f.steps_installed)
    published = change(store)
    jobs, steps = store.read()
    return ops.Flow(steps=steps, jobs=jobs, checks=published.checks)


def _published_reinstall(f: DerivedFleet) -> ops.Flow:
    return _published(f, lambda store: store.install(f.requests, f.run_config))


def _run_stream(f: DerivedFleet, events: DataFrame, as_grant_events) -> str:
    """Streams the events, some files at a time, to the end; returns the run's folder."""
    spark = f.spark
    run = _run_folder(spark, "refused-grants")
    events.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(f"{run}/input")
    arriving = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", BATCH_FILES)
        .parquet(f"{run}/input")
    )
    stream = refuse_grants(
        as_grant_events(arriving),
        lambda session: DerivedFleet(session, f.folder).principals,
        output=f"{run}/output",
        checkpoint=f"{run}/checkpoint",
    )
    stream.awaitTermination()
    return run


def _awkward(query: Callable[[AwkwardFleet], DataFrame]) -> FleetQuery:
    return lambda f: query(AwkwardFleet(f))


FLEET_QUERIES: dict[str, FleetQuery] = {
    "guard_config_name": lambda f: ops.guard_config_name(f.steps_installed),
    "guard_steps_found": lambda f: ops.guard_steps_found(f.jobs_installed, f.steps_installed),
    "guard_audit": _audit,
    "local_replica_role": lambda f: ops.local_replica_role(*_states(f)[1:]),
    "config_check": lambda f: ops.config_check(f.requests, f.run_config, f.databases),
    "run_decision": lambda f: ops.run_decision(f.requests, *_states(f)),
    "run_decision_as_written": lambda f: ops.run_decision_as_written(f.requests, *_states(f)),
    "run_outcome": lambda f: ops.run_outcome(f.requests, *_states(f)),
    "run_outcome_where_guarded": lambda f: ops.run_outcome(
        f.requests, *_states(f), guarded_servers=f.databases.where("database_name = 'DB_0'")
    ),
    "status_check": lambda f: ops.status_check(
        ops.guard_config_name(f.steps_installed), *_states(f)
    ),
    "requests_empty": lambda f: ops.requests_empty(f.requests),
    "requests_duplicate_jobs": _duplicates,
    "requests_missing_jobs": lambda f: ops.requests_missing_jobs(f.requests, f.jobs_plain),
    "requests_jobs_without_steps": lambda f: ops.requests_jobs_without_steps(
        f.requests, f.jobs_plain, f.steps_plain
    ),
    "requests_missing_configs": lambda f: ops.requests_missing_configs(
        f.requests, f.run_config
    ),
    "install_check": lambda f: ops.install_check(
        f.requests, f.jobs_plain, f.steps_plain, f.run_config
    ),
    "reinstall_check": lambda f: ops.install_check(
        f.requests, f.jobs_installed, f.steps_installed, f.run_config
    ),
    "install_worklist": lambda f: ops.install_worklist(
        f.requests, f.jobs_installed, f.steps_installed
    ),
    "shift_flow": lambda f: ops.shift_flow(f.steps_plain, 2),
    "install_guard_steps": lambda f: _installed(f).steps,
    "install_job_starts": lambda f: _installed(f).jobs,
    "install_preview": lambda f: ops.install_preview(
        f.requests, f.jobs_plain, f.steps_plain, f.run_config
    ),
    "remove_check": lambda f: ops.remove_check(
        f.jobs_installed, f.jobs_installed, f.steps_installed
    ),
    "remove_guard_steps": lambda f: _removed(f).steps,
    "remove_job_starts": lambda f: _removed(f).jobs,
    "reinstall_guard_steps": lambda f: _reinstalled(f).steps,
    "reinstall_job_starts": lambda f: _reinstalled(f).jobs,
    "published_reinstall_steps": lambda f: _published_reinstall(f).steps,
    "published_reinstall_job_starts": lambda f: _published_reinstall(f).jobs,
    "published_reinstall_check": lambda f: _published_reinstall(f).checks,
    "published_removal_steps": lambda f: _published(f, lambda store: store.remove(f.requests)).steps,
    "grantees": lambda f: ops.grantees(f.grant_events),
    "direct_grants": lambda f: ops.direct_grants(f.grant_events, f.principals),
    "refused_grants": lambda f: ops.refused_grants(f.grant_events, f.principals),
    "direct_grants_stream": _streamed_grants,
    "objects_like": lambda f: ops.objects_like(f.objects),
    "objects_missing": lambda f: ops.objects_missing(f.expected_objects, f.objects),
    "guard_audit_awkward": _awkward(
        lambda f: ops.guard_audit(f.jobs_installed, f.unreadable_steps, f.run_config)
    ),
    "local_replica_role_awkward": _awkward(lambda f: ops.local_replica_role(*_states(f)[1:])),
    "run_decision_awkward": _awkward(lambda f: ops.run_decision(f.requests, *_states(f))),
    "status_check_awkward": _awkward(
        lambda f: ops.status_check(
            ops.guard_config_name(f.unreadable_steps).withColumn(
                "step_id", F.expr("IF(job_id % 3 = 0, step_id + 1, step_id)")
            ),
            *_states(f),
        )
    ),
    "install_check_awkward": _awkward(
        lambda f: ops.install_check(f.requests, f.jobs_plain, f.steps_plain, f.run_config)
    ),
    "install_job_starts_awkward": _awkward(
        lambda f: ops.install_guard_steps(
            f.requests, f.jobs_plain, f.steps_plain, f.run_config
        ).jobs
    ),
    "remove_check_awkward": _awkward(
        lambda f: ops.remove_check(f.removal_requests, f.jobs_installed, f.steps_installed)
    ),
    "install_full_steps": lambda f: ops.install_guard_steps(
        f.requests, f.jobs_plain, AwkwardFleet(f).full_steps, f.run_config
    ).steps,
    "direct_grants_awkward": _awkward(lambda f: ops.direct_grants(f.grant_events, f.principals)),
    "broken_events": _awkward(lambda f: ops.broken_events(f.grant_events)),
    "broken_events_stream": _streamed_broken,
    "objects_like_awkward": _awkward(lambda f: ops.objects_like(f.objects)),
    "objects_missing_awkward": _awkward(
        lambda f: ops.objects_missing(f.expected_objects, f.objects)
    ),
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """One query over the given tables of a folder."""
    return FLEET_QUERIES[name](DerivedFleet(spark, folder))
