"""Times the headline operators and prints one JSON line.

The fleet tables are derived once from the given ones and written to a scratch folder,
so that the times are those of the operators over stored tables.  Each query runs once
to warm up and then three times; its time is the median.  Every result row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from guardwork import operators as ops  # noqa: E402
from guardwork.session import local_session  # noqa: E402
from guardwork.sources.derived import TABLE_NAMES, DerivedFleet  # noqa: E402
from guardwork.streaming import refuse_grants  # noqa: E402

RUNS = 3


def store_tables(spark, folder: str, scratch: str) -> None:
    fleet = DerivedFleet(spark, folder)
    for name in TABLE_NAMES:
        getattr(fleet, name).write.parquet(f"{scratch}/{name}")


def headline_queries(spark, scratch: str) -> dict:
    t = {name: spark.read.parquet(f"{scratch}/{name}") for name in TABLE_NAMES}
    states = [t[n] for n in ("run_config", "databases", "replica_states", "db_replica_states")]
    jobs, steps, requests = t["jobs_installed"], t["steps_installed"], t["requests"]

    def install():
        return ops.install_guard_steps(
            requests, t["jobs_plain"], t["steps_plain"], t["run_config"]
        ).steps

    return {
        "guard_audit": lambda: ops.guard_audit(jobs, steps, t["run_config"]),
        "run_decision": lambda: ops.run_decision(requests, *states),
        "run_outcome": lambda: ops.run_outcome(requests, *states),
        "install_guard_steps": install,
        "remove_guard_steps": lambda: ops.remove_guard_steps(requests, jobs, steps).steps,
        "reinstall_guard_steps": lambda: ops.install_guard_steps(
            requests, jobs, steps, t["run_config"]
        ).steps,
        "grantees": lambda: ops.grantees(t["grant_events"]),
        "direct_grants": lambda: ops.direct_grants(t["grant_events"], t["principals"]),
        "install_preview": lambda: ops.install_preview(
            requests, t["jobs_plain"], t["steps_plain"], t["run_config"]
        ),
        "status_check": lambda: ops.status_check(ops.guard_config_name(steps), *states),
        "requests_missing_jobs": lambda: ops.requests_missing_jobs(requests, jobs),
        "objects_missing": lambda: ops.objects_missing(t["expected_objects"], t["objects"]),
    }


def stream_seconds(spark, scratch: str, n: int) -> float:
    events = spark.read.parquet(f"{scratch}/grant_events")
    started = time.perf_counter()
    refuse_grants(
        spark.readStream.schema(events.schema).parquet(f"{scratch}/grant_events"),
        lambda session: session.read.parquet(f"{scratch}/principals"),
        output=f"{scratch}/stream-{n}/output",
        checkpoint=f"{scratch}/stream-{n}/checkpoint",
    ).awaitTermination()
    return time.perf_counter() - started


def seconds(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    store_tables(spark, folder, scratch)

    times: dict[str, float] = {}
    for name, build in headline_queries(spark, scratch).items():
        seconds(build)
        times[name] = statistics.median(seconds(build) for _ in range(RUNS))
    stream_seconds(spark, scratch, 0)
    times["direct_grants_stream"] = statistics.median(
        stream_seconds(spark, scratch, n + 1) for n in range(RUNS)
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(sec, 3) for name, sec in times.items()},
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
