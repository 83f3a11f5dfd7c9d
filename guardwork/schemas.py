"""Schemas of the fleet tables.

Every table carries ``server_id``.  Job ids, names and principals are unique only
within a server.  ``job_id`` and ``server_id`` may be any type that hashes (numbers
or strings) as long as it is the same in all tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

JOB_KEY = ["server_id", "job_id"]

TABLES: dict[str, str] = {
    "jobs": "server_id bigint, job_id bigint, job_name string, start_step_id int",
    "steps": (
        "server_id bigint, job_id bigint, step_id int, step_name string, "
        "subsystem string, command string, on_success_action int, "
        "on_success_step_id int, on_fail_action int, on_fail_step_id int, "
        "database_name string"
    ),
    "run_config": (
        "server_id bigint, config_name string, driver_database string, "
        "run_if_ungrouped boolean"
    ),
    "databases": "server_id bigint, database_id int, database_name string",
    "replica_states": "server_id bigint, replica_id int, group_id int, role_desc string",
    "db_replica_states": (
        "server_id bigint, replica_id int, group_id int, database_id int, "
        "is_local boolean"
    ),
    "requests": "server_id bigint, job_name string, config_name string",
    "principals": "server_id int, principal_name string, principal_type string",
    "grant_events": "event_id bigint, ts timestamp_ntz, server_id int, event_xml string",
    "expected_objects": "server_id bigint, object_name string",
    "objects": "server_id bigint, object_name string, object_type string",
}

# Step columns that may be present besides the ones above.  The first group travels
# with a step; the second is its run history, which a re-added step starts without.
CARRIED_STEP_COLUMNS: dict[str, str] = {
    "flags": "int",
    "additional_parameters": "string",
    "cmdexec_success_code": "int",
    "server": "string",
    "database_user_name": "string",
    "retry_attempts": "int",
    "retry_interval": "int",
    "os_run_priority": "int",
    "output_file_name": "string",
    "proxy_id": "int",
}
HISTORY_STEP_COLUMNS: dict[str, str] = {
    "last_run_outcome": "int",
    "last_run_duration": "int",
    "last_run_retries": "int",
    "last_run_date": "int",
    "last_run_time": "int",
    "step_uid": "string",
}


def column_names(table: str) -> list[str]:
    """Column names of a fleet table in declared order."""
    return [field.split()[0] for field in TABLES[table].split(", ")]


def require(df: DataFrame, table: str) -> DataFrame:
    """Return ``df`` if it has all columns of the table; extra columns are welcome."""
    missing = [c for c in column_names(table) if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} lacks columns: {', '.join(missing)}")
    return df
