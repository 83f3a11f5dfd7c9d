"""Row counts per outcome, as worked out independently for the derived tables."""

from pyspark.sql import functions as F

from guardwork import fixed
from guardwork import operators as ops
from guardwork.sources.derived import TABLE_NAMES

TABLE_ROWS = {
    "jobs_plain": 15_000,
    "steps_plain": 60_000,
    "run_config": 108,
    "databases": 114,
    "replica_states": 75,
    "db_replica_states": 150,
    "requests": 11_251,
    "jobs_installed": 15_000,
    "steps_installed": 85_000,
    "principals": 1_350,
    "grant_events": 10_000,
    "expected_objects": 75,
    "objects": 2_057,
}


def counts(df, column):
    return {row[column]: row["count"] for row in df.groupBy(column).count().collect()}


def test_table_rows(fleet):
    assert {name: getattr(fleet, name).count() for name in TABLE_NAMES} == TABLE_ROWS


def test_audit_statuses(fleet):
    audit = ops.guard_audit(fleet.jobs_installed, fleet.steps_installed, fleet.run_config)
    assert counts(audit, "status") == {
        fixed.STATUS_BYPASSED: 1_136,
        fixed.STATUS_CONFIG_MISSING: 1_503,
        fixed.STATUS_NOT_SAME_CONFIG: 1_224,
        fixed.STATUS_NOT_SET_UP: 2_500,
        fixed.STATUS_CONFIGURED: 8_637,
    }


def test_run_reasons_in_both_modes(fleet):
    states = (fleet.run_config, fleet.databases, fleet.replica_states, fleet.db_replica_states)
    documented = counts(ops.run_decision(fleet.requests, *states), "reason")
    written = counts(ops.run_decision_as_written(fleet.requests, *states), "reason")
    assert documented == {
        "config_missing": 1_800,
        "database_missing": 819,
        "ok": 1_049 + 1_797,
        "not_here": 4_094 + 1_692,
    }
    assert written == documented | {"ok": 1_049 + 1_797 + 1_692, "not_here": 4_094}


def test_request_reasons(fleet):
    checks = ops.install_check(
        fleet.requests, fleet.jobs_plain, fleet.steps_plain, fleet.run_config
    )
    assert counts(checks, "reason") == {
        "missing_config": 1_773,
        "missing_job": 1,
        "no_steps": 189,
        "ok": 9_288,
    }


def test_removal_reasons(fleet):
    checks = ops.remove_check(fleet.jobs_installed, fleet.jobs_installed, fleet.steps_installed)
    assert counts(checks, "reason") == {
        "bad_step_1": 2_500,
        "bad_step_2": 658,
        "ok": 10_766,
        "bad_start": 1_076,
    }


def test_grantees_by_principal_type(fleet):
    found = ops.grantees(fleet.grant_events).withColumn("name", F.lower("grantee"))
    known = fleet.principals.select(
        "server_id", F.lower("principal_name").alias("name"), "principal_type"
    )
    typed = counts(found.join(known, ["server_id", "name"], "left"), "principal_type")
    typed.pop(None)
    assert typed == {"G": 212, "R": 595, "S": 654, "U": 225}
    assert ops.direct_grants(fleet.grant_events, fleet.principals).count() == 856


def test_objects(fleet):
    assert ops.objects_like(fleet.objects).count() == 55
    assert ops.objects_missing(fleet.expected_objects, fleet.objects).count() == 20
