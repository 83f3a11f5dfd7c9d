"""Run rule, roles and guard calls on literals."""

import pytest

from guardwork.operators import (
    config_check,
    local_replica_role,
    run_decision,
    run_outcome,
    status_check,
)


@pytest.fixture
def server(table):
    """One server: a primary, a secondary, two ungrouped databases and a missing one."""
    config = table(
        "run_config",
        (1, "P", "prim", False),
        (1, "S", "SEC", True),
        (1, "U1", "alone", True),
        (1, "U0", "alone", False),
        (1, "GONE", "nowhere", True),
    )
    databases = table("databases", (1, 5, "PRIM"), (1, 6, "sec"), (1, 7, "alone"))
    roles = table(
        "replica_states", (1, 1, 1, "PRIMARY"), (1, 1, 2, "SECONDARY"), (1, 2, 2, "PRIMARY")
    )
    replicas = table(
        "db_replica_states", (1, 1, 1, 5, True), (1, 1, 2, 6, True), (1, 2, 2, 6, False)
    )
    return config, databases, roles, replicas


@pytest.fixture
def asked(table):
    return table("requests", *[(1, f"job {c}", c) for c in ("p", "s", "u1", "u0", "gone", "none")])


def by_config(df, column):
    return {row.config_name: row[column] for row in df.collect()}


def test_reasons(asked, server):
    assert by_config(run_decision(asked, *server), "reason") == {
        "p": "ok",
        "s": "not_here",
        "u1": "ok",
        "u0": "not_here",
        "gone": "database_missing",
        "none": "config_missing",
    }
    assert by_config(config_check(asked, *server[:2]), "passed") == {
        "p": True, "s": True, "u1": True, "u0": True, "gone": False, "none": False,
    }


def test_ungrouped_without_flag_runs_as_written(asked, server):
    written = by_config(run_decision(asked, *server, mode="as_written"), "runs")
    documented = by_config(run_decision(asked, *server), "runs")
    assert written.pop("u0") and not documented.pop("u0")
    assert written == documented


def test_unknown_mode_is_refused(asked, server):
    with pytest.raises(ValueError, match="mode"):
        run_decision(asked, *server, mode="maybe")


def test_three_end_states(asked, server):
    assert by_config(run_outcome(asked, *server), "outcome") == {
        "p": "run", "s": "skipped", "u1": "run", "u0": "skipped",
        "gone": "failed", "none": "failed",
    }


def test_job_fails_where_the_guard_procedure_is_missing(asked, server, spark):
    elsewhere = spark.createDataFrame([(2,), (2,)], "server_id bigint")
    outcome = run_outcome(asked, *server, guarded_servers=elsewhere)
    assert set(by_config(outcome, "outcome").values()) == {"failed"}
    assert outcome.count() == 6
    here = spark.createDataFrame([(1,), (1,)], "server_id bigint")
    assert by_config(run_outcome(asked, *server, guarded_servers=here), "outcome") == by_config(
        run_outcome(asked, *server), "outcome"
    )


def test_guard_calls(spark, server):
    calls = spark.createDataFrame(
        [(1, 1, "s"), (1, 2, "s"), (1, 2, "none"), (1, 3, "p"), (1, None, "p")],
        "server_id bigint, step_id int, config_name string",
    )
    answers = {
        (r.step_id, r.config_name): (r.reason, r.passed)
        for r in status_check(calls, *server).collect()
    }
    assert answers == {
        (1, "s"): ("not_here", False),
        (2, "s"): ("ok", True),
        (2, "none"): ("config_missing", False),
        (3, "p"): ("bad_step_id", False),
        (None, "p"): ("bad_step_id", False),
    }


def test_disagreeing_local_roles_are_a_data_error(table, server, asked):
    config, databases, _, _ = server
    roles = table("replica_states", (1, 1, 1, "PRIMARY"), (1, 1, 2, "SECONDARY"))
    replicas = table("db_replica_states", (1, 1, 1, 5, True), (1, 1, 2, 5, True))
    role = local_replica_role(databases, roles, replicas).collect()
    assert [(r.role_desc, r.role_rows, r.ambiguous) for r in role] == [(None, 2, True)]
    reasons = by_config(run_decision(asked, config, databases, roles, replicas), "reason")
    assert reasons["p"] == "ambiguous_role"


def test_agreeing_and_unknown_roles_are_not(table, server):
    databases = server[1]
    roles = table("replica_states", (1, 1, 1, "PRIMARY"), (1, 1, 2, "PRIMARY"), (1, 1, 3, None))
    replicas = table(
        "db_replica_states", (1, 1, 1, 5, True), (1, 1, 2, 5, True), (1, 1, 3, 6, True)
    )
    role = local_replica_role(databases, roles, replicas).collect()
    assert sorted((r.database_id, r.role_desc, r.role_rows, r.ambiguous) for r in role) == [
        (5, "PRIMARY", 2, False),
        (6, None, 1, False),
    ]
