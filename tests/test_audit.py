"""Audit branches that the derived tables do not reach."""

from guardwork import fixed
from guardwork.operators import guard_audit, guard_steps_found

S1, S2 = fixed.GUARD_STEP_1_NAME, fixed.GUARD_STEP_2_NAME


def step(job, n, name, command, target=0):
    return (1, job, n, name, "TSQL", command, 4, target, 2, 0, "DBA")


def call(config):
    return f"EXECUTE chk {fixed.CONFIG_MARKER}{config}'"


def audit(table, steps, start=1, configs=("ASIA",)):
    jobs = table("jobs", (1, 7, "Load", start))
    config = table("run_config", *[(1, c, "Sales", True) for c in configs])
    rows = guard_audit(jobs, table("steps", *steps), config).collect()
    assert len(rows) == 1
    return rows[0]


def test_configured_and_case_of_names(table):
    steps = [
        step(7, 1, S1.upper(), call("asia"), 3),
        step(7, 2, S2.lower() + " ", call("Asia")),
        step(7, 3, "Work", "SELECT 1"),
    ]
    row = audit(table, steps)
    assert row.status == fixed.STATUS_CONFIGURED
    assert (row.config_name, row.driver_database) == ("asia", "Sales")
    assert (row.real_start_step_id, row.real_start_step_name) == (3, "Work")
    assert row.real_start_command == "SELECT 1"


def test_job_without_steps_stays(table):
    row = audit(table, [step(8, 1, "Other job", "x")], start=2)
    assert row.status == fixed.STATUS_NOT_SET_UP
    assert (row.real_start_step_id, row.real_start_step_name) == (2, None)


def test_first_branch_wins(table):
    steps = [step(7, 1, S1, call("GONE"), 3)]
    assert audit(table, steps, start=2).status == fixed.STATUS_BYPASSED
    assert audit(table, steps).status == fixed.STATUS_CONFIG_MISSING
    assert audit(table, steps, configs=("GONE",)).status == fixed.STATUS_NOT_SAME_CONFIG


def test_unreadable_commands_never_fail_the_query(table):
    no_marker = [step(7, 1, S1, "EXECUTE chk", 3), step(7, 2, S2, call("ASIA"))]
    no_quote = [
        step(7, 1, S1, call("ASIA"), 3),
        step(7, 2, S2, f"EXECUTE chk {fixed.CONFIG_MARKER}ASIA"),
    ]
    assert audit(table, no_marker).status == fixed.STATUS_UNREADABLE
    assert audit(table, no_marker).real_start_step_id == 3
    assert audit(table, no_quote).status == fixed.STATUS_UNREADABLE
    assert audit(table, no_marker, start=2).status == fixed.STATUS_BYPASSED


def test_guard_without_command_counts_as_not_set_up(table):
    steps = [step(7, 1, S1, None, 3), step(7, 2, S2, "EXECUTE chk")]
    row = audit(table, steps)
    assert row.status == fixed.STATUS_NOT_SET_UP
    assert row.real_start_step_id == 3


def test_same_job_id_on_two_servers(table):
    jobs = table("jobs", (1, 7, "Load", 1), (2, 7, "Load", 1))
    steps = table("steps", step(7, 1, S1, call("ASIA"), 3))
    found = {r.server_id: r.guard_1_name for r in guard_steps_found(jobs, steps).collect()}
    assert found == {1: S1, 2: None}
