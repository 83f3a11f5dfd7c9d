"""Fleet operators: DataFrames in, DataFrames out, nothing evaluated in between."""

from guardwork.operators.audit import guard_audit, guard_config_name, guard_steps_found
from guardwork.operators.decision import (
    config_check,
    local_replica_role,
    run_decision,
    run_decision_as_written,
    run_outcome,
    status_check,
)
from guardwork.operators.flow import (
    Flow,
    RequestError,
    install_check,
    install_guard_steps,
    install_preview,
    remove_check,
    remove_guard_steps,
    shift_flow,
)
from guardwork.operators.grants import (
    broken_events,
    direct_grants,
    grantees,
    refused_grants,
)
from guardwork.operators.guard import DEFAULT_GUARD, Guard
from guardwork.operators.objects import expected_on, objects_like, objects_missing
from guardwork.operators.requests import (
    install_worklist,
    requests_duplicate_jobs,
    requests_empty,
    requests_jobs_without_steps,
    requests_missing_configs,
    requests_missing_jobs,
)

__all__ = [
    "DEFAULT_GUARD",
    "Flow",
    "Guard",
    "RequestError",
    "broken_events",
    "config_check",
    "direct_grants",
    "expected_on",
    "grantees",
    "guard_audit",
    "guard_config_name",
    "guard_steps_found",
    "install_check",
    "install_guard_steps",
    "install_preview",
    "install_worklist",
    "local_replica_role",
    "objects_like",
    "objects_missing",
    "refused_grants",
    "remove_check",
    "remove_guard_steps",
    "requests_duplicate_jobs",
    "requests_empty",
    "requests_jobs_without_steps",
    "requests_missing_configs",
    "requests_missing_jobs",
    "run_decision",
    "run_decision_as_written",
    "run_outcome",
    "shift_flow",
    "status_check",
]
