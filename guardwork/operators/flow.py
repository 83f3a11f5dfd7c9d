"""Step flow: installing, re-installing and removing guards for many jobs at once.

All three come down to one small row per job (what to do with its steps) and one
rewrite of the step table.  Installing shifts steps by two behind the new guard;
removing drops the guard and shifts back; re-installing does both, so the kept steps
stay where they are and only the guard rows are replaced.

The job rows are made from numeric aggregates over the steps.  Which step ids a job has is
kept in bit masks of 62 ids each, which combine by OR: nearly every job is one mask, combined
before the shuffle, and repeats and gaps are still found exactly.

Tables may have columns of any name besides their own; those travel under neutral names while
rows are joined and rewritten, so that no name can meet one that is used here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.text import ci
from guardwork.operators.guard import DEFAULT_GUARD, Guard
from guardwork.operators.requests import NAME_KEY, named_jobs, named_requests
from guardwork.plans.joins import (
    join_bounded,
    join_steps,
    lookup,
    lookup_repeated,
    only_matching,
    sized_by_rows,
)
from guardwork.schemas import (
    CARRIED_STEP_COLUMNS,
    HISTORY_STEP_COLUMNS,
    JOB_KEY,
    column_names,
    require,
)

OK = "ok"
DUPLICATE_REQUEST = "duplicate_request"
MISSING_JOB = "missing_job"
AMBIGUOUS_JOB = "ambiguous_job"
NO_STEPS = "no_steps"
MISSING_CONFIG = "missing_config"
AMBIGUOUS_CONFIG = "ambiguous_config"
QUOTE_IN_CONFIG = "quote_in_config"
REPEATED_STEPS = "repeated_steps"
STEP_GAPS = "step_gaps"
BAD_STEP_1 = "bad_step_1"
BAD_STEP_2 = "bad_step_2"
BAD_START = "bad_start"
DANGLING_TARGET = "dangling_target"

# Order in which a batch reports its problems.
REASONS = [
    DUPLICATE_REQUEST,
    MISSING_JOB,
    AMBIGUOUS_JOB,
    NO_STEPS,
    MISSING_CONFIG,
    AMBIGUOUS_CONFIG,
    QUOTE_IN_CONFIG,
    REPEATED_STEPS,
    STEP_GAPS,
    BAD_STEP_1,
    BAD_STEP_2,
    BAD_START,
    DANGLING_TARGET,
]


class RequestError(ValueError):
    """A batch was refused; ``rows`` holds the requests with the reported reason."""

    def __init__(self, reason: str, rows: DataFrame | None):
        super().__init__(f"request list refused: {reason}")
        self.reason = reason
        self.rows = rows


@dataclass(frozen=True)
class Flow:
    """Result of a change: both new tables, and the outcome for each requested job."""

    steps: DataFrame
    jobs: DataFrame
    checks: DataFrame


def _moved(target: Column | str, k: Column | int) -> Column:
    """A step target moved by k; 0 means "no target" and stays."""
    col = F.col(target) if isinstance(target, str) else target
    return F.when(col == 0, F.lit(0)).otherwise(col + k)


def shift_flow(steps: DataFrame, k: Column | int) -> DataFrame:
    """Move step ids and step targets by k."""
    return require(steps, "steps").withColumns(
        {
            "step_id": F.col("step_id") + k,
            "on_success_step_id": _moved("on_success_step_id", k),
            "on_fail_step_id": _moved("on_fail_step_id", k),
        }
    )


MASK_IDS = 62
_PLACE = f"CAST(pmod(CAST(step_id AS bigint) - 1, {MASK_IDS}) AS int)"


def step_facts(steps: DataFrame, guard: Guard = DEFAULT_GUARD) -> DataFrame:
    """What the checks need to know of each job's steps: numbers only, one scan.

    Of each stretch of ``MASK_IDS`` step ids a mask tells which are there.  Ids are repeated
    where a stretch has more rows than its mask has bits.  A job with very many steps has many
    stretches, which are dealt out over the tasks.
    """
    into_guard = "step_id > 2 AND (on_success_step_id IN (1, 2) OR on_fail_step_id IN (1, 2))"
    per_stretch = (
        require(steps, "steps")
        .groupBy(*JOB_KEY, F.expr(f"floor((CAST(step_id AS bigint) - 1) / {MASK_IDS})").alias("_stretch"))
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.expr(f"bit_or(shiftleft(1L, {_PLACE}))").alias("_mask"),
            F.min("step_id").alias("_first"),
            F.max("step_id").alias("_last"),
            F.max(guard.is_step_1()).alias("_guard_1"),
            F.max(guard.is_step_2()).alias("_guard_2"),
            F.expr("max(CASE WHEN step_id = 1 THEN on_success_step_id END)").alias("_target"),
            F.expr(f"max({into_guard})").alias("_into_guard"),
        )
    )
    return per_stretch.groupBy(*JOB_KEY).agg(
        F.sum("_rows").alias("n_steps"),
        F.min("_first").alias("min_step_id"),
        F.max("_last").alias("max_step_id"),
        # Steps without an id have no mask; more than one of them are repeats as well.
        F.expr("max(_rows > coalesce(bit_count(_mask), 1))").alias("repeats"),
        F.max("_guard_1").alias("has_guard_1"),
        F.max("_guard_2").alias("has_guard_2"),
        F.max("_target").alias("step_1_target"),
        F.max("_into_guard").alias("targets_guard"),
    )


_OWN = {
    "steps": {*column_names("steps"), *CARRIED_STEP_COLUMNS, *HISTORY_STEP_COLUMNS},
    "jobs": {*column_names("jobs")},
}


def _neutral(df: DataFrame, table: str) -> DataFrame:
    """The table with its extra columns under names that nothing else has; ``toDF`` undoes it."""
    require(df, table)
    return df.toDF(*(c if c in _OWN[table] else f"_extra_{i}" for i, c in enumerate(df.columns)))


def _requested_once(requests: DataFrame) -> DataFrame:
    """One row per requested job; repeated requests are counted, not multiplied."""
    names = [c for c in ("job_name", "config_name") if c in requests.columns]
    return (
        named_requests(requests)
        .groupBy(*NAME_KEY)
        .agg(
            F.count(F.lit(1)).alias("n_requests"),
            *[F.min(name).alias(name) for name in names],
        )
    )


def _with_job_facts(
    requests: DataFrame, jobs: DataFrame, steps: DataFrame, guard: Guard
) -> DataFrame:
    """Requested jobs with their id, start step and step facts; nulls where absent.

    Facts are joined to jobs before jobs are joined to requests, so that no join here
    has rows without a key.  A short request list first cuts down jobs and steps.
    """
    asked = _requested_once(requests)
    keys = named_requests(requests)
    known = (
        only_matching(named_jobs(jobs), keys, NAME_KEY, bound=requests)
        .groupBy(*NAME_KEY)
        .agg(
            F.min("job_id").alias("job_id"),
            F.min("start_step_id").alias("start_step_id"),
            F.count(F.lit(1)).alias("n_jobs"),
        )
    )
    own_steps = only_matching(steps, known, JOB_KEY, bound=requests)
    facts = known.join(sized_by_rows(step_facts(own_steps, guard), JOB_KEY), JOB_KEY, "left")
    return asked.join(facts, NAME_KEY, "left")


# The first condition that holds gives the reason.
_STEP_RULES = [
    ("repeats", REPEATED_STEPS),
    ("(n_steps = max_step_id AND min_step_id = 1) IS NOT TRUE", STEP_GAPS),
]
_REQUEST_RULES = [
    ("n_requests > 1", DUPLICATE_REQUEST),
    ("job_id IS NULL", MISSING_JOB),
    ("n_jobs > 1", AMBIGUOUS_JOB),
    ("n_steps IS NULL", NO_STEPS),
    ("_configs IS NULL", MISSING_CONFIG),
    ("_configs > 1", AMBIGUOUS_CONFIG),
    ("contains(config_name, chr(39))", QUOTE_IN_CONFIG),
    *_STEP_RULES,
]
_REMOVAL_RULES = [
    ("has_guard_2 IS NOT TRUE", BAD_STEP_2),
    ("start_step_id <> 1", BAD_START),
    ("targets_guard OR step_1_target < 3", DANGLING_TARGET),
]
_INSTALL_RULES = _REQUEST_RULES + [
    (f"has_guard_1 AND ({rule})", reason) for rule, reason in _REMOVAL_RULES
]
_REMOVE_RULES = [
    *_REQUEST_RULES[:3],
    ("has_guard_1 IS NOT TRUE", BAD_STEP_1),
    *_REMOVAL_RULES,
    *_STEP_RULES,
]


def _first_reason(rules: list[tuple[str, str]]) -> Column:
    cases = " ".join(f"WHEN {rule} THEN '{reason}'" for rule, reason in rules)
    return F.expr(f"CASE {cases} ELSE '{OK}' END")


def install_check(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    run_config: DataFrame,
    guard: Guard = DEFAULT_GUARD,
) -> DataFrame:
    """Per requested job the first reason against installing, or ``ok``."""
    return _per_request(requests, install_plan(requests, jobs, steps, run_config, guard))


def _per_request(requests: DataFrame, plan: DataFrame) -> DataFrame:
    """The outcome for each request; repeated ones have a row each."""
    outcome = plan.select(*NAME_KEY, "job_id", "reason")
    asked = named_requests(requests)
    names = [c for c in ("server_id", "job_name", "config_name") if c in requests.columns]
    return lookup_repeated(asked, outcome, NAME_KEY, spread=names, how="left", bound=requests).select(
        *names, "job_id", F.coalesce("reason", F.lit(MISSING_JOB)).alias("reason")
    )


def install_plan(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    run_config: DataFrame,
    guard: Guard,
) -> DataFrame:
    configs = (
        require(run_config, "run_config")
        .groupBy("server_id", ci("config_name").alias("_config"))
        .agg(F.count(F.lit(1)).alias("_configs"))
    )
    asked = _with_job_facts(require(requests, "requests"), jobs, steps, guard)
    found = lookup(
        asked.withColumn("_config", ci("config_name")),
        configs,
        ["server_id", "_config"],
        spread=["_job"],
        bound=run_config,
    )
    return found.withColumn("reason", _first_reason(_INSTALL_RULES))


def remove_check(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    guard: Guard = DEFAULT_GUARD,
) -> DataFrame:
    """Per job to be unguarded the first reason against it, or ``ok``."""
    named = requests.select("server_id", "job_name")
    return _per_request(named, remove_plan(requests, jobs, steps, guard))


def remove_plan(
    requests: DataFrame, jobs: DataFrame, steps: DataFrame, guard: Guard
) -> DataFrame:
    asked = _with_job_facts(requests.select("server_id", "job_name"), jobs, steps, guard)
    return asked.withColumn("reason", _first_reason(_REMOVE_RULES))


def _raise_if_refused(checks: DataFrame) -> None:
    """Strict mode: report the batch's first problem, with all requests that have it.

    Only the distinct reasons come to the driver, at most one row for each.
    """
    found = {row.reason for row in checks.select("reason").distinct().collect()}
    if not found:
        raise RequestError("empty", None)
    for reason in REASONS:
        if reason in found:
            raise RequestError(reason, checks.where(F.col("reason") == reason))


def _without_guard(
    given: DataFrame, changes: DataFrame, bound: DataFrame
) -> DataFrame:
    """Drop the guard rows of the changed jobs and move their other steps back."""
    steps = _neutral(given, "steps")
    todo = changes.select(*JOB_KEY, "max_step_id", F.lit(-2).alias("_shift"))
    kept = join_steps(steps, todo, bound).where("_shift IS NULL OR step_id > 2")
    moved = shift_flow(kept, F.coalesce("_shift", F.lit(0))).select(*steps.columns)
    return moved.toDF(*given.columns)


# What a step becomes: 0 is the step itself, 1 and 2 are new guard rows.  The first
# step of a changed job brings the guard along; rows of an earlier guard are left out.
_BECOMES = """
    CASE WHEN _had_guard IS NULL THEN array(0)
         WHEN step_id = 1 AND _had_guard THEN array(1, 2)
         WHEN step_id = 1 THEN array(1, 2, 0)
         WHEN step_id = 2 AND _had_guard THEN CAST(array() AS array<int>)
         ELSE array(0) END
"""
# For listings: -1 is the step as it was before.
_BEFORE_AND_AFTER = f"concat(array(-1), {_BECOMES})"

# What the rewrite needs to know of a requested job; a null flag leaves the job alone.
_CHANGE = [
    "config_name AS _config",
    "CASE WHEN has_guard_1 THEN step_1_target ELSE start_step_id + 2 END AS _first_step",
    f"CASE WHEN reason = '{OK}' THEN coalesce(has_guard_1, false) END AS _had_guard",
]


def _row_columns(steps: DataFrame, guard: Guard) -> dict[str, str]:
    """SQL for each step column of the row named by ``_row``.

    Re-added steps start without run history.
    """
    shift = "CASE WHEN _had_guard THEN 0 WHEN NOT _had_guard THEN 2 ELSE 0 END"
    own = {c: f"`{c}`" for c in steps.columns}
    own["step_id"] = f"step_id + {shift}"
    for c in ("on_success_step_id", "on_fail_step_id"):
        own[c] = f"CASE WHEN {c} = 0 THEN 0 ELSE {c} + {shift} END"
    for c in HISTORY_STEP_COLUMNS:
        own[c] = f"CASE WHEN _had_guard IS NULL THEN {c} END"
    rows = _guard_rows(guard)

    def value(c: str) -> str:
        if c in JOB_KEY:
            return c
        case = f"CASE _row WHEN -1 THEN `{c}` WHEN 0 THEN {own[c]}"
        if c in rows:
            first, second = rows[c]
            kind = steps.schema[c].dataType.simpleString()
            case += f" WHEN 1 THEN CAST({first} AS {kind}) WHEN 2 THEN CAST({second} AS {kind})"
        return f"{case} END"

    return {c: value(c) for c in steps.columns}


def _with_guard(
    given: DataFrame, plan: DataFrame, bound: DataFrame, guard: Guard
) -> DataFrame:
    """Put new guard rows in front of the accepted jobs, in one pass over the steps."""
    steps = _neutral(given, "steps")
    todo = plan.where(F.col("reason") == OK).selectExpr(*JOB_KEY, "max_step_id", *_CHANGE)
    joined = join_steps(steps, todo, bound).withColumn("_row", F.explode(F.expr(_BECOMES)))
    columns = _row_columns(steps, guard)
    return joined.selectExpr(*[f"{sql} AS `{c}`" for c, sql in columns.items()]).toDF(*given.columns)


def _guard_rows(guard: Guard) -> dict[str, tuple[str, str]]:
    """Columns of the two guard rows, as SQL; any other column is null in them."""

    def text(value: str) -> str:
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    def command(n: int) -> str:
        before, after = guard.command_parts(n)
        return f"concat({text(before)}, _config, {text(after)})"

    return {
        "step_id": ("1", "2"),
        "step_name": (text(guard.step_1_name), text(guard.step_2_name)),
        "subsystem": ("'TSQL'", "'TSQL'"),
        "command": (command(1), command(2)),
        "on_success_action": (f"{fixed.GO_TO_STEP}", f"{fixed.QUIT_WITH_SUCCESS}"),
        "on_success_step_id": ("_first_step", "0"),
        "on_fail_action": (f"{fixed.GO_TO_STEP}", f"{fixed.QUIT_WITH_FAILURE}"),
        "on_fail_step_id": ("2", "0"),
        "database_name": (text(guard.database), text(guard.database)),
        "flags": ("0", "0"),
        "cmdexec_success_code": ("0", "0"),
        "retry_attempts": ("0", "0"),
        "retry_interval": ("0", "0"),
        "os_run_priority": ("0", "0"),
    }


def _restart(given: DataFrame, changes: DataFrame, bound: DataFrame) -> DataFrame:
    """The job table with the new start steps."""
    jobs = _neutral(given, "jobs")
    starts = changes.select(*JOB_KEY, "_new_start")
    return (
        join_bounded(jobs, starts, JOB_KEY, bound)
        .withColumn("start_step_id", F.coalesce("_new_start", "start_step_id"))
        .select(*jobs.columns)
        .toDF(*given.columns)
    )


def install_guard_steps(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    run_config: DataFrame,
    guard: Guard = DEFAULT_GUARD,
    strict: bool = False,
) -> Flow:
    """Put the guard in front of the requested jobs, replacing one that is there.

    Refused requests leave their jobs as they are; with ``strict`` the whole batch
    is refused instead.  ``strict`` works out the checks at once; store them first if the
    tables are large (``install_check``), as writing the result works them out again.
    """
    plan = install_plan(requests, jobs, steps, run_config, guard)
    flow = install_flow(plan, requests, jobs, steps, guard)
    if strict:
        _raise_if_refused(flow.checks)
    return flow


def install_flow(
    plan: DataFrame, requests: DataFrame, jobs: DataFrame, steps: DataFrame, guard: Guard
) -> Flow:
    """The flow of an install plan, which may have been stored meanwhile."""
    starts = plan.where(F.col("reason") == OK).select(*JOB_KEY, F.lit(1).alias("_new_start"))
    return Flow(
        steps=_with_guard(steps, plan, requests, guard),
        jobs=_restart(jobs, starts, requests),
        checks=_per_request(requests, plan),
    )


def remove_guard_steps(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    guard: Guard = DEFAULT_GUARD,
    strict: bool = False,
) -> Flow:
    """Take the guard off the named jobs and let them start on their real start step."""
    flow = remove_flow(remove_plan(requests, jobs, steps, guard), requests, jobs, steps)
    if strict:
        _raise_if_refused(flow.checks)
    return flow


def remove_flow(plan: DataFrame, requests: DataFrame, jobs: DataFrame, steps: DataFrame) -> Flow:
    """The flow of a removal plan, which may have been stored meanwhile."""
    changes = plan.where(F.col("reason") == OK).select(
        *JOB_KEY, "max_step_id", (F.col("step_1_target") - 2).alias("_new_start")
    )
    return Flow(
        steps=_without_guard(steps, changes, requests),
        jobs=_restart(jobs, changes, requests),
        checks=_per_request(requests.select("server_id", "job_name"), plan),
    )


# What a listing says besides the steps' own columns.
_LISTED = {"job_name", "start_step_id", "phase"}


def install_preview(
    requests: DataFrame,
    jobs: DataFrame,
    steps: DataFrame,
    run_config: DataFrame,
    guard: Guard = DEFAULT_GUARD,
) -> DataFrame:
    """The requested jobs before and after an install, by job name and step.

    Nothing is written; the phase column tells the two listings apart.  Both come from
    one pass over the steps.  A job without steps is listed with nulls.  An extra step column
    that has the name of a listed one is listed as that of the step (``job_name_of_step``).
    """
    given, steps = steps, _neutral(steps, "steps")
    names = [f"{c}_of_step" if c.lower() in _LISTED else c for c in given.columns]
    known = install_plan(requests, jobs, steps, run_config, guard).where("job_id IS NOT NULL")
    listed = known.selectExpr(
        *JOB_KEY, "job_name", "start_step_id", "max_step_id", *_CHANGE
    )
    rows = join_steps(steps, listed, requests, how="right").withColumn(
        "_row", F.explode(F.expr(_BEFORE_AND_AFTER))
    )
    columns = _row_columns(steps, guard)
    stepped = rows.selectExpr(
        *JOB_KEY,
        "job_name",
        "CASE WHEN _row = -1 OR _had_guard IS NULL THEN start_step_id ELSE 1 END AS start_step_id",
        *[f"{sql} AS `{c}`" for c, sql in columns.items() if c not in JOB_KEY],
        "CASE _row WHEN -1 THEN 'before' ELSE 'after' END AS phase",
    )
    listing = stepped.orderBy(F.desc("phase"), "job_name", "server_id", "step_id")
    names = dict(zip(steps.columns, names, strict=True))
    return listing.toDF(*(names.get(c, c) for c in listing.columns))
