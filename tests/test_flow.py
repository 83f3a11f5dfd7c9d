"""Installing, removing and re-installing guards."""

import random

import pytest
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork import operators as ops
from guardwork.operators.flow import step_facts
from guardwork.schemas import CARRIED_STEP_COLUMNS, HISTORY_STEP_COLUMNS, TABLES
from guardwork.sources.derived import DerivedFleet

S1, S2 = fixed.GUARD_STEP_1_NAME, fixed.GUARD_STEP_2_NAME
HOME = ops.Guard(database="DBA")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def same(a, b):
    """Equal as bags of rows; distinct keys make exceptAll exact in both directions."""
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


@pytest.fixture
def one_step_job(table):
    jobs = table("jobs", (1, 7, "Demo - Simple Job", 1))
    steps = table(
        "steps", (1, 7, 1, "Run SSIS Package", "SSIS", "dtexec", 1, 0, 2, 0, "master")
    )
    requests = table("requests", (1, "Demo - Simple Job", "Demo"))
    config = table("run_config", (1, "Demo", "Sales", True))
    return requests, jobs, steps, config


def test_one_step_job(one_step_job):
    flow = ops.install_guard_steps(*one_step_job, guard=HOME)
    command = fixed.GUARD_COMMAND_HEAD + "{} , " + fixed.CONFIG_MARKER + "Demo'\t"
    assert rows(flow.steps, *[c.split()[0] for c in TABLES["steps"].split(", ")]) == [
        (1, 7, 1, S1, "TSQL", command.format(1), 4, 3, 4, 2, "DBA"),
        (1, 7, 2, S2, "TSQL", command.format(2), 1, 0, 2, 0, "DBA"),
        (1, 7, 3, "Run SSIS Package", "SSIS", "dtexec", 1, 0, 2, 0, "master"),
    ]
    assert rows(flow.jobs, "job_id", "start_step_id") == [(7, 1)]
    audit = ops.guard_audit(flow.jobs, flow.steps, one_step_job[3]).collect()
    assert [(r.status, r.real_start_step_name) for r in audit] == [
        (fixed.STATUS_CONFIGURED, "Run SSIS Package")
    ]


def test_full_step_table_keeps_settings_and_loses_history(spark, one_step_job):
    requests, jobs, steps, config = one_step_job
    for name, kind in {**CARRIED_STEP_COLUMNS, **HISTORY_STEP_COLUMNS}.items():
        steps = steps.withColumn(name, F.lit(9).cast(kind))
    steps = steps.withColumn("owner's note", F.array(F.struct(F.lit("n").alias("x"))))
    flow = ops.install_guard_steps(requests, jobs, steps, config, HOME)
    assert flow.steps.schema.simpleString() == steps.schema.simpleString()
    by_step = {r.step_id: r.asDict() for r in flow.steps.collect()}
    for name in CARRIED_STEP_COLUMNS:
        assert str(by_step[3][name]) == "9"
    for name in HISTORY_STEP_COLUMNS:
        assert by_step[3][name] is None
    assert [by_step[n]["owner's note"] is None for n in (1, 2, 3)] == [True, True, False]
    zero = {"flags", "cmdexec_success_code", "retry_attempts", "retry_interval", "os_run_priority"}
    for n in (1, 2):
        for name in {**CARRIED_STEP_COLUMNS, **HISTORY_STEP_COLUMNS}:
            assert by_step[n][name] == (0 if name in zero else None)
    back = ops.remove_guard_steps(requests, flow.jobs, flow.steps, HOME)
    assert rows(back.steps, "step_id", "flags") == [(1, 9)]


def test_quotes_in_guard_texts(one_step_job):
    guard = ops.Guard(database="D'B", step_1_name="It's \\ 1", step_2_name="It's 2")
    flow = ops.install_guard_steps(*one_step_job, guard=guard)
    found = rows(flow.steps, "step_id", "step_name", "database_name")
    assert found[:2] == [(1, "It's \\ 1", "D'B"), (2, "It's 2", "D'B")]
    checks = ops.remove_check(one_step_job[0], flow.jobs, flow.steps, guard)
    assert rows(checks, "reason") == [("ok",)]


@pytest.fixture(scope="module")
def plain(fleet):
    tables = [fleet.requests, fleet.jobs_plain, fleet.steps_plain, fleet.run_config]
    return [t.cache() for t in tables]


def test_remove_undoes_install(plain):
    requests, jobs, steps, config = plain
    flow = ops.install_guard_steps(requests, jobs, steps, config, HOME)
    back = ops.remove_guard_steps(requests, flow.jobs, flow.steps, HOME)
    assert same(back.steps, steps)
    assert same(back.jobs, jobs)


def test_installed_jobs(plain):
    requests, jobs, steps, config = plain
    flow = ops.install_guard_steps(requests, jobs, steps, config, HOME)
    done = flow.checks.where("reason = 'ok'").select("server_id", "job_id")
    assert flow.steps.count() == steps.count() + 2 * done.count()

    bounds = F.struct(F.min("step_id"), F.max("step_id"), F.count("*"), F.countDistinct("step_id"))
    targets = F.greatest(F.max("on_success_step_id"), F.max("on_fail_step_id"))
    per_job = flow.steps.join(done, ["server_id", "job_id"]).groupBy("server_id", "job_id")
    # Some derived jobs with a single step start on step 2, which their guard keeps.
    wrong = per_job.agg(bounds.alias("b"), targets.alias("t")).where(
        "b.col1 <> 1 OR b.col2 <> b.col3 OR b.col3 <> b.col4 OR (t > b.col2 AND b.col2 > 3)"
    )
    assert wrong.isEmpty()

    audit = ops.guard_audit(flow.jobs, flow.steps, config).join(done, ["server_id", "job_id"])
    assert audit.where(F.col("status") != fixed.STATUS_CONFIGURED).isEmpty()
    assert audit.count() == done.count()


def test_reinstalling_twice_is_reinstalling_once(fleet):
    requests, config = fleet.requests, fleet.run_config
    once = ops.install_guard_steps(requests, fleet.jobs_installed, fleet.steps_installed, config)
    steps, jobs = once.steps.cache(), once.jobs.cache()
    twice = ops.install_guard_steps(requests, jobs, steps, config)
    assert same(twice.steps, steps)
    assert same(twice.jobs, jobs)


def test_reinstalling_is_removing_and_installing(fleet):
    """The one-pass form against the two steps it stands for.

    A job that has nothing but its guard is left out: without the guard it has no
    steps, so a separate install would refuse it.
    """
    config = fleet.run_config
    jobs, steps = fleet.jobs_installed, fleet.steps_installed
    own = steps.where("step_id = 3 OR (step_id = 1 AND job_id % 6 = 0)")
    accepted = (
        ops.install_check(fleet.requests, jobs, steps, config)
        .where("reason = 'ok'")
        .join(own, ["server_id", "job_id"], "left_semi")
        .select("server_id", "job_name", "config_name")
        .cache()
    )
    assert accepted.count() > 7_000
    direct = ops.install_guard_steps(accepted, jobs, steps, config)
    bare = ops.remove_guard_steps(accepted, jobs, steps)
    again = ops.install_guard_steps(accepted, bare.jobs, bare.steps, config)
    assert same(direct.steps, again.steps)
    assert same(direct.jobs, again.jobs)


def guarded(job, config="A", step_2=S2, kept_target=0, first_target=3):
    call = f"chk {fixed.CONFIG_MARKER}{config}'"
    return [
        (1, job, 1, S1, "TSQL", call, 4, first_target, 4, 2, "DBA"),
        (1, job, 2, step_2, "TSQL", call, 1, 0, 2, 0, "DBA"),
        (1, job, 3, "work", "TSQL", "x", 4, kept_target, 2, 0, "DBA"),
        (1, job, 4, "more", "TSQL", "y", 1, 0, 2, 0, "DBA"),
    ]


@pytest.fixture
def mixed(table):
    """A guarded job and one job for each reason against a change."""
    names = [
        (1, "fine", 1), (2, "plain", 1), (3, "renamed", 1), (4, "moved", 2),
        (5, "into guard", 1), (6, "no start", 1), (7, "gaps", 1), (8, "empty", 1),
        (9, "not asked", 1),
    ]
    jobs = table("jobs", *[(1, i, n, s) for i, n, s in names])
    steps = (
        guarded(1)
        + [(1, 2, 1, "work", "TSQL", "x", 1, 0, 2, 0, "DBA")]
        + guarded(3, step_2="Renamed")
        + guarded(4)
        + guarded(5, kept_target=2)
        + guarded(6, first_target=2)
        + guarded(7)[:2] + guarded(7)[3:]
        + guarded(9)
    )
    wanted = [(1, n.upper(), "a") for _, n, _ in names if n != "not asked"]
    wanted += [(1, "unknown", "A"), (1, "plain ", "A")]
    requests = table("requests", *wanted)
    return requests, jobs, table("steps", *steps), table("run_config", (1, "A", "Sales", True))


def reasons(df):
    return {r.job_name.strip().lower(): r.reason for r in df.collect()}


def test_reasons_against_reinstalling(mixed):
    checks = ops.install_check(*mixed)
    assert reasons(checks) == {
        "fine": "ok", "plain": "duplicate_request", "renamed": "bad_step_2", "moved": "bad_start",
        "into guard": "dangling_target", "no start": "dangling_target", "gaps": "step_gaps",
        "empty": "no_steps", "unknown": "missing_job",
    }


def test_reasons_against_removing(mixed):
    requests, jobs, steps, _ = mixed
    checks = ops.remove_check(requests.where("job_name <> 'plain '"), jobs, steps)
    assert reasons(checks) == {
        "fine": "ok", "plain": "bad_step_1", "renamed": "bad_step_2", "moved": "bad_start",
        "into guard": "dangling_target", "no start": "dangling_target", "gaps": "step_gaps",
        "empty": "bad_step_1", "unknown": "missing_job",
    }


def test_refused_jobs_stay_as_they_were(mixed):
    requests, jobs, steps, config = mixed
    for flow in (
        ops.install_guard_steps(requests, jobs, steps, config),
        ops.remove_guard_steps(requests, jobs, steps),
    ):
        assert same(flow.steps.where("job_id <> 1"), steps.where("job_id <> 1"))
        assert same(flow.jobs.where("job_id <> 1"), jobs.where("job_id <> 1"))
    assert flow.steps.where("job_id = 1").count() == 2
    left = rows(flow.steps.where("job_id = 1"), "step_id", "step_name")
    assert left == [(1, "work"), (2, "more")]


def test_config_names_with_quotes_are_refused(table, one_step_job):
    _, jobs, steps, _ = one_step_job
    requests = table("requests", (1, "Demo - Simple Job", "it's"))
    config = table("run_config", (1, "it's", "Sales", True))
    assert reasons(ops.install_check(requests, jobs, steps, config)) == {
        "demo - simple job": "quote_in_config"
    }


def test_strict_batches_are_all_or_nothing(mixed, table):
    requests, jobs, steps, config = mixed
    order = [
        ("plain ", "duplicate_request"), ("unknown", "missing_job"), ("EMPTY", "no_steps"),
        ("GAPS", "step_gaps"), ("RENAMED", "bad_step_2"), ("MOVED", "bad_start"),
    ]
    for name, reason in order:
        with pytest.raises(ops.RequestError) as refused:
            ops.install_guard_steps(requests, jobs, steps, config, strict=True)
        assert refused.value.reason == reason
        assert name.strip().lower() in reasons(refused.value.rows)
        requests = requests.where(F.col("job_name") != name)
    good = requests.where("job_name IN ('FINE', 'PLAIN')")
    assert ops.install_guard_steps(good, jobs, steps, config, strict=True).steps.count() > 0
    with pytest.raises(ops.RequestError, match="empty"):
        ops.install_guard_steps(good.where("false"), jobs, steps, config, strict=True)
    with pytest.raises(ops.RequestError, match="bad_step_1"):
        ops.remove_guard_steps(good, jobs, steps, strict=True)


def test_preview_lists_before_and_after_in_order(mixed):
    requests, jobs, steps, config = mixed
    asked = requests.where("job_name IN ('FINE', 'PLAIN', 'EMPTY')")
    listing = ops.install_preview(asked, jobs, steps, config).collect()
    seen = [(r.phase, r.job_name, r.step_id) for r in listing]
    assert seen == [
        ("before", "EMPTY", None), *[("before", "FINE", n) for n in (1, 2, 3, 4)],
        ("before", "PLAIN", 1),
        ("after", "EMPTY", None), *[("after", "FINE", n) for n in (1, 2, 3, 4)],
        *[("after", "PLAIN", n) for n in (1, 2, 3)],
    ]


def test_shift_keeps_no_target(table):
    steps = table("steps", (1, 1, 3, "s", "TSQL", "x", 4, 4, 2, 0, "DBA"))
    moved = ops.shift_flow(steps, -2)
    assert rows(moved, "step_id", "on_success_step_id", "on_fail_step_id") == [(1, 2, 0)]


CLASHING = (
    "_row _range _had_guard _config _configs _first_step _shift _salt _job _new_start _extra_0 _stretch max_step_id "
    "reason n_jobs config_name job_name phase start_step_id _key_hash owner's.note"
).split()


def with_clashes(df):
    """A text of its own in each column whose name an operator might use."""
    names = [c for c in CLASHING if c not in df.columns]
    given = df.select("*", *[F.concat(F.lit(f"{c} "), F.col("job_id")).alias(c) for c in names])
    return given, names


@pytest.mark.parametrize("plans", ["short lists", "no_broadcast"])
def test_columns_of_any_name_travel_along(spark, small, tmp_path, request, plans):
    if plans == "no_broadcast":
        request.getfixturevalue("no_broadcast")
    fleet = DerivedFleet(spark, small)
    tables = {}
    for name in ("requests", "jobs_plain", "steps_plain", "jobs_installed", "steps_installed", "run_config"):
        getattr(fleet, name).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    requests, config = tables["requests"], tables["run_config"]
    asked, _ = with_clashes(requests.withColumn("job_id", F.lit(0)))

    def flows(kind, requests, jobs, steps):
        if kind == "remove":
            return ops.remove_guard_steps(requests, jobs, steps)
        return ops.install_guard_steps(requests, jobs, steps, config)

    for kind, state in (("install", "plain"), ("reinstall", "installed"), ("remove", "installed")):
        jobs, steps = tables[f"jobs_{state}"], tables[f"steps_{state}"]
        plain = flows(kind, requests, jobs, steps)
        wide_jobs, job_names = with_clashes(jobs)
        wide_steps, step_names = with_clashes(steps)
        wide = flows(kind, asked, wide_jobs, wide_steps)
        assert wide.steps.columns == wide_steps.columns and wide.jobs.columns == wide_jobs.columns
        assert same(wide.steps.select(steps.columns), plain.steps)
        assert same(wide.jobs.select(jobs.columns), plain.jobs)
        assert same(wide.checks, plain.checks)
        new_guards = F.col("step_id").isin(1, 2)
        for df, names in ((wide.steps.where(~new_guards), step_names), (wide.jobs, job_names)):
            wrong = F.lit(False)
            for c in names:
                wrong = wrong | ~F.col(f"`{c}`").eqNullSafe(F.concat(F.lit(f"{c} "), F.col("job_id")))
            assert df.count() and df.where(wrong).isEmpty()

    plain = ops.install_preview(requests, tables["jobs_plain"], tables["steps_plain"], config)
    wide_steps, names = with_clashes(tables["steps_plain"])
    wide = ops.install_preview(asked, with_clashes(tables["jobs_plain"])[0], wide_steps, config)
    assert same(wide.select(plain.columns), plain)
    for c in names:
        listed = f"{c}_of_step" if c in ("job_name", "phase", "start_step_id") else c
        told = F.concat(F.lit(f"{c} "), F.col("job_id"))
        assert wide.where(F.col("step_id") > 2).where(~F.col(f"`{listed}`").eqNullSafe(told)).isEmpty()


def test_facts_of_odd_step_ids(spark):
    """Masks against counts of single ids: repeats, gaps, ids below 1, null ids, far ids."""
    rng = random.Random(62)
    jobs = {
        job: [rng.choice([None, *range(-130, 200), 2**31 - 1, -(2**31)]) for _ in range(rng.randrange(1, 12))]
        for job in range(300)
    }
    jobs |= {300: list(range(1, 200)), 301: [*range(1, 200), 63], 302: [None, None], 303: [None], 304: [1, 63, 125]}
    schema = TABLES["steps"]
    rows = [(1, job, i, None, None, None, 1, 0, 2, 0, None) for job, ids in jobs.items() for i in ids]
    facts = {r.job_id: r for r in step_facts(spark.createDataFrame(rows, schema)).collect()}
    for job, ids in jobs.items():
        known = [i for i in ids if i is not None]
        found = facts[job]
        assert found.n_steps == len(ids)
        assert found.repeats == (len(set(ids)) < len(ids))
        assert (found.min_step_id, found.max_step_id) == (min(known, default=None), max(known, default=None))


@pytest.mark.parametrize("broadcast", [True, False])
def test_preview_lists_jobs_without_steps_from_the_same_pass(table, spark, monkeypatch, request, broadcast):
    """Ranges in a gap of the step ids add no row, and no second listing is united."""
    from guardwork.plans import joins

    monkeypatch.setattr(joins, "STEPS_PER_RANGE", 2)
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    step = ("s", "TSQL", "x", 1, 0, 2, 0, "DBA")
    jobs = table("jobs", (1, 1, "Gap", 1), (1, 2, "Empty", 1), (1, 3, "No ids", 1), (1, 4, "Fine", 1))
    steps = table("steps", (1, 1, 7, *step), (1, 1, 1, *step), (1, 3, None, *step), (1, 4, 1, *step))
    requests = table("requests", *[(1, name, "A") for name in ("Gap", "Empty", "No ids", "Fine", "None")])
    listing = ops.install_preview(requests, jobs, steps, table("run_config", (1, "A", "Sales", True)))
    got = sorted((r.job_name, r.phase, r.step_id or 0, r.start_step_id) for r in listing.collect())
    assert got == [
        ("Empty", "after", 0, 1), ("Empty", "before", 0, 1),
        ("Fine", "after", 1, 1), ("Fine", "after", 2, 1), ("Fine", "after", 3, 1), ("Fine", "before", 1, 1),
        ("Gap", "after", 1, 1), ("Gap", "after", 7, 1), ("Gap", "before", 1, 1), ("Gap", "before", 7, 1),
        ("No ids", "after", 0, 1), ("No ids", "before", 0, 1),
    ]
    assert broadcast or "Union" not in listing._jdf.queryExecution().optimizedPlan().toString()
