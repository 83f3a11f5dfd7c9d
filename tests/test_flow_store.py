"""The store of both flow tables: what readers see, whatever becomes of a writer."""

import os

import pytest
from pyspark.sql import functions as F

from guardwork import operators as ops
from guardwork.operators import flow as flow_module
from guardwork.sources.derived import DerivedFleet
from guardwork.sources.flow_store import ChangedMeanwhile, FlowStore
from test_flow import same


@pytest.fixture(scope="module")
def tables(spark, small):
    fleet = DerivedFleet(spark, small)
    names = ("requests", "jobs_installed", "steps_installed", "run_config")
    return [getattr(fleet, name).cache() for name in names]


@pytest.fixture
def store(spark, tables, tmp_path):
    found = FlowStore(spark, f"file://{tmp_path}/flow")
    found.create(tables[1], tables[2])
    return found


def assert_holds(store, jobs, steps):
    found = store.read()
    assert same(found[0], jobs) and same(found[1], steps)


def test_changes_equal_those_of_the_operators(store, tables):
    requests, jobs, steps, config = tables
    expected = ops.install_guard_steps(requests, jobs, steps, config)
    published = store.install(requests, config)
    assert_holds(store, expected.jobs, expected.steps)
    assert same(published.checks, expected.checks)
    once = requests.dropDuplicates(["server_id", "job_name"])
    counts = {r.reason: r.n for r in expected.checks.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert sum(published.outcomes.values()) == once.count()
    assert published.outcomes["ok"] == counts["ok"] and set(published.outcomes) == set(counts)

    again = ops.remove_guard_steps(requests, expected.jobs, expected.steps)
    store.remove(requests)
    assert_holds(store, again.jobs, again.steps)


def test_refused_batch_publishes_nothing(store, tables, spark):
    requests, jobs, steps, config = tables
    before = store.current()
    with pytest.raises(ops.RequestError) as refused:
        store.install(requests, config, strict=True)
    lazy = ops.install_check(requests, jobs, steps, config)
    first = next(r for r in flow_module.REASONS if not lazy.where(F.col("reason") == r).isEmpty())
    assert refused.value.reason == first
    assert same(refused.value.rows, lazy.where(F.col("reason") == first))
    assert store.current() == before
    assert_holds(store, jobs, steps)
    drafts = [d for d in os.listdir(store.folder.removeprefix("file://")) if d.startswith("version-")]
    # The draft of the refused batch has its checks, and neither table.
    assert sorted(os.listdir(f"{store.folder.removeprefix('file://')}/{d}") for d in drafts) == [["jobs", "steps"], ["plan"]]

    with pytest.raises(ops.RequestError) as empty:
        store.install(requests.limit(0), config, strict=True)
    assert empty.value.reason == "empty"


def test_accepted_strict_batch_is_published(store, tables):
    requests, jobs, steps, config = tables
    good = requests.join(
        ops.install_check(requests, jobs, steps, config).where("reason = 'ok'").select("server_id", "job_name"),
        ["server_id", "job_name"],
    ).cache()
    published = store.install(good, config, strict=True)
    assert set(published.outcomes) == {"ok"} and store.current() == published.version


def test_checks_are_worked_out_once(store, tables, monkeypatch):
    """Steps, starts and checks come from the stored plan; step facts are planned one time."""
    requests, _, _, config = tables
    made = []
    facts = flow_module.step_facts
    monkeypatch.setattr(flow_module, "step_facts", lambda *a: made.append(1) or facts(*a))
    store.install(requests, config)
    assert len(made) == 1


@pytest.mark.parametrize("at", ["steps", "jobs", "checks", "pointer"])
def test_killed_writer_leaves_the_old_version(store, tables, monkeypatch, at, spark):
    requests, jobs, steps, config = tables

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed

    if at == "pointer":
        monkeypatch.setattr(FlowStore, "_publish", killed)
    else:
        from pyspark.sql.readwriter import DataFrameWriter

        write = DataFrameWriter.parquet
        monkeypatch.setattr(
            DataFrameWriter, "parquet", lambda w, path, *a, **k: killed() if path.endswith(f"/{at}") else write(w, path, *a, **k)
        )
    with pytest.raises(Killed):
        store.install(requests, config)
    monkeypatch.undo()
    assert_holds(store, jobs, steps)
    # The next change is not held up by the draft.
    expected = ops.install_guard_steps(requests, jobs, steps, config)
    store.install(requests, config)
    assert_holds(store, expected.jobs, expected.steps)


def test_reader_keeps_its_version_while_another_is_published(store, tables):
    requests, jobs, steps, config = tables
    old_jobs, old_steps = store.read()
    store.install(requests, config)
    assert same(old_jobs, jobs) and same(old_steps, steps)


def test_change_meanwhile_is_noticed(store, tables, monkeypatch):
    requests, _, _, config = tables
    other = FlowStore(store.spark, store.folder)
    write = FlowStore._write

    def meanwhile(self, *args):
        monkeypatch.undo()
        other.remove(requests)
        write(self, *args)

    monkeypatch.setattr(FlowStore, "_write", meanwhile)
    with pytest.raises(ChangedMeanwhile):
        store.install(requests, config)
    removed = ops.remove_guard_steps(requests, *tables[1:3])
    assert_holds(store, removed.jobs, removed.steps)


def test_store_without_a_version(spark, tables, tmp_path, store):
    empty = FlowStore(spark, f"file://{tmp_path}/empty")
    assert empty.current() is None
    with pytest.raises(ValueError):
        empty.read()
    with pytest.raises(ValueError):
        store.create(*tables[1:3])
