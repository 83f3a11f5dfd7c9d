"""What the plans do: scans, joins, broadcasts, Python."""

import pytest
from pyspark.sql import functions as F

from guardwork import operators as ops
from guardwork.plans.inspect import count_nodes, plan_text
from guardwork.plans.rows import most_rows
from guardwork.registry import FLEET_QUERIES
from guardwork.sources.derived import TABLE_NAMES, DerivedFleet


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The derived tables as files, so that plans start at scans."""
    folder = tmp_path_factory.mktemp("stored")
    fleet = DerivedFleet(spark, small)
    for name in TABLE_NAMES:
        getattr(fleet, name).write.parquet(str(folder / name))

    class Stored:
        pass

    tables = Stored()
    for name in TABLE_NAMES:
        setattr(tables, name, spark.read.parquet(str(folder / name)))
    return tables


def states(t):
    return t.run_config, t.databases, t.replica_states, t.db_replica_states


@pytest.mark.parametrize("name", [n for n in FLEET_QUERIES if n != "direct_grants_stream"])
def test_no_python_and_no_products(spark, small, name):
    text = plan_text(FLEET_QUERIES[name](DerivedFleet(spark, small)))
    for node in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_audit_reads_each_column_where_it_is_needed(stored):
    audit = ops.guard_audit(stored.jobs_installed, stored.steps_installed, stored.run_config)
    lines = plan_text(audit).splitlines()
    scans = {line.split("FileScan")[1] for line in lines if "steps_installed]" in line}
    wide = [scan for scan in scans if "subsystem" in scan]
    heads = [scan for scan in scans if "In(step_id, [1,2])" in scan]
    numbers = [scan for scan in scans if "EqualTo(step_id,1)" in scan]
    assert len(wide) == len(heads) == 1
    assert "ReadSchema: struct<step_id:int,step_name:string,on_success_step_id:int>" in numbers[0]
    assert "Subquery" in plan_text(audit)


def test_audit_shuffles_on_job_and_step(stored, no_broadcast):
    text = plan_text(
        ops.guard_audit(stored.jobs_installed, stored.steps_installed, stored.run_config)
    )
    assert "hashpartitioning(server_id" in text
    assert any(
        "real_start_step_id" in line and "hashpartitioning" in line for line in text.splitlines()
    )


def test_requests_meet_one_small_table(stored):
    decision = ops.run_decision(stored.requests, *states(stored))
    text = plan_text(decision)
    assert text.count("requests]") == 1
    top = text.split("requests]")[0]
    assert "Exchange hashpartitioning" not in top.split("BroadcastExchange")[0]


@pytest.mark.parametrize(
    ("build", "kind"),
    [
        (lambda t: ops.requests_missing_jobs(t.requests, t.jobs_plain), "LeftAnti"),
        (
            lambda t: ops.requests_jobs_without_steps(t.requests, t.jobs_plain, t.steps_plain),
            "LeftAnti",
        ),
        (lambda t: ops.requests_missing_configs(t.requests, t.run_config), "LeftAnti"),
        (lambda t: ops.objects_missing(t.expected_objects, t.objects), "LeftAnti"),
        (lambda t: ops.direct_grants(t.grant_events, t.principals), "LeftSemi"),
    ],
)
def test_semi_and_anti_joins(stored, build, kind):
    assert kind in plan_text(build(stored))


def test_each_document_is_parsed_once(stored):
    grants = plan_text(ops.direct_grants(stored.grant_events, stored.principals))
    assert grants.count("from_xml(") == 1


def test_short_request_lists_leave_steps_in_place(stored):
    """With few requests no shuffle holds whole step rows."""
    few = stored.requests.where("server_id = 1 AND job_name < 'JOB 2'")
    flow = ops.install_guard_steps(few, stored.jobs_plain, stored.steps_plain, stored.run_config)
    text = plan_text(flow.steps)
    assert text.count("steps_plain]") == 2
    before_scan = text.split("steps_plain]")[0]
    assert "BroadcastHashJoin" in before_scan and "Exchange hashpartitioning" not in before_scan


def test_long_request_lists_split_jobs_by_step_ranges(stored, no_broadcast):
    flow = ops.install_guard_steps(
        stored.requests, stored.jobs_plain, stored.steps_plain, stored.run_config
    )
    text = plan_text(flow.steps)
    assert "BroadcastExchange" not in text
    assert "_range#" in text
    assert text.count("steps_plain]") == 2
    assert count_nodes(flow.steps, "Union") == 0


def test_broadcast_follows_the_size(spark, stored):
    key = "spark.sql.autoBroadcastJoinThreshold"
    from guardwork.plans.joins import estimated_bytes, fits_broadcast, row_bytes

    size = estimated_bytes(stored.run_config)
    rows = stored.run_config.count() * row_bytes(stored.run_config)
    try:
        spark.conf.set(key, str(max(size, rows)))
        assert fits_broadcast(stored.run_config)
        spark.conf.set(key, str(size - 1))
        assert not fits_broadcast(stored.run_config)
        spark.conf.set(key, str(rows - 1))
        assert not fits_broadcast(stored.run_config)
        spark.conf.set(key, "-1")
        assert not fits_broadcast(stored.run_config)
    finally:
        spark.conf.unset(key)


def test_many_rows_of_few_bytes_are_not_broadcast(spark, tmp_path):
    """A table that repeats itself is small on disk only."""
    from guardwork.plans.joins import estimated_bytes, fits_broadcast

    many = spark.range(1_000_000).selectExpr(
        "id % 5 AS server_id", "'Job 1' AS job_name", "'ASIA' AS config_name"
    )
    many.write.parquet(str(tmp_path / "many"))
    stored = spark.read.parquet(str(tmp_path / "many"))
    assert estimated_bytes(stored) < 10 << 20
    assert not fits_broadcast(stored)


def test_a_far_start_does_not_bring_all_steps_into_the_audit(spark, stored, no_broadcast):
    """One job that starts on step 1,000,000 adds that number to the starts, not all below it."""
    from guardwork.operators.audit import _may_be_start
    from guardwork.operators.guard import DEFAULT_GUARD

    far = stored.jobs_installed.withColumn(
        "start_step_id", F.expr("IF(job_id = 1, 1000000, start_step_id)")
    )
    steps = stored.steps_installed
    usual = steps.where(_may_be_start(stored.jobs_installed, steps, DEFAULT_GUARD)).count()
    assert steps.where(_may_be_start(far, steps, DEFAULT_GUARD)).count() == usual < steps.count()


PLANS = {
    "install": lambda t: ops.install_guard_steps(t.requests, t.jobs_plain, t.steps_plain, t.run_config).steps,
    "reinstall": lambda t: ops.install_guard_steps(
        t.requests, t.jobs_installed, t.steps_installed, t.run_config
    ).steps,
    "remove": lambda t: ops.remove_guard_steps(t.requests, t.jobs_installed, t.steps_installed).steps,
    "remove check": lambda t: ops.remove_check(t.requests, t.jobs_installed, t.steps_installed),
    "preview": lambda t: ops.install_preview(t.requests, t.jobs_plain, t.steps_plain, t.run_config),
    "decision": lambda t: ops.run_decision(t.requests, *states(t)),
    "missing jobs": lambda t: ops.requests_missing_jobs(t.requests, t.jobs_plain),
}


@pytest.mark.parametrize("name", PLANS)
def test_no_job_runs_while_a_plan_is_built(spark, stored, name):
    context = spark.sparkContext
    context.setJobGroup(f"building {name}", "")
    try:
        PLANS[name](stored)
        assert list(context.statusTracker().getJobIdsForGroup(f"building {name}")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["install", "reinstall", "remove", "remove check"])
def test_no_aggregate_has_a_key_for_each_step(stored, no_broadcast, name):
    text = plan_text(PLANS[name](stored))
    keys = [line.split("keys=[")[1].split("]")[0] for line in text.splitlines() if "Aggregate(keys=[" in line]
    assert keys and not any("step_id" in key for key in keys)
    assert any("_stretch" in key or "_groupingexpression" in key for key in keys)


def test_rows_are_bounded_by_metadata(spark, stored):
    rows = stored.requests.count()
    assert most_rows(stored.requests) == rows
    assert most_rows(stored.requests.where("server_id = 1").select("job_name").distinct()) == rows
    assert most_rows(stored.requests.unionByName(stored.requests)) == 2 * rows
    assert most_rows(stored.requests.join(stored.run_config, "server_id", "left_semi")) == rows
    assert most_rows(stored.requests.join(stored.run_config, "server_id")) is None
    assert most_rows(stored.requests.selectExpr("explode(array(1, 2))")) is None
    assert most_rows(spark.range(7).toDF("x")) == 7


def test_no_join_broadcasts_many_rows_for_their_small_files(spark, tmp_path):
    """Nor does it if the files are too many to look into."""
    from guardwork.plans import joins
    from guardwork.plans.rows import MOST_FILES
    from guardwork.sources.derived import LINE_ORDER, number_lines

    many = spark.range(1_000_000, numPartitions=1).selectExpr(
        "id % 5 AS server_id", "id div 100000 AS job_id", "1 AS step_id", "7 AS max_step_id"
    )
    many.write.parquet(str(tmp_path / "many"))
    stored = spark.read.parquet(str(tmp_path / "many"))
    many.limit(200).repartition(MOST_FILES + 1).write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    key = ["server_id", "job_id"]
    assert joins.estimated_bytes(stored) < 10 << 20
    rows = spark.range(10).selectExpr("id AS server_id", "id AS job_id", "1 AS step_id")
    lines = rows.selectExpr("job_id AS l_orderkey", *[f"1 AS {c}" for c in LINE_ORDER])
    orders = stored.selectExpr("server_id", "job_id AS l_orderkey")
    for joined in (
        joins.lookup(rows, stored, key, ["step_id"], bound=stored),
        joins.lookup(rows, stored.select(*key), key, ["step_id"], "left_semi"),
        joins.lookup(rows, files.select(*key), key, ["step_id"]),
        joins.join_bounded(rows, stored, key, stored),
        joins.join_steps(rows, stored.drop("step_id"), stored),
    ):
        text = plan_text(joined)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "SortMergeJoin" in plan_text(number_lines(lines, orders))
