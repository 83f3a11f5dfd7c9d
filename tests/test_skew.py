"""Hot keys: a third or more of the rows on one key, checked against brute force."""

import pytest
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork import operators as ops
from guardwork.plans import joins
from guardwork.sources import derived
from guardwork.sources.derived import LINE_ORDER, number_lines


def task_shares(df, keys):
    """Rows per shuffle partition when hashed on the given keys."""
    parts = df.repartition(64, *keys).groupBy(F.spark_partition_id()).count().collect()
    return sorted((r["count"] for r in parts), reverse=True)


def test_lookup_divides_a_hot_name(spark, no_broadcast):
    rows = spark.range(30_000).select(
        F.lit(1).alias("server_id"),
        "id",
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("_name"),
    )
    rows = rows.unionByName(rows.withColumn("_name", F.lit(None).cast("string")))
    named = rows.where("_name IS NOT NULL AND (id % 6 = 2 OR id = 0)")
    table = named.select("server_id", "_name").distinct().withColumn("found", F.lit(True))
    for how in ("left", "inner", "left_semi", "left_anti"):
        salted = joins.lookup(rows, table, ["server_id", "_name"], ["id"], how)
        plain = rows.join(F.broadcast(table), ["server_id", "_name"], how)
        assert salted.exceptAll(plain.select(salted.columns)).isEmpty()
        assert salted.count() == plain.count()
    salt = F.pmod(F.xxhash64("id"), F.lit(joins.SALTS))
    spread = task_shares(rows.withColumn("salt", salt), ["server_id", "_name", "salt"])
    assert spread[0] < rows.count() / 6 < task_shares(rows, ["server_id", "_name"])[0]


@pytest.fixture
def hot_job(table, spark, monkeypatch):
    """One guarded job with 3,000 steps next to 500 small ones; ranges of 100 steps."""
    monkeypatch.setattr(joins, "STEPS_PER_RANGE", 100)
    sizes = [(1, 0, 3_000), *[(1, n, 1 + n % 3) for n in range(1, 500)]]
    lengths = spark.createDataFrame(sizes, "server_id bigint, job_id bigint, n int")
    jobs = lengths.selectExpr(
        "server_id", "job_id", "concat('Job ', job_id) AS job_name", "1 AS start_step_id"
    )
    steps = lengths.withColumn("step_id", F.explode(F.sequence(F.lit(1), "n"))).selectExpr(
        "server_id", "job_id", "step_id", "concat('s', step_id) AS step_name",
        "'TSQL' AS subsystem", "'x' AS command", "IF(step_id < n, 4, 1) AS on_success_action",
        "IF(step_id < n, step_id + 1, 0) AS on_success_step_id", "2 AS on_fail_action",
        "0 AS on_fail_step_id", "'DBA' AS database_name",
    )
    requests = jobs.where("job_id % 2 = 0").selectExpr(
        "server_id", "job_name", "'A' AS config_name"
    )
    return requests, jobs, steps, table("run_config", (1, "A", "Sales", True))


def test_long_job_in_step_ranges(spark, hot_job, no_broadcast):
    requests, jobs, steps, config = hot_job
    flow = ops.install_guard_steps(requests, jobs, steps, config)
    got = {(r.job_id, r.step_id): r for r in flow.steps.collect()}
    expected = {}
    for r in steps.collect():
        k = 2 if r.job_id % 2 == 0 else 0
        target = r.on_success_step_id
        expected[r.job_id, r.step_id + k] = (r.step_name, target + k if target else 0)
    for job in {r.job_id for r in jobs.collect() if r.job_id % 2 == 0}:
        expected[job, 1] = (fixed.GUARD_STEP_1_NAME, 3)
        expected[job, 2] = (fixed.GUARD_STEP_2_NAME, 0)
    assert {k: (r.step_name, r.on_success_step_id) for k, r in got.items()} == expected
    assert flow.steps.count() == len(expected)

    back = ops.remove_guard_steps(requests, flow.jobs, flow.steps)
    assert back.steps.exceptAll(steps.select(back.steps.columns)).isEmpty()
    assert back.steps.count() == steps.count()

    keys = ["server_id", "job_id"]
    ranged = steps.withColumn("r", F.expr("(step_id - 1) div 100"))
    assert task_shares(ranged, [*keys, "r"])[0] < steps.count() / 4 < task_shares(steps, keys)[0]


def test_long_job_is_previewed_whole(hot_job, no_broadcast):
    requests, jobs, steps, config = hot_job
    counts = {
        (r.phase, r.job_id): r["count"]
        for r in ops.install_preview(requests, jobs, steps, config)
        .groupBy("phase", "job_id").count().collect()
    }
    assert counts["before", 0] == 3_000
    assert counts["after", 0] == 3_002
    assert len(counts) == 2 * requests.count()


def test_hot_order_is_numbered_like_a_plain_window(spark, small):
    """A third of all lines on one order, numbered as one sorted list would be."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey", *LINE_ORDER)
    hot = F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(F.col("l_orderkey"))
    lines = lines.withColumn("l_orderkey", hot.cast("bigint"))
    orders = lines.select("l_orderkey").distinct().withColumn("server_id", F.lit(1))
    numbered = number_lines(lines, orders).select("l_orderkey", *LINE_ORDER, "rn", "n").collect()

    by_order: dict = {}
    for r in lines.collect():
        by_order.setdefault(r.l_orderkey, []).append(tuple(r)[1:])
    expected = [
        (order, *line, i + 1, len(group))
        for order, group in by_order.items()
        for i, line in enumerate(sorted(group))
    ]
    assert max(len(g) for g in by_order.values()) > lines.count() / 4
    assert sorted(tuple(r) for r in numbered) == sorted(expected)


def test_only_long_orders_are_divided(spark, monkeypatch):
    """Short orders are numbered in one window, long ones by slices, both like a sorted list."""
    monkeypatch.setattr(derived, "LINES_AT_ONCE", 50)
    lines = spark.range(2_000).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 1 WHEN id % 97 <> 0 THEN id % 101 END AS l_orderkey",
        "CASE WHEN id % 7 <> 3 THEN CAST(id % 5 AS int) END AS l_linenumber",
        "CASE WHEN id % 11 <> 5 THEN (id * 37) % 19 - 2 END AS l_partkey",
        *[f"(id * {i}) % 3 AS {c}" for i, c in enumerate(LINE_ORDER[2:])],
    )
    orders = spark.range(100).selectExpr("id AS l_orderkey", "1 AS server_id")
    orders = orders.unionByName(orders.where("l_orderkey = 5"))
    numbered = number_lines(lines, orders).select("l_orderkey", *LINE_ORDER, "rn", "n").collect()

    def nulls_first(line):
        return [(value is not None, value or 0) for value in line]

    by_order: dict = {}
    for r in lines.collect():
        by_order.setdefault(r.l_orderkey, []).append(tuple(r)[1:])
    expected = [
        (order, *line, i + 1, len(group))
        for order, group in by_order.items()
        if order is not None and order < 100
        for i, line in enumerate(sorted(group, key=nulls_first))
        if line[0] is not None and line[1] is not None and line[1] > -1
        for _ in range(2 if order == 5 else 1)
    ]
    assert len(by_order[1]) > 50 > len(by_order[2])
    assert sorted(tuple(r) for r in numbered) == sorted(expected)


def test_skewed_users_give_every_event_once(table, spark, no_broadcast):
    """Every event names the same user twice; each is refused once."""
    document = (
        f"<EVENT_INSTANCE><EventType>{fixed.GRANT_EVENT}</EventType><Grantees>"
        "<Grantee>app</Grantee><Grantee>APP</Grantee></Grantees></EVENT_INSTANCE>"
    )
    events = spark.range(5_000).selectExpr(
        "id AS event_id", "CAST(NULL AS timestamp_ntz) AS ts", "1 AS server_id"
    ).withColumn("event_xml", F.lit(document))
    found = ops.direct_grants(events, table("principals", (1, "app", "S"), (1, "App", "R")))
    assert found.count() == 5_000


def test_repeated_and_missing_names_are_divided(spark, no_broadcast, monkeypatch):
    """Rows of a heavy name and rows without a name spread; the table is repeated for it alone."""
    monkeypatch.setattr(joins, "HEAVY_ROWS", 1_000)
    rows = spark.range(9_000).select(
        F.lit(1).alias("server_id"),
        "id",
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN CAST(id AS STRING) END").alias("_name"),
    )
    table = spark.createDataFrame([(1, "hot"), (1, "1"), (1, "gone")], "server_id int, _name string")
    on = ["server_id", "_name"]
    for how in ("left", "inner", "left_semi", "left_anti"):
        divided = joins.lookup_repeated(rows, table, on, ["id"], how)
        plain = rows.join(F.broadcast(table), on, how)
        assert divided.count() == plain.count()
        assert divided.exceptAll(plain.select(divided.columns)).isEmpty()
    # With nothing heavy every key keeps one row.
    calm = rows.where("_name <> 'hot'")
    assert joins.lookup_repeated(calm, table, on, ["id"]).count() == 1


def test_outcomes_are_repeated_for_hot_requests_alone(spark, no_broadcast, monkeypatch):
    """Checks: a job that is asked for very often is divided; the outcomes of others have one row."""
    monkeypatch.setattr(joins, "HEAVY_ROWS", 100)
    jobs = spark.range(1, 6).selectExpr(
        "1 AS server_id", "id AS job_id", "concat('Job ', id) AS job_name", "1 AS start_step_id"
    )
    steps = spark.createDataFrame([], "server_id int, job_id long, step_id int, step_name string, subsystem string, "
        "command string, on_success_action int, on_success_step_id int, on_fail_action int, on_fail_step_id int, "
        "database_name string")
    requests = spark.range(1_000).selectExpr(
        "1 AS server_id", "CASE id % 3 WHEN 0 THEN 'JOB 1 ' WHEN 1 THEN concat('Job ', id) END AS job_name"
    )
    checks = ops.remove_check(requests, jobs, steps)
    sixteen = ",".join(map(str, range(16)))
    assert sixteen not in checks._jdf.queryExecution().optimizedPlan().toString().replace(" ", "")
    found = {(r.job_name, r.reason): r["count"] for r in checks.groupBy("job_name", "reason").count().collect()}
    assert found["JOB 1 ", "duplicate_request"] == 334
    assert found["Job 4", "bad_step_1"] == 1
    assert sum(found.values()) == 1_000
