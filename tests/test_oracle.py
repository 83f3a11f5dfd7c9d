"""Every query against its SQL, on the given tables."""

import pytest

import __spark_entry__ as entry_point
from guardwork.registry import FLEET_QUERIES
from compare import connect, expected_rows, spark_rows

QUERIES = {n: q for n, q in entry_point.queries().items() if n in FLEET_QUERIES}
EXPECTED = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_expected_results():
    assert set(QUERIES) <= set(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, small, name):
    columns, rows = spark_rows(QUERIES[name](spark, small))
    assert (columns, rows) == expected_rows(duck, EXPECTED[name])
    assert rows


SHUFFLED = [
    "guard_audit",
    "run_decision",
    "run_outcome_where_guarded",
    "requests_missing_configs",
    "requests_jobs_without_steps",
    "install_preview",
    "reinstall_guard_steps",
    "reinstall_job_starts",
    "remove_guard_steps",
    "direct_grants",
    "objects_missing",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_equals_sql_without_broadcasts(spark, duck, small, no_broadcast, name):
    assert spark_rows(QUERIES[name](spark, small)) == expected_rows(duck, EXPECTED[name])


def test_entry_runs(spark):
    df = entry_point.entry(spark)
    assert df.count() == 1500
    assert "status" in df.columns
