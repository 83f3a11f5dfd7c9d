"""Request lists on literals."""

from guardwork import operators as ops


def names(df):
    return sorted(r.job_name for r in df.collect())


def test_missing_and_empty_jobs(table):
    jobs = table("jobs", (1, 1, "Load", 1), (1, 2, "Empty", 1), (2, 3, "Elsewhere", 1))
    steps = table("steps", (1, 1, 1, "s", "TSQL", "x", 1, 0, 2, 0, "DBA"))
    requests = table("requests", (1, "LOAD", "A"), (1, "empty ", "b"), (1, "Elsewhere", "C"))
    config = table("run_config", (1, "a", "Sales", True), (2, "c", "Sales", True))
    assert names(ops.requests_missing_jobs(requests, jobs)) == ["Elsewhere"]
    assert names(ops.requests_jobs_without_steps(requests, jobs, steps)) == ["empty "]
    assert names(ops.requests_missing_configs(requests, config)) == ["Elsewhere", "empty "]
    worklist = ops.install_worklist(requests, jobs, steps).collect()
    assert [(r.job_id, r.job_name, r.config_name, r.requires_drop) for r in worklist] == [
        (1, "LOAD", "A", False)
    ]


def test_empty_and_repeated_requests(table):
    requests = table("requests", (1, "Load", "A"), (1, "LOAD ", "B"), (2, "Load", "A"))
    assert [tuple(r) for r in ops.requests_duplicate_jobs(requests).collect()] == [(1, "load", 2)]
    assert [r.is_empty for r in ops.requests_empty(requests).collect()] == [False]
    assert [r.is_empty for r in ops.requests_empty(requests.where("false")).collect()] == [True]
