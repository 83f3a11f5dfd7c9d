"""Object lookups on literals."""

from guardwork import fixed
from guardwork import operators as ops


def test_pattern_ignores_case_and_type_counts(table):
    objects = table(
        "objects",
        (1, "FULLTEXT_x", "IT"),
        (1, "fulltext_y", "U"),
        (1, "my fulltext", "IT"),
    )
    assert [r.object_name for r in ops.objects_like(objects).collect()] == ["FULLTEXT_x"]


def test_missing_objects_per_server(spark, table):
    servers = spark.createDataFrame([(1,), (2,)], "server_id bigint")
    have = [(1, name.upper(), "IT") for name in fixed.FULLTEXT_TABLES]
    have += [(2, fixed.FULLTEXT_TABLES[0], "IT"), (2, fixed.FULLTEXT_TABLES[1], "U")]
    missing = ops.objects_missing(ops.expected_on(servers), table("objects", *have, *have))
    assert sorted((r.server_id, r.object_name) for r in missing.collect()) == [
        (2, name) for name in fixed.FULLTEXT_TABLES[1:]
    ]
