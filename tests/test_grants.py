"""Grant events: documents, users, streams."""

import pytest

from guardwork import fixed, registry
from guardwork import operators as ops
from guardwork.sources.derived import DerivedFleet
from guardwork.streaming import refuse_grants, refused_so_far


def grant(*names, kind=fixed.GRANT_EVENT):
    elements = "".join(f"<Grantee>{n}</Grantee>" for n in names)
    return (
        f"<EVENT_INSTANCE><EventType>{kind}</EventType><LoginName>x</LoginName>"
        f"<Grantees>{elements}</Grantees></EVENT_INSTANCE>"
    )


@pytest.fixture
def principals(table):
    return table(
        "principals",
        (1, "ann", "S"),
        (1, "DOM\\bob", "U"),
        (1, "readers", "R"),
        (2, "readers", "S"),
    )


def events(table, *documents, server=1):
    return table("grant_events", *[(i, None, server, d) for i, d in enumerate(documents)])


def test_users_in_all_forms(table, principals):
    documents = [
        grant("ann"),
        grant("ANN ", "DOM\\BOB"),
        grant("readers", "dom\\bob"),
        grant("readers"),
        grant("stranger"),
        grant(),
        grant("", "  "),
        grant("ann", kind="REVOKE_DATABASE"),
        grant(" ann"),
        "<EVENT_INSTANCE><broken",
        None,
        grant("an<!-- c -->n"),
        grant("a&#110;n"),
    ]
    found = ops.refused_grants(events(table, *documents), principals).collect()
    assert sorted(r.event_id for r in found) == [0, 1, 2, 11, 12]
    assert {r.message for r in found} == {fixed.GRANT_REFUSED}


def test_principals_count_only_on_their_server(table, principals):
    other = ops.direct_grants(events(table, grant("readers"), grant("ann"), server=2), principals)
    assert [r.event_id for r in other.collect()] == [0]


def test_grantees_are_cut_and_blank_ones_dropped(table):
    revoke = grant("c", kind="REVOKE_DATABASE")
    found = ops.grantees(events(table, grant("x" * 200, "", "b"), revoke)).collect()
    assert sorted(r.grantee for r in found) == ["b", "x" * 128]


def test_broken_documents_are_kept_aside(table):
    documents = events(table, grant("ann"), "<EVENT_INSTANCE><broken", None, grant())
    assert sorted(r.event_id for r in ops.broken_events(documents).collect()) == [1, 2]
    assert sorted(r.event_id for r in ops.grantees(documents).collect()) == [0]


def stream(spark, folder, fleet, tmp_path, broken=None):
    source = spark.read.parquet(f"{folder}/in")
    events_in = (
        spark.readStream.schema(source.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{folder}/in")
    )
    refuse_grants(
        events_in,
        lambda session: DerivedFleet(session, fleet.folder).principals,
        output=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "checkpoint"),
        broken_output=broken,
    ).awaitTermination()
    return sorted(r.event_id for r in refused_so_far(spark, str(tmp_path / "out")).collect())


def test_stream_equals_batch_and_restarts_without_doubles(spark, fleet, table, tmp_path):
    folder = tmp_path / "events"
    fleet.grant_events.repartition(5).write.parquet(str(folder / "in"))
    batch = sorted(
        r.event_id for r in ops.direct_grants(fleet.grant_events, fleet.principals).collect()
    )
    assert len(batch) == 856
    assert stream(spark, folder, fleet, tmp_path) == batch
    assert len(list((tmp_path / "out").glob("query=*/batch_id=*"))) == 3
    assert stream(spark, folder, fleet, tmp_path) == batch

    user = fleet.principals.where("principal_type = 'S' AND server_id = 1").first()
    late = [(10**9, None, 1, grant(user.principal_name)), (10**9 + 1, None, 1, "<broken")]
    table("grant_events", *late).write.mode("append").parquet(str(folder / "in"))
    broken = str(tmp_path / "broken")
    assert stream(spark, folder, fleet, tmp_path, broken) == [*batch, 10**9]
    assert [r.event_id for r in spark.read.parquet(broken).collect()] == [10**9 + 1]


def test_a_repeated_batch_replaces_its_folder(spark, fleet, tmp_path):
    """A batch that ran but was not committed runs again after a restart."""
    folder = tmp_path / "events"
    fleet.grant_events.repartition(5).write.parquet(str(folder / "in"))
    first = stream(spark, folder, fleet, tmp_path)
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert stream(spark, folder, fleet, tmp_path) == first


def test_the_registered_stream_has_files_as_its_table(spark, fleet):
    """Writing the events spreads over their own partitions, however many they are."""
    events = fleet.given("events").repartition(7)
    run = registry._run_stream(fleet, events, fleet.as_grant_events)
    assert len(spark.read.parquet(f"{run}/input").inputFiles()) == 7
    batch = sorted(r.event_id for r in ops.direct_grants(fleet.grant_events, fleet.principals).collect())
    assert sorted(r.event_id for r in refused_so_far(spark, f"{run}/output").collect()) == batch
