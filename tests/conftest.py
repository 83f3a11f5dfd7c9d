"""Shared session, folders and small table builders."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from guardwork.schemas import TABLES  # noqa: E402
from guardwork.session import local_session  # noqa: E402
from guardwork.sources.derived import DerivedFleet  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def medium() -> str:
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def fleet(spark, medium) -> DerivedFleet:
    return DerivedFleet(spark, medium)


@pytest.fixture
def table(spark):
    """Build a fleet table from rows in declared column order."""

    def build(name: str, *rows: tuple):
        return spark.createDataFrame(list(rows), TABLES[name])

    return build


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were large."""
    keys = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)
