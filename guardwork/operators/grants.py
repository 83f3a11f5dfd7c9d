"""Permissions granted straight to users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.events import event_document, grantee_name
from guardwork.functions.text import ci, same_name
from guardwork.plans.joins import lookup
from guardwork.schemas import require


def documents(events: DataFrame) -> DataFrame:
    """Events with the fields of their document.

    The document is unpacked by a generator, not by field access: filters on its
    fields then stay above the generator, and each document is parsed exactly once.
    """
    return require(events, "grant_events").select(
        "event_id", "server_id", "event_xml", F.inline(F.array(event_document("event_xml")))
    )


def grantees(events: DataFrame) -> DataFrame:
    """One row per grantee of each grant event; other events are passed over.

    Names longer than an object name may be are cut to ``NAME_LENGTH`` characters, as the
    server itself would read them.
    """
    return grantees_of(documents(events))


def grantees_of(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where(F.col("_corrupt_record").isNull())
        .where(same_name("EventType", fixed.GRANT_EVENT))
        .select("event_id", "server_id", F.explode("Grantees.Grantee").alias("grantee"))
        .select("event_id", "server_id", grantee_name("grantee").alias("grantee"))
        .where(F.col("grantee").isNotNull())
    )


def broken_events(events: DataFrame) -> DataFrame:
    """Events whose document cannot be read; ``grantees`` has no rows for them."""
    return broken_of(documents(events))


def broken_of(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where(F.col("event_xml").isNull() | F.col("_corrupt_record").isNotNull())
        .select("event_id", "server_id", "event_xml")
    )


def direct_grants(events: DataFrame, principals: DataFrame) -> DataFrame:
    """Grant events that name a user; one row per event, as all of it is refused.

    Repeated names within an event are harmless: a semi join keeps rows, and the
    distinct on narrow rows is combined before its shuffle.
    """
    return direct_grants_of(documents(events), principals)


def direct_grants_of(parsed: DataFrame, principals: DataFrame) -> DataFrame:
    users = (
        require(principals, "principals")
        .where(ci("principal_type").isin(*(kind.lower() for kind in fixed.USER_TYPES)))
        .select("server_id", ci("principal_name").alias("_name"))
    )
    named = grantees_of(parsed).select("event_id", "server_id", ci("grantee").alias("_name"))
    return (
        lookup(named, users, ["server_id", "_name"], spread=["event_id"], how="left_semi")
        .select("event_id", "server_id")
        .distinct()
    )


def refused_grants(events: DataFrame, principals: DataFrame) -> DataFrame:
    """``direct_grants`` with the message for whoever issued the grant."""
    return refused_of(documents(events), principals)


def refused_of(parsed: DataFrame, principals: DataFrame) -> DataFrame:
    return direct_grants_of(parsed, principals).withColumn(
        "message", F.lit(fixed.GRANT_REFUSED)
    )
