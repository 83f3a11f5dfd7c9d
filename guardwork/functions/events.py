"""Column functions on grant event documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters of an object name.
NAME_LENGTH = 128

EVENT_SCHEMA = (
    "EventType string, Grantees struct<Grantee: array<string>>, _corrupt_record string"
)

_PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}


def event_document(event_xml: Column | str) -> Column:
    """The event document as a struct; broken documents fill ``_corrupt_record``."""
    return F.from_xml(event_xml, EVENT_SCHEMA, _PARSE_OPTIONS)


def grantee_name(text: Column | str) -> Column:
    """A grantee cut to the length of an object name; blank text becomes null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(F.trim(col) != "", F.substring(col, 1, NAME_LENGTH))
