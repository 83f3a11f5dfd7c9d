"""Column functions on names and guard commands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from guardwork import fixed


def ci(name: Column | str) -> Column:
    """The form in which two names are compared.

    Name equality ignores case and trailing blanks but keeps accents.  Operators
    compare and join on this form and always output the original spelling.
    """
    col = F.col(name) if isinstance(name, str) else name
    return F.lower(F.rtrim(col))


def same_name(name: Column | str, text: str) -> Column:
    """True if a name column equals a constant name."""
    return ci(name) == text.rstrip(" ").lower()


def config_name(command: Column | str, marker: str = fixed.CONFIG_MARKER) -> Column:
    """Text between the marker and the next quote; null if there is none.

    One regex pass per command: the first match is taken from the list of matches,
    which tells "no match" (null) from "empty name" ('').
    """
    pattern = rf"(?i)\Q{marker}\E([^']*)'"
    return F.get(F.regexp_extract_all(command, F.lit(pattern), 1), F.lit(0))
