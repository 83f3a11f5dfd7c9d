"""Where fleet tables come from."""

from guardwork.sources.derived import DerivedFleet

__all__ = ["DerivedFleet"]
