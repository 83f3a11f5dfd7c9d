"""Join shapes and plan inspection."""

from guardwork.plans.joins import (
    fits_broadcast,
    join_steps,
    lookup,
    only_matching,
)

__all__ = ["fits_broadcast", "join_steps", "lookup", "only_matching"]
