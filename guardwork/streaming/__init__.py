"""Structured streaming jobs."""

from guardwork.streaming.grants import broken_folder, broken_so_far, refuse_grants, refused_so_far

__all__ = ["broken_folder", "broken_so_far", "refuse_grants", "refused_so_far"]
