"""Reading a physical plan: what a DataFrame will do before it does it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """The physical plan; after an action on ``df`` it is the adaptive final plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count_nodes(df: DataFrame, name: str) -> int:
    """How many operators of the plan start with the given name."""
    return len(re.findall(rf"(?m)^[\s:+*()\d-]*{name}\b", plan_text(df)))
