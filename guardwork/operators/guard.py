"""The guard: two steps in front of a job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.functions.text import same_name


@dataclass(frozen=True)
class Guard:
    """Names and texts of the guard steps.

    ``database`` is the database that holds the guard procedure; new guard steps
    run there.
    """

    database: str
    step_1_name: str = fixed.GUARD_STEP_1_NAME
    step_2_name: str = fixed.GUARD_STEP_2_NAME
    marker: str = fixed.CONFIG_MARKER
    command_head: str = fixed.GUARD_COMMAND_HEAD
    command_tail: str = fixed.GUARD_COMMAND_TAIL

    def is_step_1(self) -> Column:
        return (F.col("step_id") == 1) & same_name("step_name", self.step_1_name)

    def is_step_2(self) -> Column:
        return (F.col("step_id") == 2) & same_name("step_name", self.step_2_name)

    def command_parts(self, step: int) -> tuple[str, str]:
        """The text of a guard command before and after the config name."""
        return f"{self.command_head}{step} , {self.marker}", self.command_tail


DEFAULT_GUARD = Guard(database="DBA")
