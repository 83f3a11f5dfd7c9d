"""The derived fleet with everything in it that an operator has to refuse or report.

Each table is that of ``DerivedFleet`` with some rows changed, added or left out:
names in other case and with trailing blanks, repeated configs, databases, requests and
steps, gaps, quotes, steps that lead into the guard, unreadable commands and documents.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guardwork.schemas import CARRIED_STEP_COLUMNS, HISTORY_STEP_COLUMNS
from guardwork.sources.derived import DerivedFleet

# Job ids by what is wrong with the job's steps.
NO_FIRST_STEP = "job_id % 41 = 5"
FIRST_STEP_TWICE = "job_id % 43 = 7"
LEADS_INTO_GUARD = "job_id % 23 = 9"
UNREADABLE_COMMAND = "job_id % 7 = 1"


class AwkwardFleet(DerivedFleet):
    """Lazily built, like the fleet it is made from."""

    def __init__(self, fleet: DerivedFleet):
        super().__init__(fleet.spark, fleet.folder)
        self._fleet = fleet

    @cached_property
    def principals(self) -> DataFrame:
        other_case = "right(principal_name, 1) IN ('0', '2', '4', '6', '8')"
        return self._fleet.principals.withColumn(
            "principal_type",
            F.expr(f"IF({other_case}, concat(lower(principal_type), ' '), principal_type)"),
        )

    @cached_property
    def objects(self) -> DataFrame:
        return self._fleet.objects.withColumn(
            "object_type",
            F.expr("IF(server_id % 2 = 0, concat(lower(object_type), ' '), object_type)"),
        )

    @cached_property
    def grant_events(self) -> DataFrame:
        return self.as_awkward_events(self._fleet.grant_events)

    @staticmethod
    def as_awkward_events(events: DataFrame) -> DataFrame:
        cut = "left(event_xml, length(event_xml) - 20)"
        return events.withColumn(
            "event_xml",
            F.expr(
                f"CASE WHEN event_id % 40 = 3 THEN {cut} WHEN event_id % 97 = 5 THEN NULL"
                " ELSE event_xml END"
            ),
        )

    @cached_property
    def run_config(self) -> DataFrame:
        plain = self._fleet.run_config
        again = plain.where("server_id % 5 = 2 AND config_name = 'ASIA'").withColumn(
            "config_name", F.lit("asia ")
        )
        quoted = self._fleet.replica_states.select("server_id").distinct().selectExpr(
            "server_id",
            "concat('O', chr(39), 'Brien') AS config_name",
            "'DB_0' AS driver_database",
            "true AS run_if_ungrouped",
        )
        return plain.unionByName(again).unionByName(quoted)

    @cached_property
    def databases(self) -> DataFrame:
        plain = self._fleet.databases
        again = plain.where("server_id % 8 = 3 AND database_name = 'DB_1'").selectExpr(
            "server_id", "database_id + 50 AS database_id", "'db_1 ' AS database_name"
        )
        return plain.unionByName(again)

    @cached_property
    def replica_states(self) -> DataFrame:
        plain = self._fleet.replica_states
        other = plain.where("server_id % 6 = 1").selectExpr(
            "server_id",
            "replica_id + 1000 AS replica_id",
            "group_id",
            "IF(role_desc = 'PRIMARY', 'SECONDARY', 'PRIMARY') AS role_desc",
        )
        return plain.unionByName(other)

    @cached_property
    def db_replica_states(self) -> DataFrame:
        plain = self._fleet.db_replica_states
        other = plain.where("is_local AND server_id % 6 = 1").withColumn(
            "replica_id", F.col("replica_id") + 1000
        )
        return plain.unionByName(other)

    @cached_property
    def requests(self) -> DataFrame:
        jobs = self._fleet.jobs_plain
        again = jobs.where("job_id % 37 = 0").selectExpr(
            "server_id", "concat(job_name, ' ') AS job_name", "'OTHER' AS config_name"
        )
        quoted = jobs.where("job_id % 44 = 0 AND job_id % 37 <> 0").selectExpr(
            "server_id", "job_name", "concat('O', chr(39), 'Brien') AS config_name"
        )
        return self._fleet.requests.unionByName(again).unionByName(quoted)

    @cached_property
    def steps_plain(self) -> DataFrame:
        return self._fleet.steps_plain.where(f"NOT ({NO_FIRST_STEP} AND step_id = 1)").withColumn(
            "step_id", F.expr(f"IF({FIRST_STEP_TWICE} AND step_id = 2, 1, step_id)")
        )

    @cached_property
    def steps_installed(self) -> DataFrame:
        steps = self._fleet.steps_installed.where(f"NOT ({NO_FIRST_STEP} AND step_id = 3)")
        return steps.withColumns(
            {
                "step_id": F.expr(f"IF({FIRST_STEP_TWICE} AND step_id = 4, 3, step_id)"),
                "on_success_step_id": F.expr(
                    f"IF({LEADS_INTO_GUARD} AND step_id = 3, 1, on_success_step_id)"
                ),
            }
        )

    @cached_property
    def unreadable_steps(self) -> DataFrame:
        """Installed steps, some of whose guard commands hold no config name."""
        return self._fleet.steps_installed.withColumn(
            "command",
            F.expr(f"IF(step_id IN (1, 2) AND {UNREADABLE_COMMAND}, 'no config', command)"),
        )

    @cached_property
    def removal_requests(self) -> DataFrame:
        missing = self._fleet.requests.where("job_name = 'No such job'")
        return self._fleet.jobs_installed.select("server_id", "job_name").unionByName(
            missing.select("server_id", "job_name")
        )

    @cached_property
    def full_steps(self) -> DataFrame:
        """Plain steps with all carried and history columns."""
        types = {**CARRIED_STEP_COLUMNS, **HISTORY_STEP_COLUMNS}
        return self._fleet.steps_plain.withColumns(
            {
                name: F.expr(
                    f"concat('{name} ', step_id)" if kind == "string" else f"step_id + {len(name)}"
                ).cast(kind)
                for name, kind in types.items()
            }
        )
