"""Fleet tables derived from the given star-schema tables.

Orders stand for jobs, line items for their steps, nations for servers, regions for
databases, configs and replication groups, customers for principals and events for
grant events.  ``FIXTURES.md`` defines every table in SQL; this is the same as
DataFrames, so that each query plans its tables from the scan on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guardwork import fixed
from guardwork.plans.joins import lookup, sized_by_rows

# Columns that put the lines of an order into their order.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _text(head: str, number: Column | str) -> Column:
    col = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(head), col.cast("string"))


# Lines of an order that a task may number at once; longer orders are divided.
LINES_AT_ONCE = 100_000


def number_lines(lines: DataFrame, per_order: DataFrame) -> DataFrame:
    """Number the lines of each order (``rn``), count them (``n``), add order columns.

    An order may hold a large part of all lines.  The few orders of more than ``LINES_AT_ONCE``
    lines are counted out first and divided; the lines of all others are shuffled once, by order.
    """
    lines = lines.where("l_orderkey IS NOT NULL")
    counted = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
    long = F.broadcast(counted.where(F.col("_lines") > LINES_AT_ONCE).select("l_orderkey"))
    order = Window.partitionBy("l_orderkey")
    short = (
        lines.join(long, "l_orderkey", "left_anti")
        .withColumn("rn", F.row_number().over(order.orderBy(*LINE_ORDER)))
        .withColumn("n", F.count(F.lit(1)).over(order).cast("int"))
    )
    divided = _number_divided(lines.join(long, "l_orderkey", "left_semi"))
    # Lines without a number or a slice have no place among the others, but count.
    numbered = short.where("l_linenumber IS NOT NULL AND l_partkey > -1").unionByName(
        divided.select(short.columns)
    )
    return numbered.join(sized_by_rows(per_order, ["l_orderkey"]), "l_orderkey")


def _number_divided(lines: DataFrame) -> DataFrame:
    """``rn`` and ``n`` without a window over a whole order.

    Lines fall into slices by line number and part number, in line order; the slices
    are counted, running totals over those counts give each slice its offset, and
    only within a slice are lines numbered one by one.
    """
    slice_of = F.floor(F.log(F.col("l_partkey") + 1) * 64).cast("int")
    key = ["l_orderkey", "l_linenumber", "_slice"]
    sliced = lines.withColumn("_slice", slice_of)

    order_of_slices = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "_slice")
    earlier = order_of_slices.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_lines"))
        .select(
            *key,
            F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_lines").over(Window.partitionBy("l_orderkey")).cast("int").alias("n"),
        )
    )
    within = Window.partitionBy(*key).orderBy(*LINE_ORDER[1:])
    return (
        sliced.withColumn("_row", F.row_number().over(within))
        .join(offsets, key)
        .withColumn("rn", (F.col("_before") + F.col("_row")).cast("int"))
    )


class DerivedFleet:
    """Lazily built fleet tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def _server_regions(self) -> DataFrame:
        """Each server with each region, by an equi-join on the list of region keys."""
        keys = self.given("region").select(F.collect_set("r_regionkey")).scalar()
        servers = self.given("nation").select(
            F.col("n_nationkey").cast("bigint").alias("server_id"),
            "n_nationkey",
            F.explode(keys).alias("r_regionkey"),
        )
        return servers.join(self.given("region"), "r_regionkey")

    @property
    def _orders(self) -> DataFrame:
        return self.given("orders").select(
            (F.col("o_custkey") % 25).alias("server_id"), F.col("o_orderkey").alias("job_id")
        )

    def _orders_with_region(self, orders: DataFrame) -> DataFrame:
        """Orders with the region that stands for their config."""
        keyed = orders.withColumn("r_regionkey", (F.col("job_id") % 5).cast("int"))
        return lookup(keyed, self.given("region"), ["r_regionkey"], ["job_id"], "inner")

    def _jobs(self, start: Column) -> DataFrame:
        return self._orders.select(
            "server_id",
            "job_id",
            _text("Job ", "job_id").alias("job_name"),
            start.alias("start_step_id"),
        )

    @cached_property
    def jobs_plain(self) -> DataFrame:
        return self._jobs(F.when(F.col("job_id") % 3 == 0, 2).otherwise(1))

    @cached_property
    def steps_plain(self) -> DataFrame:
        per_order = self._orders.withColumnRenamed("job_id", "l_orderkey")
        lines = number_lines(self.given("lineitem").select("l_orderkey", *LINE_ORDER), per_order)
        goes_on = F.col("rn") < F.col("n")
        stops = F.col("l_linestatus") == "F"
        return lines.select(
            "server_id",
            F.col("l_orderkey").alias("job_id"),
            F.col("rn").alias("step_id"),
            _text("Load part ", "l_partkey").alias("step_name"),
            F.when(F.col("l_returnflag") == "A", "TSQL")
            .when(F.col("l_returnflag") == "R", "CmdExec")
            .otherwise("SSIS")
            .alias("subsystem"),
            _text("EXEC dbo.LoadPart @id = ", "l_partkey").alias("command"),
            F.when(goes_on, fixed.GO_TO_STEP)
            .otherwise(fixed.QUIT_WITH_SUCCESS)
            .alias("on_success_action"),
            F.when(goes_on, F.col("rn") + 1).otherwise(0).alias("on_success_step_id"),
            F.when(stops, 2).otherwise(4).alias("on_fail_action"),
            F.when(stops, 0).otherwise(F.col("n")).alias("on_fail_step_id"),
            _text("DB_", F.col("l_suppkey") % 5).alias("database_name"),
        )

    @cached_property
    def run_config(self) -> DataFrame:
        both = F.col("n_nationkey") + F.col("r_regionkey")
        return self._server_regions.where(both % 7 != 0).select(
            "server_id",
            F.col("r_name").alias("config_name"),
            _text("DB_", "r_regionkey").alias("driver_database"),
            (both % 2 == 0).alias("run_if_ungrouped"),
        )

    @cached_property
    def databases(self) -> DataFrame:
        return self._server_regions.where(
            (F.col("n_nationkey") * 3 + F.col("r_regionkey")) % 11 != 0
        ).select(
            "server_id",
            (F.col("r_regionkey") + 5).alias("database_id"),
            _text("DB_", "r_regionkey").alias("database_name"),
        )

    @cached_property
    def replica_states(self) -> DataFrame:
        primary = F.col("n_nationkey") % 5 == F.col("r_regionkey")
        return self._server_regions.where("r_regionkey < 3").select(
            "server_id",
            F.col("n_nationkey").alias("replica_id"),
            F.col("r_regionkey").alias("group_id"),
            F.when(primary, fixed.ROLE_PRIMARY).otherwise("SECONDARY").alias("role_desc"),
        )

    @cached_property
    def db_replica_states(self) -> DataFrame:
        own = F.col("n_nationkey")
        return self._server_regions.where("r_regionkey < 3").select(
            "server_id",
            F.explode(
                F.array(
                    F.struct(own.alias("replica_id"), F.lit(True).alias("is_local")),
                    F.struct(((own + 1) % 25).alias("replica_id"), F.lit(False).alias("is_local")),
                )
            ).alias("_replica"),
            F.col("r_regionkey").alias("group_id"),
            (F.col("r_regionkey") + 5).alias("database_id"),
        ).select("server_id", "_replica.replica_id", "group_id", "database_id", "_replica.is_local")

    @cached_property
    def requests(self) -> DataFrame:
        wanted = self._orders_with_region(self._orders.where("job_id % 4 <> 0")).select(
            "server_id",
            _text("JOB ", "job_id").alias("job_name"),
            F.when(F.col("job_id") % 29 == 0, "NOWHERE")
            .otherwise(F.col("r_name"))
            .alias("config_name"),
        )
        unknown = self.given("nation").where("n_nationkey = 3").select(
            F.col("n_nationkey").cast("bigint").alias("server_id"),
            F.lit("No such job").alias("job_name"),
            F.lit("ASIA").alias("config_name"),
        )
        return wanted.unionByName(unknown)

    @cached_property
    def jobs_installed(self) -> DataFrame:
        moved = (F.col("job_id") % 6 == 0) | (F.col("job_id") % 11 == 0)
        return self._jobs(F.when(moved, 2).otherwise(1))

    @cached_property
    def steps_installed(self) -> DataFrame:
        job = F.col("job_id")
        shift = F.when(job % 6 == 0, 0).otherwise(2)

        def target(name: str) -> Column:
            return F.when(F.col(name) == 0, 0).otherwise(F.col(name) + shift).alias(name)

        plain = self.steps_plain
        shifted = plain.select(
            *[
                (F.col(c) + shift).alias(c)
                if c == "step_id"
                else target(c)
                if c in ("on_success_step_id", "on_fail_step_id")
                else c
                for c in plain.columns
            ]
        )
        config_2 = (
            F.when(job % 13 == 0, "OTHER")
            .when(job % 17 == 0, F.lower("r_name"))
            .otherwise(F.col("r_name"))
        )
        name_2 = F.when(job % 19 == 0, "Renamed").otherwise(fixed.GUARD_STEP_2_NAME)

        def guard(n: int, name: Column, config: Column, flow: list[Column]) -> Column:
            head = F.lit(f"EXECUTE chk @JobStepID = {n} , {fixed.CONFIG_MARKER}")
            return F.struct(
                F.lit(n).alias("step_id"),
                name.alias("step_name"),
                F.lit("TSQL").alias("subsystem"),
                F.concat(head, config, F.lit("'")).alias("command"),
                flow[0].alias("on_success_action"),
                flow[1].alias("on_success_step_id"),
                flow[2].alias("on_fail_action"),
                flow[3].alias("on_fail_step_id"),
                F.lit("DBA").alias("database_name"),
            )

        first_target = F.lit(3) + (job % 2).cast("int")
        on = F.lit(fixed.GO_TO_STEP)
        flow_1 = [on, first_target, on, F.lit(2)]
        ends = [F.lit(fixed.QUIT_WITH_SUCCESS), F.lit(fixed.QUIT_WITH_FAILURE)]
        flow_2 = [ends[0], F.lit(0), ends[1], F.lit(0)]
        guards = (
            self._orders_with_region(self._orders.where("job_id % 6 <> 0"))
            .select(
                "server_id",
                "job_id",
                F.explode(
                    F.array(
                        guard(1, F.lit(fixed.GUARD_STEP_1_NAME), F.col("r_name"), flow_1),
                        guard(2, name_2, config_2, flow_2),
                    )
                ).alias("_guard"),
            )
            .select("server_id", "job_id", "_guard.*")
        )
        return shifted.unionByName(guards)

    @cached_property
    def principals(self) -> DataFrame:
        kind = F.col("c_custkey") % 4
        return (
            self.given("customer")
            .where("c_custkey % 10 <> 9")
            .select(
                (F.col("c_nationkey") % 5).alias("server_id"),
                F.col("c_name").alias("principal_name"),
                F.when(kind == 0, "S")
                .when(kind == 1, "U")
                .when(kind == 2, "R")
                .otherwise("G")
                .alias("principal_type"),
            )
        )

    @staticmethod
    def as_grant_events(events: DataFrame) -> DataFrame:
        """Events as grant events; also for a stream of them."""

        def element(head: str, number: Column) -> Column:
            digits = F.lpad(number.cast("string"), 9, "0")
            return F.concat(F.lit(f"<Grantee>{head}"), digits, F.lit("</Grantee>"))

        event = F.col("event_id")
        kind = F.when(F.col("event_type").isin("click", "view"), "REVOKE_DATABASE").otherwise(
            fixed.GRANT_EVENT
        )
        return events.select(
            "event_id",
            "ts",
            (F.col("user_id") % 5).cast("int").alias("server_id"),
            F.concat(
                F.lit("<EVENT_INSTANCE><EventType>"),
                kind,
                F.lit("</EventType><Grantees>"),
                element("Customer#", F.col("user_id")),
                F.when(event % 2 == 0, element("CUSTOMER#", event % 150)).otherwise(""),
                F.when(event % 50 == 0, "<Grantee></Grantee>").otherwise(""),
                F.lit("</Grantees></EVENT_INSTANCE>"),
            ).alias("event_xml"),
        )

    @cached_property
    def grant_events(self) -> DataFrame:
        return self.as_grant_events(self.given("events"))

    @cached_property
    def expected_objects(self) -> DataFrame:
        name = F.element_at(
            F.array(*[F.lit(n) for n in fixed.FULLTEXT_TABLES]), F.col("r_regionkey") + 1
        )
        return self._server_regions.where("r_regionkey < 3").select(
            "server_id", name.alias("object_name")
        )

    @cached_property
    def objects(self) -> DataFrame:
        name = F.col("object_name")
        internal = self.expected_objects.where(
            (F.col("server_id") + F.length(name)) % 4 != 0
        ).select(
            "server_id",
            F.when(F.col("server_id") % 3 == 0, F.upper(name)).otherwise(name).alias("object_name"),
            F.when(F.col("server_id") == 7, "U")
            .otherwise(fixed.INTERNAL_TABLE)
            .alias("object_type"),
        )
        others = self.given("part").select(
            (F.col("p_partkey") % 25).alias("server_id"),
            _text("Part_", "p_partkey").alias("object_name"),
            F.when(F.col("p_partkey") % 2 == 0, fixed.INTERNAL_TABLE)
            .otherwise("U")
            .alias("object_type"),
        )
        return internal.unionByName(others)


TABLE_NAMES = [
    "jobs_plain",
    "steps_plain",
    "run_config",
    "databases",
    "replica_states",
    "db_replica_states",
    "requests",
    "jobs_installed",
    "steps_installed",
    "principals",
    "grant_events",
    "expected_objects",
    "objects",
]
