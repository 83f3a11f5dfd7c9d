"""Both flow tables in one folder, changed together.

Each change writes a new version, a folder of its own with the tables ``jobs`` and ``steps``.
One small pointer file names the version that holds; it is replaced by a rename, so a reader
gets both tables of the old version or both of the new one, whatever becomes of the writer.

The checks of a change are worked out once: their result, a row a requested job, is stored
in the draft of the new version, its reasons are counted while it is written, and steps,
job starts and checks are then made from what is stored.  A strict batch with a refused request
ends there, before any step is written, and the pointer stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from guardwork.operators.flow import (
    OK,
    REASONS,
    Flow,
    RequestError,
    install_flow,
    install_plan,
    remove_flow,
    remove_plan,
)
from guardwork.operators.guard import DEFAULT_GUARD, Guard
from guardwork.schemas import require

POINTER = "_current"


class ChangedMeanwhile(RuntimeError):
    """Another change was published while this one was worked out; nothing was published."""


@dataclass(frozen=True)
class Published:
    """A published change: its version, jobs by outcome, and the outcome of each request."""

    version: str
    outcomes: dict[str, int]
    checks: DataFrame


class FlowStore:
    """The job and step tables of a fleet under ``folder``, which all executors must reach.

    One change at a time is meant to be made: a change that finds the pointer moved is given
    up (``ChangedMeanwhile``), but the look and the rename are two steps.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def create(self, jobs: DataFrame, steps: DataFrame) -> str:
        """The first version."""
        if self.current() is not None:
            raise ValueError(f"there is a version in {self.folder} already")
        version = self._draft()
        self._write(version, require(jobs, "jobs"), require(steps, "steps"))
        self._publish(None, version)
        return version

    def current(self) -> str | None:
        """The version that holds; None before the first."""
        path = self._path(POINTER)
        files = self._files()
        try:
            if not files.exists(path):
                return None
            content = files.open(path)
            try:
                return self._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8").strip()
            finally:
                content.close()
        finally:
            files.close()

    def read(self, version: str | None = None) -> tuple[DataFrame, DataFrame]:
        """Jobs and steps of a version, by default of the one that holds now."""
        version = version or self.current()
        if version is None:
            raise ValueError(f"there is no version in {self.folder}")
        return tuple(self.spark.read.parquet(f"{self.folder}/{version}/{t}") for t in ("jobs", "steps"))

    def install(
        self,
        requests: DataFrame,
        run_config: DataFrame,
        guard: Guard = DEFAULT_GUARD,
        strict: bool = False,
    ) -> Published:
        """Publishes the tables with the guard in front of the requested jobs."""
        return self._change(
            requests,
            lambda jobs, steps: install_plan(requests, jobs, steps, run_config, guard),
            lambda plan, jobs, steps: install_flow(plan, requests, jobs, steps, guard),
            strict,
        )

    def remove(
        self, requests: DataFrame, guard: Guard = DEFAULT_GUARD, strict: bool = False
    ) -> Published:
        """Publishes the tables without the guard of the named jobs."""
        return self._change(
            requests,
            lambda jobs, steps: remove_plan(requests, jobs, steps, guard),
            lambda plan, jobs, steps: remove_flow(plan, requests, jobs, steps),
            strict,
        )

    def _change(
        self,
        requests: DataFrame,
        plan_of: Callable[[DataFrame, DataFrame], DataFrame],
        flow_of: Callable[[DataFrame, DataFrame, DataFrame], Flow],
        strict: bool,
    ) -> Published:
        before, version = self.current(), self._draft()
        jobs, steps = self.read(before)
        at = f"{self.folder}/{version}"
        counted = Observation()
        reasons = [F.count_if(F.col("reason") == r).alias(r) for r in (OK, *REASONS)]
        plan = plan_of(jobs, steps)
        plan.observe(counted, *reasons).write.parquet(f"{at}/plan")
        outcomes = {reason: n for reason, n in counted.get.items() if n}
        plan = self.spark.read.schema(plan.schema).parquet(f"{at}/plan")
        flow = flow_of(plan, jobs, steps)
        if strict:
            self._refuse(outcomes, flow.checks)
        self._write(version, flow.jobs, flow.steps)
        flow.checks.write.parquet(f"{at}/checks")
        self._publish(before, version)
        return Published(version, outcomes, self.spark.read.parquet(f"{at}/checks"))

    def _refuse(self, outcomes: dict[str, int], checks: DataFrame) -> None:
        if not outcomes:
            raise RequestError("empty", None)
        for reason in REASONS:
            if reason in outcomes:
                raise RequestError(reason, checks.where(F.col("reason") == reason))

    def _write(self, version: str, jobs: DataFrame, steps: DataFrame) -> None:
        steps.write.parquet(f"{self.folder}/{version}/steps")
        jobs.write.parquet(f"{self.folder}/{version}/jobs")

    def _draft(self) -> str:
        return f"version-{uuid.uuid4().hex}"

    @property
    def _jvm(self):
        return self.spark._jvm

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        """The folder's file system; a pointer is whole by its rename, and needs no checksum."""
        conf = self.spark._jsc.hadoopConfiguration()
        uri = self._path(POINTER).toUri()
        if uri.getScheme() is None:
            files = self._jvm.org.apache.hadoop.fs.FileSystem.newInstance(conf)
        else:
            files = self._jvm.org.apache.hadoop.fs.FileSystem.newInstance(uri, conf)
        files.setVerifyChecksum(False)
        return files

    def _publish(self, before: str | None, version: str) -> None:
        draft = self._path(f".{POINTER}-{version}")
        files = self._files()
        try:
            out = files.create(draft, True)
            out.write(bytearray(version.encode()))
            out.close()
            qualified = [files.makeQualified(p) for p in (draft, self._path(POINTER))]
        finally:
            files.close()
        if self.current() != before:
            raise ChangedMeanwhile(version)
        hadoop = self._jvm.org.apache.hadoop.fs
        kinds = getattr(hadoop, "Options$Rename")
        overwrite = self.spark._sc._gateway.new_array(kinds, 1)
        overwrite[0] = kinds.OVERWRITE
        conf = self.spark._jsc.hadoopConfiguration()
        context = hadoop.FileContext.getFileContext(qualified[0].toUri(), conf)
        context.rename(*qualified, overwrite)
