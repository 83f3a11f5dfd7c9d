"""Refusing grants as they arrive.

One event is one row, so all its grantees arrive together and no state is kept.  Each
micro-batch is answered by the batch operator, which needs one row per event within
the batch.  A batch may be run again after a failure: it owns the folder named by its
query and number and overwrites it, so nothing is written twice, and a query with a new
checkpoint, which numbers from 0 again, leaves earlier findings alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from guardwork.operators.grants import broken_of, documents, refused_of

_KEY_SCHEMA = "event_id bigint, server_id int"


def broken_folder(output: str) -> str:
    """Where unreadable documents go unless another folder is named."""
    return f"{output.rstrip('/')}-broken"


def refuse_grants(
    events: DataFrame,
    principals: Callable[[SparkSession], DataFrame],
    output: str,
    checkpoint: str,
    trigger: dict | None = None,
    broken_output: str | None = None,
) -> StreamingQuery:
    """Start writing the refused events of a stream to ``output``.

    ``principals`` is called once per batch, as principals change over time.
    ``output`` and ``checkpoint`` must be folders that every executor can reach.
    Events whose document cannot be read go to ``broken_output``, by default the folder
    beside ``output`` that ``broken_folder`` names.
    """
    broken_output = broken_output or broken_folder(output)

    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        part = f"query={query}/batch_id={batch_id}"
        parsed = documents(batch).persist()  # one parse for both outputs
        try:
            refused = refused_of(parsed, principals(spark))
            refused.write.mode("overwrite").parquet(f"{output}/{part}")
            broken_of(parsed).write.mode("overwrite").parquet(f"{broken_output}/{part}")
        finally:
            parsed.unpersist()

    writer = events.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _so_far(spark: SparkSession, folder: str, column: str, keys: str) -> DataFrame:
    schema = T._parse_datatype_string(f"{keys}, {column} string")
    try:
        return spark.read.parquet(folder).select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def refused_so_far(spark: SparkSession, output: str, keys: str = _KEY_SCHEMA) -> DataFrame:
    """All events refused by a stream; none before its first batch.

    ``keys`` are the types of the key columns for that case; otherwise they are those of
    the stream.
    """
    return _so_far(spark, output, "message", keys)


def broken_so_far(spark: SparkSession, broken_output: str, keys: str = _KEY_SCHEMA) -> DataFrame:
    """All events whose document a stream could not read."""
    return _so_far(spark, broken_output, "event_xml", keys)
