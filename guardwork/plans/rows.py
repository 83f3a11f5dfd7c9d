"""How many rows a table can have at most, from what is stored about it: no job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Beyond so many files their footers are not read; the rows are bounded by a number without use.
MOST_FILES = 64
UNCOUNTED = 1 << 62
# Operators that give a row for each row of their input at most.
_NOT_MORE = {
    "Aggregate",
    "Deduplicate",
    "Distinct",
    "Filter",
    "GlobalLimit",
    "LocalLimit",
    "Project",
    "RebalancePartitions",
    "Repartition",
    "RepartitionByExpression",
    "Sort",
    "SubqueryAlias",
    "Window",
}


def most_rows(df: DataFrame) -> int | None:
    """A bound on the rows of a plan over stored or local tables; None if there is none at hand."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    return _most(df, plan)


def _most(df: DataFrame, plan) -> int | None:
    known = plan.stats().rowCount()
    kind = plan.getClass().getSimpleName()
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children and known.isDefined():
        return int(str(known.get()))
    if kind == "LocalRelation":
        return plan.data().size()
    if kind == "OneRowRelation":
        return 1
    if kind == "LogicalRelation":
        return _footer_rows(df, plan.relation())
    if kind in _NOT_MORE:
        below = _most(df, children[0])
        # An aggregate without keys gives a row for no rows.
        return below if below is None else max(1, below)
    if kind == "Union":
        parts = [_most(df, child) for child in children]
        return None if None in parts else sum(parts)
    if kind == "Join" and plan.joinType().toString() in ("LeftSemi", "LeftAnti"):
        return _most(df, children[0])
    return None


def _footer_rows(df: DataFrame, relation) -> int | None:
    """Rows of a table of Parquet files by their footers."""
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    files = relation.location().inputFiles()
    if relation.fileFormat().toString() != "Parquet":
        return None
    if len(files) > MOST_FILES:
        return UNCOUNTED
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            total += reader.getRecordCount()
        finally:
            reader.close()
    return total
