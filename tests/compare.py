"""Running a query on Spark and its SQL on DuckDB, and comparing the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

GIVEN = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def expected_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return _sorted(names, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _sorted(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    columns = [names[i] for i in order]
    picked = [tuple(row[i] for i in order) for row in rows]
    return columns, sorted(picked, key=lambda row: [(v is None, str(v)) for v in row])
