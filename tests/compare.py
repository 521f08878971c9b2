"""Compare a Spark result with DuckDB's, column types and all values included."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _plain(table: pa.Table) -> pa.Table:
    """Arrow types by value class, so that only real differences remain."""
    columns = {}
    for field in sorted(table.schema, key=lambda f: f.name):
        column, kind = table[field.name], field.type
        if pa.types.is_timestamp(kind):
            column = column.cast(pa.timestamp("us"))
        elif pa.types.is_large_string(kind):
            column = column.cast(pa.string())
        columns[field.name] = column
    return pa.table(columns)


def rows(table: pa.Table) -> list[tuple]:
    data = [tuple(r.values()) for r in table.to_pylist()]
    return sorted(data, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def differences(result: DataFrame, connection, sql: str) -> list[str]:
    """What differs between a frame and a SQL text; empty if they agree."""
    left, right = _plain(result.toArrow()), _plain(connection.sql(sql).to_arrow_table())
    found = []
    if left.schema.names != right.schema.names:
        return [f"columns {left.schema.names} / {right.schema.names}"]
    for a, b in zip(left.schema, right.schema):
        if a.type != b.type:
            found.append(f"type of {a.name}: {a.type} / {b.type}")
    if left.num_rows != right.num_rows:
        found.append(f"rows {left.num_rows} / {right.num_rows}")
    for a, b in zip(rows(left), rows(right)):
        if a != b:
            found.append(f"first different row:\n  {a}\n  {b}")
            break
    return found
