"""Run a registered query and its SQL counterpart and compare the rows."""

from __future__ import annotations

import math
import os
from typing import Any

import duckdb
import pyarrow as pa

from tidemark.catalog.registry import NAMES

DATA = "/root/testdata"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value: Any) -> str:
    if value is None:
        return "~null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{cell(v)}" for k, v in sorted(value.items())) + "}"
    return str(value)


def table_rows(table: pa.Table) -> list[tuple[str, ...]]:
    names = sorted(table.column_names)
    columns = [[cell(v) for v in table.column(name).to_pylist()] for name in names]
    return sorted(zip(*columns)) if columns else []


def kind(t: pa.DataType) -> str:
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{kind(t.value_type)}>"
    if pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return "string"
    return str(t)


def compare(name: str, spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """Problems found, none if both agree on names, types, row count and every value."""
    problems = []
    left, right = set(spark_table.column_names), set(sql_table.column_names)
    if left != right:
        return [f"{name}: columns {sorted(left)} against {sorted(right)}"]
    for column in sorted(left):
        a, b = kind(spark_table.schema.field(column).type), kind(sql_table.schema.field(column).type)
        if a != b:
            problems.append(f"{name}: {column} is {a} against {b}")
    if spark_table.num_rows != sql_table.num_rows:
        return [*problems, f"{name}: {spark_table.num_rows} rows against {sql_table.num_rows}"]
    a, b = table_rows(spark_table), table_rows(sql_table)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        problems.append(f"{name}: {len(differing)} of {len(a)} rows differ, first {differing[0]}")
    return problems


def folder(scale: str | None = None) -> str:
    return f"{DATA}/{scale or os.environ.get('CHECK_SF', 'sf0.01')}"


def fetch(con: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    return con.sql(sql).to_arrow_table()
