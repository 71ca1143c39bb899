"""Scans, SQL over named tables, row caps and row iterators."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.params import markers
from tidemark.functions.sqltext import where


def as_table(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A DataFrame as it is, a path as Parquet, anything else as a registered table or view."""
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def filtered(df: DataFrame, text: str | None, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Keep the rows where `text` is true; `$name` in it is bound as a typed parameter, never pasted."""
    return df if text is None else where(df, text, bound(text, params or {}))


def bound(text: str, params: Mapping[str, Any]) -> dict[str, Any]:
    """The parameters `text` uses; a marker without a value is an error."""
    used = set(re.findall(r":(\w+)", markers(text, only=True)))
    missing = used - set(params)
    if missing:
        raise ValueError(f"no value for parameter: {', '.join(sorted(missing))}")
    return {name: params[name] for name in used}


def scan(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    columns: Sequence[str] | None = None,
    filters: str | None = None,
    limit: int | None = None,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Projection, filter and limit over one table; Catalyst pushes the first two into the Parquet reader."""
    if columns is not None and not list(columns):
        raise ValueError("Empty column list")
    df = filtered(as_table(spark, source), filters, params)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def relations(spark: SparkSession, sql: str) -> set[str]:
    """Names of the tables that a statement reads, in lower case, taken from Spark's parsed plan; CTEs of its own among them."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(markers(sql))
    found: set[str] = set()
    is_plan = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan").isInstance

    def visit(node: Any) -> None:
        if node.getClass().getSimpleName() == "UnresolvedRelation":
            found.add(node.tableName().replace("`", "").lower())
        # subqueries stand in expressions, common table expressions beside the children
        for below in (node.children(), node.innerChildren(), node.subqueries()):
            for x in (below.apply(i) for i in range(below.size())):
                if is_plan(x):
                    visit(x)

    visit(plan)
    return found


# One statement at a time names its tables.
_views = threading.RLock()


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def query(
    spark: SparkSession,
    sql: str,
    *,
    tables: Mapping[str, str | DataFrame] | None = None,
    params: Mapping[str, Any] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Run SQL over the named tables, with `$name` parameters bound by value.

    The names are temporary views only while Spark analyses the statement; the session's own views of those names come back.
    """
    opened = {name: as_table(spark, source) for name, source in (tables or {}).items()}
    with _views:
        own = {name: spark.table(name) for name in opened if _is_view(spark, name)}
        try:
            for name, source in opened.items():
                source.createOrReplaceTempView(name)
            df = spark.sql(markers(sql), args=bound(sql, params or {}) or None)
        finally:
            for name in opened:
                if name in own:
                    own[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)
    return df if max_rows is None else df.limit(max_rows)


def rows(df: DataFrame, prefetch: bool = True) -> Iterator[dict[str, Any]]:
    """Rows as dicts, one partition in driver memory at a time; empty partitions do not end the iteration."""
    for row in df.toLocalIterator(prefetchPartitions=prefetch):
        yield row.asDict(recursive=True)
