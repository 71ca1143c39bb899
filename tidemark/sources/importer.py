"""Creating tables from files and importing files once each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import Check, ExpectationFailed, run_suite
from tidemark.plans.versions import Lake, UnknownTable
from tidemark.session import written
from tidemark.sources.schema_plan import (
    PlannedColumn,
    SchemaConflict,
    TablePlan,
    file_loads,
    listed,
    plan_table,
    read_planned,
    shapes,
)

LEDGER = "path string, length bigint, imported timestamp"


class ImportFailed(RuntimeError):
    pass


def ledger_name(table: str) -> str:
    return f"{table}__files"


def apply_plan(lake: Lake, name: str, plan: TablePlan, replace: bool = False) -> int:
    """An empty table with the planned schema and partitions; the files planned from are not loaded."""
    return lake.create_table(name, plan.schema(), plan.partitioned_by, replace)


def create_table(
    lake: Lake,
    name: str,
    patterns: str | Sequence[str],
    partitioned_by: str | Sequence[str] = (),
    replace: bool = False,
    fmt: str = "parquet",
) -> TablePlan:
    """Plan and apply in one step; refuses while the files disagree on a type."""
    plan = plan_table(lake.spark, patterns, partitioned_by, fmt=fmt)
    if not plan.can_auto_apply:
        raise SchemaConflict(f"plan has schema conflicts: {', '.join(plan.conflicts)}; resolve them first")
    apply_plan(lake, name, plan, replace)
    return plan


def import_files(
    lake: Lake,
    name: str,
    patterns: str | Sequence[str],
    *,
    plan: TablePlan | None = None,
    allow_duplicates: bool = False,
    best_effort: bool = False,
    continue_on_error: bool = False,
    checks: Sequence[Check] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Append the files not imported before; returns their status (path, status, error).

    The ledger of imported files is a table published in the same version as the rows, so a run that dies half-way leaves
    neither, and a repeated run loads nothing twice. With `checks` the new rows are audited where they were written and
    nothing is published if one fails. Without a `plan`, a file whose types the table does not hold in full is a SchemaConflict.
    """
    spark, lossless = lake.spark, plan is None
    based_on = lake.versions()[-1] if lake.versions() else 0
    tables = lake.record()["tables"]
    if name not in tables:
        raise UnknownTable(f"no table {name}; create it first")
    if tables[name].get("external"):
        raise ValueError(f"{name} is an external table and read-only")
    ledger = ledger_name(name)
    files = listed(spark, patterns, fmt)
    if ledger in tables and not allow_duplicates:
        files = files.join(lake.read(ledger).select("path"), "path", "left_anti")
    footer = written(shapes(files, fmt), "footers")
    bad = footer.filter(F.col("error").isNotNull())
    if not continue_on_error:
        first = bad.select("path", "error").first()
        if first:
            raise ImportFailed(f"{first['path']}: {first['error']}")
    if plan is None:
        schema = lake.read(name).schema
        plan = TablePlan(tuple(PlannedColumn(f.name, (), f.dataType.simpleString()) for f in schema))
    status = footer.groupBy("path").agg(
        F.when(F.max("error").isNull(), F.lit("imported")).otherwise(F.lit("failed")).alias("status"),
        F.max("error").alias("error"),
    )
    entry = tables[name]
    added = 0
    for rows in read_planned(spark, file_loads(footer), plan, best_effort, lossless, fmt):
        entry = lake.stage(name, rows, "APPEND", tables={name: entry})
        added += 1
    if not added:
        return status
    done = footer.filter(F.col("error").isNull()).groupBy("path").agg(F.max("length").alias("length"))
    staged = {
        name: entry,
        ledger: lake.stage(
            ledger, done.select("path", "length", F.current_timestamp().alias("imported")), "APPEND", tables=tables
        ),
    }
    if checks:
        fresh = {**entry, "parts": entry["parts"][-added:]}
        failed = run_suite(lake._open(fresh), list(checks)).filter("NOT passed").collect()
        if failed:
            raise ExpectationFailed(", ".join(f"{row['check']}({row['column']})" for row in failed))
    lake.commit_staged(staged, based_on, f"import into {name}")
    return status
