"""Expectations over a table, fused into one aggregation.

Every check is a handful of aggregate columns plus a verdict over their values, so a suite of any length reads the table
once. Nulls and empty tables follow Arrow's compute functions; a verdict Arrow leaves undefined counts as failed.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType(
    [
        T.StructField("check", T.StringType(), False),
        T.StructField("column", T.StringType(), True),
        T.StructField("passed", T.BooleanType(), False),
        T.StructField("observed", T.DoubleType(), True),
    ]
)


class ExpectationFailed(AssertionError):
    """A strict suite had a failing check."""


@dataclass(frozen=True)
class Check:
    """One expectation.

    `aggregates` are evaluated over the whole table. `verdict` and `observed` turn them, handed over as columns, into the
    outcome and the number behind it. `keep` is the row predicate that holds for a good row, where one row can be judged.
    All are functions, so checks can be declared before there is a session.
    """

    name: str
    column: str
    aggregates: Callable[[DataFrame], list[Column]]
    verdict: Callable[..., Column]
    observed: Callable[..., Column]
    keep: Callable[[], Column] | None = None
    unique: bool = False
    options: dict[str, Any] = field(default_factory=dict)


def _ignored(value: Column) -> Column:
    return value.cast("double")


def equal_concatenation(target: str, columns: Sequence[str], separator: str = "") -> Check:
    """`target` equals the other columns joined by `separator`; a row with a null on either side is skipped.

    Engines write floating numbers and timestamps as text in different ways, so those are refused: cast them first.
    """

    def same() -> Column:
        parts: list[Column] = []
        for column in columns:
            if parts:
                parts.append(F.lit(separator))
            parts.append(F.col(column).cast("string"))
        return F.concat(*parts) == F.col(target)

    def outcome(df: DataFrame) -> list[Column]:
        loose = [c for c in columns if df.schema[c].dataType.typeName() in ("float", "double", "timestamp", "timestamp_ntz")]
        if loose:
            raise TypeError(f"equal_concatenation: {', '.join(loose)} has no one form as text; cast it first")
        return [F.bool_and(same()), F.count_if(~same())]

    return Check(
        "equal_concatenation",
        target,
        outcome,
        lambda all_same, differing: F.coalesce(all_same, F.lit(False)),
        lambda all_same, differing: _ignored(differing),
        keep=lambda: F.coalesce(same(), F.lit(True)),
    )


def _mean(name: str, column: str, holds: Callable[[Column], Column]) -> Check:
    # Spark sorts NaN above every number, but a NaN mean meets no bound.
    return Check(
        name,
        column,
        lambda df: [F.avg(F.col(column).cast("double"))],
        lambda mean: F.coalesce(~F.isnan(mean) & holds(mean), F.lit(False)),
        lambda mean: mean,
    )


def mean_greater_than(column: str, value: float) -> Check:
    return _mean("mean_greater_than", column, lambda mean: mean > value)


def mean_greater_or_equal_than(column: str, value: float) -> Check:
    return _mean("mean_greater_or_equal_than", column, lambda mean: mean >= value)


def mean_smaller_than(column: str, value: float) -> Check:
    return _mean("mean_smaller_than", column, lambda mean: mean < value)


def mean_smaller_or_equal_than(column: str, value: float) -> Check:
    return _mean("mean_smaller_or_equal_than", column, lambda mean: mean <= value)


def _nulls(
    name: str, column: str, verdict: Callable[..., Column], keep: Callable[[], Column] | None
) -> Check:
    return Check(
        name,
        column,
        lambda df: [F.count_if(F.col(column).isNull()), F.count(F.lit(1))],
        verdict,
        lambda nulls, rows: _ignored(nulls),
        keep=keep,
    )


def some_null(column: str) -> Check:
    return _nulls("some_null", column, lambda nulls, rows: nulls > 0, None)


def no_nulls(column: str) -> Check:
    return _nulls("no_nulls", column, lambda nulls, rows: nulls == 0, lambda: F.col(column).isNotNull())


def all_null(column: str) -> Check:
    return _nulls("all_null", column, lambda nulls, rows: nulls == rows, lambda: F.col(column).isNull())


def _distinct(name: str, column: str, verdict: Callable[[Column, Column], Column], unique: bool) -> Check:
    # Null is one more value, and NaN equals NaN.
    def distinct(values: Column, null: Column) -> Column:
        return values + F.coalesce(null, F.lit(0))

    return Check(
        name,
        column,
        lambda df: [
            F.count_distinct(F.col(column)),
            F.max(F.col(column).isNull().cast("int")),
            F.count(F.lit(1)),
        ],
        lambda values, null, rows: verdict(distinct(values, null), rows),
        lambda values, null, rows: _ignored(rows - distinct(values, null)),
        unique=unique,
    )


def all_unique(column: str) -> Check:
    return _distinct("all_unique", column, lambda distinct, rows: distinct == rows, True)


def not_unique(column: str) -> Check:
    return _distinct("not_unique", column, lambda distinct, rows: distinct < rows, False)


def accepted_values(column: str, values: Sequence[Any]) -> Check:
    """Every value is in the list; null is refused unless the list holds None."""
    listed = [value for value in values if value is not None]

    def accepted() -> Column:
        if not listed:
            return F.col(column).isNull() & F.lit(None in values)
        return F.coalesce(F.col(column).isin(listed), F.lit(None in values))

    return Check(
        "accepted_values",
        column,
        lambda df: [F.bool_and(accepted()), F.count_if(~accepted())],
        lambda good, bad: F.coalesce(good, F.lit(False)),
        lambda good, bad: _ignored(bad),
        keep=accepted,
    )


def fresh(column: str, hours: float, now: dt.datetime) -> Check:
    """The newest timestamp is at most `hours` before `now`; no timestamp at all fails."""
    oldest = now - dt.timedelta(hours=hours)
    return Check(
        "fresh",
        column,
        lambda df: [F.max(column)],
        lambda newest: F.coalesce(newest >= F.lit(oldest), F.lit(False)),
        lambda newest: F.unix_timestamp(newest.cast("timestamp")).cast("double"),
    )


def positive(column: str) -> Check:
    """Strictly positive; null is a violation."""

    def bad() -> Column:
        return F.col(column).isNull() | (F.col(column) <= 0)

    return Check(
        "positive",
        column,
        lambda df: [F.count_if(bad())],
        lambda count: count == 0,
        lambda count: _ignored(count),
        keep=lambda: ~bad(),
    )


def column_type(column: str, expected: str) -> Check:
    """The declared type is `expected` (a DDL name); reads no data of its own."""
    return Check(
        "column_type",
        column,
        lambda df: [F.max(F.lit(df.schema[column].dataType.simpleString() == expected))],
        lambda same: F.coalesce(same, F.lit(False)),
        lambda same: F.lit(None).cast("double"),
        options={"expected": expected},
    )


def satisfies(name: str, column: str, predicate: Column | str) -> Check:
    """A user's own row predicate, as a column or SQL text; a row where it is null is a violation."""

    def good() -> Column:
        return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))

    return Check(
        name,
        column,
        lambda df: [F.count_if(~good())],
        lambda count: count == 0,
        lambda count: _ignored(count),
        keep=good,
    )


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check (check, column, passed, observed) from a single aggregation over `df`."""
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT)
    metrics: list[Column] = []
    spans: list[tuple[int, int]] = []
    for check in checks:
        made = check.aggregates(df)
        spans.append((len(metrics), len(metrics) + len(made)))
        metrics.extend(made)
    measured = df.agg(*[metric.alias(f"m{i}") for i, metric in enumerate(metrics)])
    outcomes = []
    for check, (start, end) in zip(checks, spans):
        values = [F.col(f"m{i}") for i in range(start, end)]
        if check.name == "column_type":  # known without data, so an empty table passes too
            passed = F.lit(df.schema[check.column].dataType.simpleString() == check.options["expected"])
        else:
            passed = check.verdict(*values)
        outcomes.append(
            F.struct(
                F.lit(check.name).alias("check"),
                F.lit(check.column).alias("column"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                check.observed(*values).alias("observed"),
            )
        )
    return measured.select(F.inline(F.array(*outcomes)))


def holds(df: DataFrame, check: Check) -> bool:
    return run_suite(df, [check]).first()["passed"]


def violations(df: DataFrame, check: Check) -> DataFrame:
    """The rows that break a check: judged one by one, or for uniqueness every row of a repeated value."""
    if check.keep is not None:
        return df.filter(~check.keep())
    if check.unique:
        repeated = (
            df.groupBy(F.col(check.column).alias("__value"))
            .agg(F.count(F.lit(1)).alias("__n"))
            .filter("__n > 1")
        )
        return df.join(repeated, df[check.column].eqNullSafe(repeated["__value"]), "left_semi")
    raise ValueError(f"{check.name} judges the whole table, not single rows")


def verdict(value: Any) -> bool:
    """The outcome of a user's expectation function; only booleans count, numpy's included."""
    if isinstance(value, bool) or type(value).__name__ in ("bool_", "bool"):
        return bool(value)
    raise TypeError(f"expectation returned unsupported type: {type(value).__name__}")


def run_expectation(df: DataFrame, function: Callable[[DataFrame], Any]) -> tuple[bool, str]:
    """Run one expectation function; an assertion that fails is a failed outcome with its message."""
    try:
        passed = verdict(function(df))
    except AssertionError as error:
        return False, str(error) or "assertion failed"
    return passed, "" if passed else "expectation returned false"


def enforce(results: Iterable[Any], strict: bool) -> bool:
    """True if all passed. Failures raise when strict and only warn otherwise."""
    failed = [f"{row['check']}({row['column']})" for row in results if not row["passed"]]
    if failed and strict:
        raise ExpectationFailed(", ".join(failed))
    if failed:
        warnings.warn(f"expectations failed: {', '.join(failed)}", stacklevel=2)
    return not failed


def key_audit(df: DataFrame, key: str, required: str) -> DataFrame:
    """Duplicate keys and missing values in one row: count(*) - count(distinct key), nulls of `required`."""
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"),
        F.count_if(F.col(required).isNull()).alias("missing_values"),
    )


# The same checks as plain functions returning a boolean, one job each.

_accepted = accepted_values  # the last function has a parameter of this name


def expect_column_equal_concatenation(
    table: DataFrame, target_column: str, columns: Sequence[str], separator: str = ""
) -> bool:
    return holds(table, equal_concatenation(target_column, columns, separator))


def expect_column_mean_greater_than(table: DataFrame, column_name: str, value: float) -> bool:
    return holds(table, mean_greater_than(column_name, value))


def expect_column_mean_greater_or_equal_than(table: DataFrame, column_name: str, value: float) -> bool:
    return holds(table, mean_greater_or_equal_than(column_name, value))


def expect_column_mean_smaller_than(table: DataFrame, column_name: str, value: float) -> bool:
    return holds(table, mean_smaller_than(column_name, value))


def expect_column_mean_smaller_or_equal_than(table: DataFrame, column_name: str, value: float) -> bool:
    return holds(table, mean_smaller_or_equal_than(column_name, value))


def expect_column_some_null(table: DataFrame, column_name: str) -> bool:
    return holds(table, some_null(column_name))


def expect_column_no_nulls(table: DataFrame, column_name: str) -> bool:
    return holds(table, no_nulls(column_name))


def expect_column_all_null(table: DataFrame, column_name: str) -> bool:
    return holds(table, all_null(column_name))


def expect_column_all_unique(table: DataFrame, column_name: str) -> bool:
    return holds(table, all_unique(column_name))


def expect_column_not_unique(table: DataFrame, column_name: str) -> bool:
    return holds(table, not_unique(column_name))


def expect_column_accepted_values(table: DataFrame, column_name: str, accepted_values: Sequence[Any]) -> bool:
    return holds(table, _accepted(column_name, accepted_values))
