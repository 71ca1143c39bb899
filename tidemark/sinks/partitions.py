"""Partition transforms, pruning by them, and the filter language of a partition overwrite."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.sqltext import where

# The transforms a partition spec may name. `bucket` takes a count as well.
TRANSFORMS = ("identity", "year", "month", "day", "hour", "bucket")

_SPEC = re.compile(r"\s*(?:(\w+)\s*\(\s*(?:(\d+)\s*,\s*)?(\w+)\s*(?:,\s*(\d+)\s*)?\)|(\w+))\s*", re.IGNORECASE)
_COMMA = re.compile(r",(?![^(]*\))")


@dataclass(frozen=True)
class Transform:
    """One partition field: `name(column)`, written as the derived column `part_column`."""

    name: str
    column: str
    buckets: int = 0

    @property
    def derived(self) -> str:
        return f"part_{self.column}_{self.name}"

    def of(self, value: Column) -> Column:
        if self.name == "identity":
            return value
        if self.name == "bucket":
            return F.pmod(F.hash(value), F.lit(self.buckets))
        # dates and plain hours, so that the folder names sort and compare
        return {
            "year": F.year(value),
            "month": F.trunc(value.cast("date"), "month"),
            "day": value.cast("date"),
            "hour": F.date_format(value, "yyyy-MM-dd-HH"),
        }[self.name]


def partition_spec(text: str | Sequence[str]) -> list[Transform]:
    """Read `"day(ts), customer"` or `["DAY(ts)", "customer", "bucket(16, user)"]`; names are case-insensitive."""
    parts = _COMMA.split(text) if isinstance(text, str) else list(text)
    found = []
    for part in parts:
        match = _SPEC.fullmatch(part)
        if not match:
            raise ValueError(f"not a partition field: {part!r}")
        name, before, column, after, plain = match.groups()
        if plain:
            found.append(Transform("identity", plain))
            continue
        name, buckets = name.lower(), int(before or after or 0)
        if name not in TRANSFORMS or (name == "bucket") != bool(buckets):
            raise ValueError(f"not a partition field: {part!r}")
        found.append(Transform(name, column, buckets))
    return found


def with_partitions(df: DataFrame, spec: Sequence[Transform]) -> DataFrame:
    """Add the derived columns. The source columns stay in the files, so values survive the folder names."""
    for field in spec:
        if field.column not in df.columns:
            raise ValueError(f"partition column {field.column!r} is not in the table")
        df = df.withColumn(field.derived, field.of(F.col(field.column)))
    return df


def write_partitioned(df: DataFrame, path: str, spec: Sequence[Transform]) -> None:
    """Write `df`, into folders if there is a spec.

    The rebalance hint gathers a partition's rows into few files and lets AQE split the one that holds most of the table.
    """
    if not spec:
        df.write.parquet(path)
        return
    derived = [field.derived for field in spec]
    with_partitions(df, spec).hint("rebalance", *derived).write.partitionBy(*derived).parquet(path)


Condition = tuple[str, str, Any]
_COMPARE = {
    "=": lambda a, b: a == b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def pruned(df: DataFrame, spec: Sequence[Transform], where: Sequence[Condition]) -> DataFrame:
    """Filter by (column, operator, value) conditions and repeat each one on the derived columns, which prunes folders.

    The time transforms keep order, so a bound on the column gives a bound (never strict) on the folder. A folder with no
    value stays in, since empty text is written as none.
    """
    for column, op, value in where:
        values = list(value) if op == "in" else [value]
        literals = [F.lit(v).cast(df.schema[column].dataType) for v in values]
        source = F.col(column)
        df = df.filter(source.isin(*literals) if op == "in" else _COMPARE[op](source, literals[0]))
        for field in spec:
            if field.column != column:
                continue
            folder = F.col(field.derived)
            bounds = [field.of(literal) for literal in literals]
            if op in ("=", "in"):
                df = df.filter(folder.isin(*bounds) | folder.isNull())
            elif field.name != "bucket":
                loose = _COMPARE[op if op.endswith("=") else op + "="]
                df = df.filter(loose(folder, bounds[0]) | folder.isNull())
    return df


# The comparisons an overwrite filter may hold, by the names Spark's parser gives them.
_ALLOWED = ("EqualTo", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual")
_QUOTED = re.compile(r"'(?:[^']|'')*'")
# Read by Spark as the same tree as something allowed.
_LOOSE = re.compile(r"\bNOT\b(?!\s+IN\b)|\bBETWEEN\b|[=<>]\s*\(", re.IGNORECASE)


def check_overwrite_filter(text: str, partition_columns: Sequence[str], df: DataFrame | None = None) -> str:
    """Accept only comparisons, IN and NOT IN of partition columns with literals, joined by AND and OR.

    Spark parses the text; with `df`, it also analyses it against the columns of `df`.
    """
    if not partition_columns:
        raise ValueError("an overwrite filter needs partitioned_by")
    spark = df.sparkSession if df is not None else SparkSession.builder.getOrCreate()
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    except Exception as error:  # whatever the parser says
        raise ValueError(f"overwrite filter: Spark cannot read {text!r}") from error

    def check(node: Any) -> None:
        kind, children = node.getClass().getSimpleName(), node.children()
        inner = [children.apply(i) for i in range(children.size())]
        if kind in ("And", "Or"):
            for x in inner:
                check(x)
            return
        if kind == "Not":  # of what `!=`, `<>` and NOT IN stand for
            node, kind = inner[0], inner[0].getClass().getSimpleName()
            children = node.children()
            inner = [children.apply(i) for i in range(children.size())]
            if kind not in ("EqualTo", "In"):
                raise ValueError(f"overwrite filter: {node.sql()} is not a comparison")
        if kind not in (*_ALLOWED, "In"):
            raise ValueError(f"overwrite filter: {node.sql()} is not a comparison of a partition column with literals")
        column, *values = inner
        if column.getClass().getSimpleName() != "UnresolvedAttribute" or column.name() not in partition_columns:
            raise ValueError(f"overwrite filter: {column.sql()} is not a partition column")
        for value in values:
            if value.getClass().getSimpleName() != "Literal" or value.value() is None:
                raise ValueError(f"overwrite filter: {value.sql()} is not a literal")

    check(parsed)
    if _LOOSE.search(_QUOTED.sub("''", text)):
        raise ValueError("overwrite filter: only comparisons, IN and NOT IN are allowed")
    if df is not None:
        where(df, text)
    return text
