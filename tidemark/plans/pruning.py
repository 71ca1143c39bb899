"""Hidden partition pruning: filters on a table's own columns decide which partition folders are read.

Catalyst pushes filters through projections, joins and aggregates down to the scans. What has arrived there is carried over to the
derived partition columns (`sinks.partitions`): the time transforms keep order, so a bound on the column bounds the folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.partitions import Transform

_COMPARISONS = {"EqualTo": "=", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}
_TURNED = {"=": "=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
_LONG_LISTS = "spark.sql.optimizer.inSetConversionThreshold"


def _kind(node: Any) -> str:
    return node.getClass().getSimpleName()


def _items(sequence: Any) -> list[Any]:
    return [sequence.apply(i) for i in range(sequence.size())]


@contextmanager
def _plain_lists(spark: SparkSession) -> Iterator[None]:
    """Long IN lists stay lists of literals while a plan is looked at."""
    before = spark.conf.get(_LONG_LISTS)
    spark.conf.set(_LONG_LISTS, str(2**31 - 1))
    try:
        yield
    finally:
        spark.conf.set(_LONG_LISTS, before)


def pushed_filters(df: DataFrame) -> dict[frozenset[str], list[list[Any]]]:
    """For each set of folders that `df` scans, the filters (Catalyst expressions) right above every scan of it.

    Scans inside subqueries count too. A scan without filters has an empty list.
    """
    spark = df.sparkSession
    operation = spark._jvm.org.apache.spark.sql.catalyst.planning.PhysicalOperation
    found: dict[frozenset[str], list[list[Any]]] = {}

    def visit(plan: Any) -> None:
        match = operation.unapply(plan)
        filters, below = (_items(match.get()._2()), match.get()._3()) if match.isDefined() else ([], plan)
        if _kind(below) == "LogicalRelation":
            relation = below.relation()
            if _kind(relation) == "HadoopFsRelation":
                paths = frozenset(p.toString() for p in _items(relation.location().rootPaths()))
                found.setdefault(paths, []).append(filters)
            return
        for child in _items(below.children()):
            visit(child)

    with _plain_lists(spark):
        # a frame keeps the plan it was first optimized to, so look at a fresh copy of it
        plan = spark._jsparkSession.sessionState().executePlan(df._jdf.queryExecution().analyzed(), _default_mode(spark)).optimizedPlan()
    visit(plan)
    for inner in _items(plan.subqueriesAll()):
        visit(inner)
    return found


def _default_mode(spark: SparkSession) -> Any:
    return spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()


def _source(node: Any) -> tuple[str, str] | None:
    """(column, how) for a column itself, its date, or its year."""
    if _kind(node) == "AttributeReference":
        return node.name(), "value"
    inner = _items(node.children())
    below = _source(inner[0]) if len(inner) == 1 else None
    if below is None:
        return None
    if _kind(node) == "Cast" and node.dataType().typeName() == "date" and below[1] == "value":
        return below[0], "date"
    return (below[0], "year") if _kind(node) == "Year" else None


def _literal(node: Any) -> Column | None:
    return F.expr(node.sql()) if _kind(node) == "Literal" and node.value() is not None else None


def folder_condition(condition: Any, spec: Sequence[Transform], types: dict[str, Any]) -> Column | None:
    """What a filter on source columns says about the derived columns; None if nothing.

    Rows for which the filter is true are in folders for which the result is true. `types` has the columns' types.
    """
    kind, inner = _kind(condition), _items(condition.children())
    if kind in ("And", "Or"):
        sides = [folder_condition(x, spec, types) for x in inner]
        if kind == "Or":
            return None if any(x is None for x in sides) else sides[0] | sides[1]
        known = [x for x in sides if x is not None]
        return known[0] & known[1] if len(known) == 2 else known[0] if known else None
    if kind == "In":
        source, values = _source(inner[0]), [_literal(x) for x in inner[1:]]
        operator = "="
    elif kind in _COMPARISONS:
        operator, (left, right) = _COMPARISONS[kind], inner
        if _source(left) is None:
            left, right, operator = right, left, _TURNED[operator]
        source, values = _source(left), [_literal(right)]
    else:
        return None
    if source is None or any(v is None for v in values):
        return None
    column, how = source
    whole = None
    for field in spec:
        if field.column != column or (field.name == "bucket" and (operator != "=" or how != "value")):
            continue
        own = None
        for value in values:
            one = _on_folder(field, how, operator, value.cast(types[column]) if how == "value" else value)
            own = one if own is None else own | one
        # a folder without a value stays in, since empty text is written as none
        own = own | F.col(field.derived).isNull()
        whole = own if whole is None else whole & own
    return whole


def _on_folder(field: Transform, how: str, operator: str, value: Column) -> Column:
    folder = F.col(field.derived)
    if field.name == "identity":
        own = {"value": folder, "date": folder.cast("date"), "year": F.year(folder)}[how]
        return {"=": own == value, "<": own < value, "<=": own <= value, ">": own > value, ">=": own >= value}[operator]
    low = high = value
    if how == "year":
        low, high = F.make_date(value, F.lit(1), F.lit(1)), F.make_date(value, F.lit(12), F.lit(31))
    if how != "value" and field.name == "hour":
        high = high.cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS")
    if operator == "=":
        return folder == field.of(low) if how == "value" else folder.between(field.of(low), field.of(high))
    # a strict bound on the column is a loose one on the folder
    return {"<": folder <= field.of(low), "<=": folder <= field.of(high), ">": folder >= field.of(low), ">=": folder >= field.of(low)}[operator]


def any_of(scans: Sequence[Sequence[Any]], spec: Sequence[Transform], types: dict[str, Any]) -> Column | None:
    """Folders that any of several scans of the same table needs; None for all of them."""
    needed = None
    for filters in scans:
        own = None
        for condition in filters:
            one = folder_condition(condition, spec, types)
            if one is not None:
                own = one if own is None else own & one
        if own is None:
            return None
        needed = own if needed is None else needed | own
    return needed
