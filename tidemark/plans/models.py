"""Models chained by input names, run as one lazy Spark plan per output and published together."""

from __future__ import annotations

import datetime as dt
import inspect
import re
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter
from pathlib import Path
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.params import Parameter, resolve
from tidemark.operators.quality import Check, ExpectationFailed, run_expectation, run_suite
from tidemark.plans import contracts
from tidemark.plans.versions import Lake
from tidemark.sinks.export import dry_run, preview
from tidemark.sources.scan import query, scan

SUMMARY = (
    "model string, strategy string, started timestamp, ended timestamp, outcome string, rows bigint, problems array<string>"
)

_DIRECTIVE = re.compile(r"^\s*--\s*tidemark:\s*([\w-]+)\s*=\s*(.*?)\s*$", re.MULTILINE)
_QUIET = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'", re.DOTALL)
_DIRECTIVES = ("name", "materialization_strategy", "partitioned_by", "output_schema", "overwrite_filter")


# A name after FROM, JOIN or a comma, neither a function nor the qualifier of a column.
_READS = re.compile(r"(?:\b(?:FROM|JOIN)\b|,)[\s(]*(?:LATERAL\b\s*)?(?!SELECT\b|LATERAL\b)(`?[A-Za-z_]\w*\b`?)(?!\s*[(.])", re.IGNORECASE)


def relations(sql: str) -> set[str]:
    """Names a statement may read from; an alias given by AS, a column behind a dot or a function of the same name is none.

    A name that WITH defines counts, since its own definition may read a table of that name.
    """
    return {name.strip("`") for name in _READS.findall(_QUIET.sub(" ", sql))}


class RunFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Input:
    """A parent of a model: another model or a lake table, with the columns and rows of it the model needs."""

    name: str
    columns: Sequence[str] | None = None
    filter: str | None = None
    ref: Any = None
    projection: Sequence[contracts.Field] | None = None


@dataclass
class Model:
    """Tables in, one table out. `build` takes the inputs, and any parameters it names, as keyword arguments."""

    name: str
    build: Callable[..., DataFrame] | None = None
    inputs: Mapping[str, Input] = field(default_factory=dict)
    sql: str | None = None
    columns: Sequence[str] | None = None
    schema: Sequence[contracts.Field] | None = None
    strategy: str = "NONE"
    partitioned_by: str | Sequence[str] = ()
    overwrite_filter: str | None = None
    origin: str = ""

    def parents(self, known: set[str]) -> set[str]:
        if self.sql is None:
            return {parent.name for parent in self.inputs.values()} & known
        return (relations(self.sql) & known) - {self.name}


@dataclass
class Expectation:
    """A check on a model or table: a function from DataFrame to boolean, or prepared checks that run in one pass."""

    on: str
    function: Callable[[DataFrame], Any] | None = None
    checks: Sequence[Check] = ()
    columns: Sequence[str] | None = None
    name: str = ""


def sql_model(path: str | Path, schemas: Mapping[str, Sequence[contracts.Field]] | None = None) -> Model:
    """A model from a `.sql` file: named after the file, with `-- tidemark: key=value` header lines overriding."""
    path = Path(path)
    return sql_text_model(path.stem, path.read_text(), schemas, str(path))


def sql_text_model(
    name: str, text: str, schemas: Mapping[str, Sequence[contracts.Field]] | None = None, origin: str = ""
) -> Model:
    settings = {}
    for key, value in _DIRECTIVE.findall(text):
        key = key.replace("-", "_")
        if key not in _DIRECTIVES:
            raise ValueError(f"{origin or name}: unknown directive {key!r}")
        settings[key] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    schema = None
    if "output_schema" in settings:
        if settings["output_schema"] not in (schemas or {}):
            raise ValueError(f"{origin or name}: no schema named {settings['output_schema']}")
        schema = schemas[settings["output_schema"]]
    return Model(
        settings.get("name", name),
        sql=text,
        schema=schema,
        strategy=settings.get("materialization_strategy", "NONE"),
        partitioned_by=settings.get("partitioned_by", ()),
        overwrite_filter=settings.get("overwrite_filter"),
        origin=origin,
    )


def ordered(models: Sequence[Model], lake_names: set[str]) -> list[Model]:
    """Models after their parents. A name defined twice, or one that shadows its own lake input, is an error."""
    by_name: dict[str, Model] = {}
    for model in models:
        if model.name in by_name:
            raise ValueError(f"duplicate definition of {model.name!r}")
        by_name[model.name] = model
    for model in models:
        own = model.sql is not None and model.name in relations(model.sql)
        if any(parent.name == model.name for parent in model.inputs.values()) or (own and model.name in lake_names):
            raise ValueError(f"{model.name!r} reads itself")
        for parent in model.inputs.values():
            if parent.name not in by_name and parent.name not in lake_names:
                raise ValueError(f"{model.name}: no model or table named {parent.name!r}")
    graph = {model.name: model.parents(set(by_name)) for model in models}
    try:
        return [by_name[name] for name in TopologicalSorter(graph).static_order()]
    except CycleError as error:
        raise ValueError(f"models form a cycle: {' -> '.join(error.args[1])}") from error


@dataclass
class Run:
    """What a run did: `summary` rows, output frames by model name, previews, expectation outcomes, version published."""

    summary: DataFrame
    outputs: dict[str, DataFrame]
    previews: dict[str, DataFrame]
    expectations: list[tuple[str, bool, str]]
    version: int | None
    succeeded: bool = True


def run(
    spark: SparkSession,
    models: Sequence[Model],
    tables: Mapping[str, DataFrame | str] | None = None,
    *,
    lake: Lake | None = None,
    expectations: Sequence[Expectation] = (),
    declared: Sequence[Parameter] = (),
    params: Mapping[str, Any] | None = None,
    strict: bool = False,
    dry: bool = False,
    transaction: bool = True,
    preview_mode: str = "off",
    cache: bool = True,
    message: str = "",
    stop: bool = True,
) -> Run:
    """Build every model, check it, and publish what is to be kept.

    Models are composed lazily. A model that is kept is written once and read back by the models after it; one that is not, but
    has two or more readers, is persisted unless `cache` is off. Broken contracts and
    failing expectations warn, or stop the run before anything is published when `strict`. With `transaction` all outputs
    appear in one version.

    A model that fails, while it is built or while its rows are written, is `failed` in the summary and those after it are
    `skipped`; nothing of a transaction is published. The error has that state as its `run`; without `stop` the state is returned.
    """
    values = resolve(list(declared), params or {})
    record = lake.record()["tables"] if lake else {}
    sources: dict[str, DataFrame | str] = dict(tables or {})
    # tables of the lake are opened by what is asked of them, so that filters decide which folders are read
    stored = [name for name in record if name not in sources]
    for name in stored:
        sources[name] = lake.read(name)
    produced = {model.name for model in models}
    plan = ordered(models, set(sources) - produced | {n for n in sources if n in produced and n not in record})
    readers: dict[str, int] = {}
    for model in plan:
        for parent in model.parents(produced):
            readers[parent] = readers.get(parent, 0) + 1
    for expectation in expectations:
        readers[expectation.on] = readers.get(expectation.on, 0) + 1

    built: dict[str, DataFrame] = {}
    held: list[DataFrame] = []
    rows: list[tuple] = []
    staged: dict[str, Any] = {}
    outcomes: list[tuple[str, bool, str]] = []
    previews: dict[str, DataFrame] = {}
    based_on = (lake.versions() or [0])[-1] if lake else 0
    version = None

    def fail(text: str) -> None:
        if strict:
            raise RunFailed(text)
        warnings.warn(text, stacklevel=2)

    def give(parent: Input) -> DataFrame:
        filtered = lambda source: scan(spark, source, filters=parent.filter, params=values)
        if parent.name in built:
            df = filtered(built[parent.name])
        elif parent.ref is not None:
            df = lake.scan(parent.name, at=parent.ref, filters=parent.filter, params=values)
        elif parent.name in stored:
            df = lake.narrowed({parent.name: record[parent.name]}, lambda opened: filtered(opened[parent.name]))
        else:
            df = filtered(sources[parent.name])
        if parent.projection is not None:
            df = contracts.project(df, parent.projection)
        if parent.columns is None or list(parent.columns) == ["*"]:
            return df
        return scan(spark, df, columns=parent.columns)

    def lake_query(sql: str, own: dict[str, DataFrame | str], names: list[str]) -> DataFrame:
        if not names:
            return query(spark, sql, tables=own, params=values)
        entries = {name: record[name] for name in names}
        return lake.narrowed(entries, lambda opened: query(spark, sql, tables={**own, **opened}, params=values))

    def check_nulls(model: Model, df: DataFrame) -> list[str]:
        found = contracts.null_problems(df, model.schema) if model.schema is not None else []
        if found:
            fail(f"{model.name}: {'; '.join(found)}")
        return found

    def check_expectations(on: str, df: DataFrame) -> None:
        for expectation in [e for e in expectations if e.on == on]:
            target = df if expectation.columns is None else df.select(*expectation.columns)
            label = expectation.name or getattr(expectation.function, "__name__", "checks")
            if expectation.function is not None:
                try:
                    passed, text = run_expectation(target, expectation.function)
                except TypeError as error:
                    passed, text = False, str(error)
                outcomes.append((label, passed, text))
            for row in run_suite(target, list(expectation.checks)).collect() if expectation.checks else []:
                text = "" if row["passed"] else f"{row['check']}({row['column']}) failed"
                outcomes.append((f"{row['check']}({row['column']})", row["passed"], text))
        broken = [f"{label}: {text}" for label, passed, text in outcomes if not passed]
        if broken and strict:
            raise ExpectationFailed("; ".join(broken))

    try:
        for place, model in enumerate(plan):
            started = dt.datetime.now(dt.timezone.utc)
            try:
                inputs = {key: give(parent) for key, parent in model.inputs.items()}
                if model.sql is not None:
                    used = model.parents(set(sources) | set(built))
                    own = {n: built.get(n, sources.get(n)) for n in used if n in built or n not in stored}
                    df = lake_query(model.sql, own, [n for n in used if n not in own])
                else:
                    wanted = inspect.signature(model.build).parameters
                    df = model.build(**inputs, **{k: v for k, v in values.items() if k in wanted and k not in inputs})
                if not isinstance(df, DataFrame):
                    raise RunFailed(f"{model.name} returned {type(df).__name__}, not a DataFrame")
                problems = contracts.column_problems(df, model.columns)
                if model.schema is not None:
                    named = {parent.name: inputs[key] for key, parent in model.inputs.items()}
                    problems += contracts.check_contract(df, model.schema, named or None, read=False)
                if problems:
                    fail(f"{model.name}: {'; '.join(problems)}")
                count = None
                if model.strategy.upper() != "NONE" and not dry and lake is not None:
                    entry = lake.stage(
                        model.name,
                        df,
                        model.strategy.upper(),
                        model.partitioned_by,
                        model.overwrite_filter,
                        tables={**record, **staged},
                    )
                    staged[model.name] = entry
                    # from here on the rows as written: audited, counted (from file footers) and read by the next models
                    df = lake._open({**entry, "parts": entry["parts"][-1:]})
                    count = df.count()
                    problems += check_nulls(model, df)
                    check_expectations(model.name, df)
                    if not transaction:
                        based_on = version = lake.commit_staged({model.name: entry}, based_on, message or f"run {model.name}")
                else:
                    if readers.get(model.name, 0) > 1 and cache:
                        df = df.persist(StorageLevel.MEMORY_AND_DISK)
                        held.append(df)
                    problems += check_nulls(model, df)
                    if dry and not any(model.name in other.parents(produced) for other in plan):
                        dry_run(df)
                    check_expectations(model.name, df)
                built[model.name] = df
                shown = preview(df, preview_mode, key=df.columns if preview_mode == "tail" else None)
                if shown is not None:
                    previews[model.name] = shown
                ended = dt.datetime.now(dt.timezone.utc)
                outcome = "problems" if problems else "succeeded"
                rows.append((model.name, model.strategy.upper(), started, ended, outcome, count, problems))
            except Exception as error:
                ended, told = dt.datetime.now(dt.timezone.utc), f"{type(error).__name__}: {error}"
                rows.append((model.name, model.strategy.upper(), started, ended, "failed", None, [told]))
                rows += [(later.name, later.strategy.upper(), None, None, "skipped", None, []) for later in plan[place + 1 :]]
                state = Run(spark.createDataFrame(rows, SUMMARY), built, previews, outcomes, version, succeeded=False)
                if not stop:
                    return state
                error.run = state
                raise
        for name in {e.on for e in expectations} - set(built):
            source = sources[name]
            check_expectations(name, scan(spark, source))
        failed = [f"{label}: {text}" for label, passed, text in outcomes if not passed]
        if failed:
            fail("; ".join(failed))
        if staged and transaction:
            version = lake.commit_staged(staged, based_on, message or f"run {', '.join(staged)}")
    finally:
        for df in held:
            df.unpersist()
    return Run(spark.createDataFrame(rows, SUMMARY), built, previews, outcomes, version)
