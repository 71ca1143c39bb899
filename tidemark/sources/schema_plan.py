"""Planning one table out of many Parquet, CSV or JSON-lines files.

Footers, or all rows of text files (`text_shapes`), are read on the executors; what reaches the driver is one row per column and
type, and one per distinct file schema. Types are Spark DDL names. Nanosecond timestamps have no Spark type and are reported as `timestamp_ns`, to be
resolved by hand.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import widens
from tidemark.functions.times import spark_pattern
from tidemark.sinks.partitions import Transform, partition_spec
from tidemark.session import written
from tidemark.sources.files import list_files
from tidemark.sources.text_shapes import csv_shapes, escaped, jsonl_shapes, merge_types, merged, read_csv

# The formats a plan reads, and the names of their files.
SUFFIXES = {"parquet": "*.parquet", "csv": "*.csv", "jsonl": "*.{jsonl,json}"}
FOOTER = "path string, length bigint, position int, column string, type string, error string"
NANOS = "timestamp_ns"
FILES_PER_LOAD = 10_000


class UnreadableFile(RuntimeError):
    """A file whose footer cannot be read."""


class SchemaConflict(ValueError):
    """The files disagree on a column's type and nobody has decided yet."""


def footers(files: DataFrame) -> DataFrame:
    """One row per file and column with its type; an unreadable file is one row with `error` set."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        def name(kind: pa.DataType) -> str:
            if pa.types.is_timestamp(kind) and kind.unit == "ns":
                return NANOS
            return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()

        stores: dict[tuple[str, str], pafs.FileSystem] = {}

        def located(path: str) -> tuple[pafs.FileSystem, str]:
            """The store of an unescaped path, and the path in it. Trouble with the store itself fails the job."""
            scheme, colon, rest = path.partition(":")
            if not colon or "/" in scheme:
                scheme, rest = "file", path
            host, tail = "", rest
            if rest.startswith("//"):
                host, _, tail = rest[2:].partition("/")
                tail = f"/{tail}"
            scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
            if (scheme, host) not in stores:
                store = pafs.LocalFileSystem() if scheme == "file" else pafs.FileSystem.from_uri(f"{scheme}://{host}/")[0]
                stores[scheme, host] = store
            return stores[scheme, host], host + tail if scheme in ("s3", "gs", "gcs") else tail

        # slices of 256 files keep the answer small; nothing here needs this package on the executors
        for batch in (b.iloc[i : i + 256] for b in batches for i in range(0, len(b), 256)):
            found = []
            for path, length in zip(batch["path"], batch["length"]):
                store, inner = located(path)
                try:
                    with store.open_input_file(inner) as handle:
                        schema = pq.read_schema(handle)
                    found += [(path, length, i, f.name, name(f.type), None) for i, f in enumerate(schema)]
                except Exception as problem:  # a bad file is a result here, not a failure
                    found.append((path, length, None, None, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(found, columns=["path", "length", "position", "column", "type", "error"]).astype(
                {"position": "Int32", "length": "int64"}
            )

    return files.select("path", "length").mapInPandas(read, FOOTER)


def column_types(footer: DataFrame) -> DataFrame:
    """One row per column: the types seen, the number of files that have it, and whether the files disagree."""
    seen = footer.filter(F.col("error").isNull()).groupBy("column", "type").agg(
        F.count(F.lit(1)).alias("files"), F.min("position").alias("position")
    )
    return seen.groupBy("column").agg(
        F.min("position").alias("position"),
        F.array_sort(F.collect_list("type")).alias("types"),
        F.sum("files").alias("files"),
        ((F.count(F.lit(1)) > 1) | (F.max("type") == NANOS) & (F.min("type") == NANOS)).alias("conflict"),
    )


@dataclass(frozen=True)
class PlannedColumn:
    """A column of the table to be: the types found, and the one chosen (None while in conflict)."""

    name: str
    found: tuple[str, ...]
    chosen: str | None
    parse_format: str | None = None
    truncate_nanos: bool = False


@dataclass(frozen=True)
class TablePlan:
    columns: tuple[PlannedColumn, ...]
    partitioned_by: tuple[str, ...] = field(default=())

    @property
    def conflicts(self) -> list[str]:
        return [column.name for column in self.columns if column.chosen is None]

    @property
    def can_auto_apply(self) -> bool:
        return not self.conflicts

    def resolve(self, choices: Mapping[str, str | Mapping[str, Any]]) -> TablePlan:
        """Choose or override types.

        A choice is a type name or a dict with `datatype` and, for timestamps, `timezone` and `parse_format` (strptime
        style). The types found stay as they are. `truncate_nanos` accepts microseconds for a nanosecond column.
        """
        unknown = set(choices) - {column.name for column in self.columns}
        if unknown:
            raise ValueError(f"not in the plan: {', '.join(sorted(unknown))}")
        columns = []
        for column in self.columns:
            if column.name in choices:
                choice = choices[column.name]
                choice = {"datatype": choice} if isinstance(choice, str) else dict(choice)
                truncate = bool(choice.get("truncate_nanos"))
                if (NANOS in column.found or choice.get("unit") == "ns") and not truncate:
                    raise ValueError(f"{column.name}: Spark keeps microseconds; pass truncate_nanos to accept that")
                column = replace(
                    column,
                    chosen=_ddl(choice),
                    parse_format=choice.get("parse_format"),
                    truncate_nanos=truncate,
                )
            columns.append(column)
        return replace(self, columns=tuple(columns))

    def document(self) -> dict[str, Any]:
        """The plan as plain values, to be stored as JSON or YAML, edited and read back with `from_document`."""
        return {
            "columns": [{**asdict(column), "found": list(column.found)} for column in self.columns],
            "partitioned_by": list(self.partitioned_by),
        }

    @classmethod
    def from_document(cls, document: Mapping[str, Any]) -> TablePlan:
        """The plan of an edited document. Types chosen there are checked as `resolve` checks them; null stays a conflict."""
        columns = tuple(PlannedColumn(c["name"], tuple(c.get("found") or ()), None) for c in document["columns"])
        choices = {
            c["name"]: {
                "datatype": c["chosen"],
                "timezone": "UTC" if c["chosen"].lower() == "timestamp" else None,
                "parse_format": c.get("parse_format"),
                "truncate_nanos": c.get("truncate_nanos"),
            }
            for c in document["columns"]
            if c.get("chosen")
        }
        spec = partition_spec(document.get("partitioned_by") or [])
        unknown = {f.column for f in spec} - {c.name for c in columns}
        if unknown:
            raise ValueError(f"partition column not in the plan: {', '.join(sorted(unknown))}")
        return cls(columns, _fields(spec)).resolve(choices)

    def schema(self) -> T.StructType:
        if self.conflicts:
            raise SchemaConflict(f"plan has schema conflicts: {', '.join(self.conflicts)}; resolve them first")
        return T.StructType(
            [T.StructField(c.name, T._parse_datatype_string(c.chosen), True) for c in self.columns]
        )


def _fields(spec: Sequence[Transform]) -> tuple[str, ...]:
    return tuple(f"{f.name}({f.buckets}, {f.column})" if f.buckets else f"{f.name}({f.column})" for f in spec)


def _ddl(choice: Mapping[str, Any]) -> str:
    kind = choice["datatype"].lower()
    if kind == "timestamp":
        return "timestamp" if choice.get("timezone") else "timestamp_ntz"
    return T._parse_datatype_string("bigint" if kind == "long" else kind).simpleString()


def plan_table(
    spark: SparkSession,
    patterns: str | Sequence[str],
    partitioned_by: str | Sequence[str] = (),
    continue_on_error: bool = False,
    fmt: str = "parquet",
) -> TablePlan:
    """Infer a table from all files of a format; columns are united by name, in the order of the files.

    Parquet files must agree on a column's type. Text has no types of its own, so numbers of different width agree on the widest,
    and so do dates and times without zone; anything else is a conflict.

    An unreadable file is an error unless `continue_on_error`, which plans from the others and warns.
    """
    fields = _fields(partition_spec(partitioned_by) if partitioned_by else [])
    try:
        files = listed(spark, patterns, fmt)
    except AnalysisException as error:
        raise FileNotFoundError(f"no file under {patterns}") from error
    footer = written(shapes(files, fmt), "footers")
    found = column_types(footer).orderBy("position", "column").collect()
    check_readable(footer, continue_on_error)
    if not found:
        raise FileNotFoundError(f"no readable {fmt} file under {patterns}")

    def agreed(row: Any) -> str | None:
        if fmt != "parquet":
            return merge_types(row["types"])
        return None if row["conflict"] else row["types"][0]

    columns = tuple(PlannedColumn(row["column"], tuple(row["types"]), agreed(row)) for row in found)
    return TablePlan(columns, fields)


def listed(spark: SparkSession, patterns: str | Sequence[str], fmt: str) -> DataFrame:
    """The files of a format below the patterns."""
    if fmt not in SUFFIXES:
        raise ValueError(f"unsupported format {fmt!r}; choose one of {', '.join(SUFFIXES)}")
    return list_files(spark, patterns, SUFFIXES[fmt])


def shapes(files: DataFrame, fmt: str, typed: bool = True) -> DataFrame:
    """Columns and types of files, as `footers` gives them. A JSON-lines file without rows has none and does not appear.

    CSV is read as text and then cast, so a reader that has been told the types can leave them out with `typed`.
    """
    if fmt == "parquet":
        return footers(_spread(files))
    files = written(files.select("path", "length"), "listing")
    found = csv_shapes(files, typed) if fmt == "csv" else jsonl_shapes(files)
    return files.join(found, "path").select("path", "length", "position", "column", "type", "error")


def check_readable(footer: DataFrame, continue_on_error: bool) -> None:
    """Raise at a file whose footer cannot be read, or say how many there are."""
    bad = footer.filter(F.col("error").isNotNull()).select("path", "error")
    first = bad.first()
    if first is None:
        return
    if not continue_on_error:
        raise UnreadableFile(f"{first['path']}: {first['error']}")
    warnings.warn(f"left out {bad.count()} unreadable files, {first['path']} among them", stacklevel=3)


def _spread(files: DataFrame) -> DataFrame:
    """Footer reads are many small requests: share them out evenly over the cores."""
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path")


Shape = dict[str, str]


def file_loads(footer: DataFrame, files_per_load: int = FILES_PER_LOAD) -> Iterator[tuple[Shape, list[str]]]:
    """Readable files of one physical schema at a time, at most `files_per_load`: (types by column, paths).

    The driver holds the paths of one load, which it needs to plan the scan, and never those of the whole import.
    """
    shape = F.array_sort(F.collect_list(F.struct("position", "column", "type"))).alias("shape")
    per_file = footer.filter(F.col("error").isNull()).groupBy("path").agg(shape)
    ordered = per_file.withColumn("key", F.to_json("shape")).orderBy("key", "path")
    key, types, paths = None, {}, []
    for row in ordered.toLocalIterator():
        if paths and (row["key"] != key or len(paths) >= files_per_load):
            yield types, paths
            paths = []
        key, types = row["key"], {cell["column"]: cell["type"] for cell in row["shape"]}
        paths.append(row["path"])
    if paths:
        yield types, paths


def _stored_type(kind: str) -> T.DataType:
    return T.StringType() if kind == "void" else T._parse_datatype_string(kind)


def _as(column: PlannedColumn, stored: str, target: T.DataType) -> Column:
    value = F.col(column.name)
    if stored == NANOS:  # read as a count of nanoseconds
        micros = F.timestamp_micros(F.floor(value / 1000).cast("long"))
        return micros.cast(target)
    if column.parse_format and isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        text, pattern = value.cast("string"), F.lit(spark_pattern(column.parse_format))
        if isinstance(target, T.TimestampNTZType):
            return F.to_timestamp_ntz(text, pattern)
        return F.to_timestamp_ltz(text, pattern)
    return value.cast(target)


def read_planned(
    spark: SparkSession,
    loads: Iterable[tuple[Shape, list[str]]],
    plan: TablePlan,
    best_effort: bool = False,
    lossless: bool = False,
    fmt: str = "parquet",
) -> Iterator[DataFrame]:
    """The loads as frames of the planned table: each read with its own schema, then cast.

    A column the plan lacks is an error unless `best_effort`; a planned column a file lacks is null. With `lossless` a file
    whose type the planned one does not hold in full is a conflict.
    """
    schema = plan.schema()
    planned = {column.name: column for column in plan.columns}
    for stored, paths in loads:
        extra = [name for name in stored if name not in planned]
        if extra and not best_effort:
            raise SchemaConflict(f"the table has no column {', '.join(extra)}; use best_effort to ignore them")
        used = [name for name in stored if name in planned]
        physical = T.StructType(
            [
                T.StructField(name, T.LongType() if stored[name] == NANOS else _stored_type(stored[name]))
                for name in used
            ]
        )

        def holds(name: str) -> bool:
            wanted = schema[name].dataType
            return widens(physical[name].dataType, wanted) or (
                fmt != "parquet" and merged(stored[name], wanted.simpleString()) == wanted.simpleString()
            )

        narrowed = [n for n in used if stored[n] == NANOS or not holds(n)]
        if lossless and narrowed:
            kinds = ", ".join(f"{n} ({stored[n]} into {schema[n].dataType.simpleString()})" for n in narrowed)
            raise SchemaConflict(f"{paths[0]}: a plan must say how to convert {kinds}")
        if fmt == "csv":  # values as text, cast below
            df = read_csv(spark, list(stored), paths)
        else:
            reader = spark.read.schema(physical)
            df = reader.parquet(*paths) if fmt == "parquet" else reader.option("mode", "FAILFAST").json([escaped(p) for p in paths])
        columns = [
            _as(planned[f.name], stored[f.name], f.dataType) if f.name in stored else F.lit(None).cast(f.dataType)
            for f in schema
        ]
        yield df.select(*[column.alias(f.name) for column, f in zip(columns, schema)])


def read_files_as(
    spark: SparkSession,
    patterns: str | Sequence[str],
    plan: TablePlan,
    best_effort: bool = False,
    continue_on_error: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """All files of a format below the patterns as one table of the planned schema.

    An unreadable file is an error unless `continue_on_error`, which warns and reads the others.
    """
    footer = written(shapes(listed(spark, patterns, fmt), fmt, typed=False), "footers")  # sorted below: read each footer once
    check_readable(footer, continue_on_error)
    empty = spark.createDataFrame([], plan.schema())
    return reduce(DataFrame.unionByName, read_planned(spark, file_loads(footer), plan, best_effort, fmt=fmt), empty)

