"""Columns and types of CSV and JSON-lines files, from all their rows.

Text has no declared types, so each value has the narrowest type that holds it, and types are merged upwards:

    void < int < bigint < decimal < double < string        void < date < timestamp_ntz < string
    void < boolean < string                                void < timestamp < string

One aggregation per group of files finds, for each file and column, whether all values are of a kind; the same order merges files
(`merged`). A number with needless leading zeros is text, since its digits would be lost. Rows come out as those of
`schema_plan.footers`.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import written

FILES_PER_SCAN = 10_000
ROW = "path string, position int, column string, type string, error string"
BROKEN = "_broken_row"
# Which types a column of text may be of, narrowest first, and what its values then look like.
_PATTERNS = {
    "boolean": r"^(?i:true|false)$",
    "integer": r"^[+-]?(0|[1-9]\d*)$",
    "double": r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?Infinity$|^NaN$",
    "date": r"^\d{4}-\d\d-\d\d$",
    "timestamp_ntz": r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d:\d\d(\.\d{1,6})?)?$",
    "timestamp": r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:?\d\d)$",
}
_BITS = ("boolean", "int", "bigint", "integer", "double", "date", "timestamp_ntz", "timestamp")
_NUMBERS = ("int", "bigint", "decimal", "double")
_TIMES = ("date", "timestamp_ntz")


def file_path(uri: str = "_metadata.file_path") -> Column:
    """The path of a row's file as listings give it."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def merged(one: str, two: str) -> str | None:
    """The narrowest type that holds both in full; None where only text would."""
    if one == two or two == "void":
        return one
    if one == "void":
        return two
    for chain in (_NUMBERS, _TIMES):
        places = [chain.index(k) if (k := re.sub(r"\(.*", "", x)) in chain else None for x in (one, two)]
        if None not in places:
            wider = one if places[0] > places[1] else two
            if places[0] == places[1]:  # two decimals: the one of more digits
                wider = max(one, two, key=lambda x: int(re.search(r"\d+", x).group()))
            return wider
    return None


def merge_types(found: Sequence[str]) -> str | None:
    """One type for a column of several files; None if they disagree, text where all are empty."""
    kinds = list(found)
    out: str | None = "void"
    for kind in kinds:
        out = merged(out, kind) if out is not None else None
    return "string" if out == "void" else out


def text_code(value: Column) -> Column:
    """The types that hold a text value as bits, in the order of `_BITS`, and above them the digits of a whole number."""
    looks = {kind: value.rlike(pattern) for kind, pattern in _PATTERNS.items()}

    def bits(*kinds: str) -> int:
        return sum(1 << _BITS.index(kind) for kind in kinds)

    def fits(kind: str, where: str = "") -> Column:
        return F.when(value.try_cast(kind).isNotNull(), bits(where or kind)).otherwise(0)

    digits = F.length(value) - F.when(value.startswith("+") | value.startswith("-"), 1).otherwise(0)
    width = F.when(value.try_cast("int").isNotNull(), bits("int", "bigint")).otherwise(fits("bigint"))
    # a whole number looks like a double too, and a date like a time; otherwise a value looks like one kind at most
    code = (
        F.when(looks["integer"], F.lit(bits("integer", "double")) + width + digits * (1 << len(_BITS)))
        .when(looks["double"], bits("double"))
        .when(looks["boolean"], bits("boolean"))
        .when(looks["date"], fits("date") + fits("timestamp_ntz"))
        .when(looks["timestamp_ntz"], fits("timestamp_ntz"))
        .when(looks["timestamp"], fits("timestamp"))
        .otherwise(0)
    )
    return F.when(value.isNotNull(), code.cast("bigint"))


def text_type(code: Column) -> Column:
    """The narrowest type of a group's text values from their codes, as an aggregate."""
    shared, digits = F.bit_and(code), F.max(F.shiftright(code, len(_BITS)))
    every = {kind: shared.bitwiseAND(1 << i) > 0 for i, kind in enumerate(_BITS)}
    return (
        F.when(shared.isNull(), "void")
        .when(every["boolean"], "boolean")
        .when(every["int"], "int")
        .when(every["bigint"], "bigint")
        .when(every["integer"] & (digits <= 38), F.concat(F.lit("decimal("), digits.cast("string"), F.lit(",0)")))
        .when(every["double"], "double")
        .when(every["date"], "date")
        .when(every["timestamp_ntz"], "timestamp_ntz")
        .when(every["timestamp"], "timestamp")
        .otherwise("string")
    )


def csv_columns(header: str) -> list[str]:
    names = [name.strip() for name in next(csv.reader([header]), [])]
    if not names or "" in names or len(set(names)) != len(names):
        raise ValueError(f"not a header of different names: {header!r}")
    return names


def read_csv(spark: SparkSession, names: Sequence[str], paths: Sequence[str], broken: str | None = None) -> DataFrame:
    """CSV files of one header as text columns; `broken` names a column for rows of another number of values."""
    fields = [T.StructField(name, T.StringType()) for name in [*names, *([broken] if broken else [])]]
    reader = spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
    reader = reader.option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE" if broken else "FAILFAST")
    if broken:
        reader = reader.option("columnNameOfCorruptRecord", broken)
    return reader.csv([escaped(p) for p in paths])


def escaped(path: str) -> str:
    """A listed path as a pattern that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _some_paths(files: DataFrame) -> Iterator[list[str]]:
    """The paths of so many files at a time as one scan takes; the driver never holds all of them."""
    held: list[str] = []
    for row in files.select("path").toLocalIterator():
        held.append(escaped(row["path"]))
        if len(held) >= FILES_PER_SCAN:
            yield held
            held = []
    if held:
        yield held


def _headers(files: DataFrame) -> Iterator[tuple[str, list[str]]]:
    """Each different first line with the files that open with it, some at a time."""
    spark = files.sparkSession
    for paths in _some_paths(files):
        lines = spark.read.text(paths)
        # the first line is in the first block, whatever else that holds
        first = lines.select(F.col("_metadata.file_path").alias("uri"), "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("block"))
        # two scans: the lowest number of each file, which no sort is needed for, then the lines of those numbers
        lowest = written(first.filter("block = 0").groupBy("uri").agg(F.min("at").alias("at")).select("at"), "lowest")
        first = first.join(F.broadcast(lowest), "at").select(file_path("uri").alias("path"), F.col("value").alias("header"))
        group: tuple[str, list[str]] | None = None
        for row in first.orderBy("header", "path").toLocalIterator():
            header = row["header"].lstrip("﻿")
            if group and group[0] != header:
                yield group
                group = None
            group = group or (header, [])
            group[1].append(row["path"])
        if group:
            yield group


def csv_shapes(files: DataFrame, typed: bool = True) -> DataFrame:
    """Columns and types of CSV files with a header line; a row longer or shorter than that is an error of its file.

    An empty file has neither and does not appear. Unless `typed` all columns are text, for readers that have been told the types.
    """
    spark = files.sparkSession
    found = [spark.createDataFrame([], ROW)]
    for header, paths in _headers(files):
        try:
            names = csv_columns(header)
        except ValueError as problem:
            found.append(spark.createDataFrame([(p, None, None, None, str(problem)) for p in paths], ROW))
            continue
        rows = read_csv(spark, names, paths, BROKEN)
        # by place, as names may hold dots
        rows = rows.select(F.col("_metadata.file_path").alias("uri"), *[F.col(f"`{n.replace('`', '``')}`").alias(f"c{i}") for i, n in enumerate([*names, BROKEN])])
        kinds = _kinds(rows, names, typed).withColumn("path", file_path("uri"))
        bare = spark.createDataFrame([(p,) for p in paths], "path string")  # a header alone has columns too
        kinds = bare.join(written(kinds, "kinds"), "path", "left")  # one reading of the files, all columns at once
        empty = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit("void" if typed else "string").alias("type")) for i, n in enumerate(names)])
        fine = kinds.filter("coalesce(broken, 0) = 0").select("path", F.inline(F.coalesce("columns", empty)))
        found.append(fine.withColumn("error", F.lit(None).cast("string")))
        bad = kinds.filter("broken > 0").select("path", F.concat(F.col("broken").cast("string"), F.lit(" rows do not fit the header")).alias("error"))
        found.append(bad.select("path", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("type"), "error"))
    return reduce(DataFrame.unionByName, found)


def _kinds(rows: DataFrame, names: Sequence[str], typed: bool) -> DataFrame:
    """The columns of each file (`uri`) of one header with their types, and its `broken` rows, from its values `c0`, `c1` and so on.

    The types of a row's values come from one function over an array, whose code is as small for many columns as for one: spelled out
    for each column it filled a method beyond 8 KB, which the JVM does not compile.
    """
    values, broken = [f"c{i}" for i in range(len(names))], F.col(f"c{len(names)}")
    if typed:
        coded = rows.select("uri", F.transform(F.array(*values), lambda value: text_code(value)).alias("codes"), broken.alias("broken"))
        kind, more = [text_type(F.get("codes", F.lit(i))) for i in range(len(names))], []
    else:  # counted, so that rows are read in full: broken ones are not found in part of their values
        coded = rows.select("uri", *values, broken.alias("broken"))
        kind, more = [F.lit("string")] * len(names), [F.array(*[F.count(value) for value in values]).alias("filled")]
    columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), kind[i].alias("type")) for i, n in enumerate(names)])
    return coded.groupBy("uri").agg(columns.alias("columns"), F.count("broken").alias("broken"), *more)


def jsonl_shapes(files: DataFrame) -> DataFrame:
    """Columns and types of files of one JSON object per line; columns in the order of their names.

    A file with a line that is no object is an error. Objects and arrays inside are structs and arrays; what varies in kind is text.
    """
    spark = files.sparkSession
    found = [spark.createDataFrame([], ROW)]
    for paths in _some_paths(files):
        lines = spark.read.text(paths).filter("trim(value) <> ''")
        lines = lines.select(file_path().alias("path"), F.expr("try_parse_json(value)").alias("line"))
        is_object = F.coalesce(F.schema_of_variant("line").startswith("OBJECT"), F.lit(False))
        bad = lines.groupBy("path").agg(F.count_if(~is_object).alias("broken"))
        cells = lines.filter(is_object).select("path", F.explode(F.expr("CAST(line AS MAP<STRING, VARIANT>)")).alias("column", "value"))
        kinds = cells.groupBy("path", "column").agg(F.schema_of_variant_agg("value").alias("type"))
        kinds = kinds.join(bad.filter("broken > 0"), "path", "left_anti").withColumn("type", _spark_type(F.col("type")))
        found.append(kinds.select("path", F.lit(0).alias("position"), "column", "type", F.lit(None).cast("string").alias("error")))
        found.append(
            bad.filter("broken > 0").select(
                "path", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("type"),
                F.concat(F.col("broken").cast("string"), F.lit(" lines are no JSON objects")).alias("error"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def _spark_type(kind: Column) -> Column:
    """A variant's merged type in Spark's own words: numbers with a fraction are doubles, mixed kinds text."""
    kind = F.regexp_replace(F.lower(F.regexp_replace(kind, "OBJECT<", "STRUCT<")), "([:,]) ", "$1")
    kind = F.regexp_replace(kind, r"decimal\(\d+,0\)", "bigint")
    kind = F.regexp_replace(kind, r"decimal\(\d+,\d+\)", "double")
    kind = F.regexp_replace(kind, "float", "double")
    return F.when(kind == "variant", "string").otherwise(F.regexp_replace(F.regexp_replace(kind, r"\bvariant\b", "string"), r"(?<=[<:,])void\b", "string"))
