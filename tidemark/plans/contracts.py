"""Output contracts of a model: column lists and typed fields."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type names and the Spark type of each; Spark keeps no nanoseconds.
CONTRACT_TYPES = {
    "Bool": T.BooleanType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Float64": T.DoubleType(),
    "String": T.StringType(),
    "Binary": T.BinaryType(),
    "TimestampMicro": T.TimestampNTZType(),
    "TimestampMicroUTC": T.TimestampType(),
    "TimestampNano": None,
    "TimestampNanoUTC": None,
}

_LINEAGE = re.compile(r"\s*(\w+)\s*\[\s*['\"](\w+)['\"]\s*\]\s*")


class ContractBroken(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    """A contracted column. `lineage` names its origin as `model['column']`."""

    name: str
    kind: str
    nullable: bool = True
    lineage: str | None = None
    title: str = ""
    doc: str = ""
    allow_truncate: bool = False

    def spark_type(self) -> T.DataType:
        if self.kind not in CONTRACT_TYPES:
            raise ContractBroken(f"{self.name}: unknown type {self.kind}")
        found = CONTRACT_TYPES[self.kind]
        if found is not None:
            return found
        if not self.allow_truncate:
            raise ContractBroken(f"{self.name}: {self.kind} would lose precision; set allow_truncate")
        return T.TimestampType() if self.kind.endswith("UTC") else T.TimestampNTZType()

    def source(self) -> tuple[str, str] | None:
        if self.lineage is None:
            return None
        match = _LINEAGE.fullmatch(self.lineage)
        if not match:
            raise ContractBroken(f"{self.name}: lineage {self.lineage!r} is not of the form model['column']")
        return match.group(1), match.group(2)


def column_problems(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    """Differences between the output columns and a declared list; none for no list or `['*']`."""
    if columns is None or list(columns) == ["*"]:
        return []
    missing = [name for name in columns if name not in df.columns]
    extra = [name for name in df.columns if name not in columns]
    return [f"missing column {name}" for name in missing] + [f"unexpected column {name}" for name in extra]


def schema_problems(df: DataFrame, fields: Sequence[Field]) -> list[str]:
    """Type and lineage-free problems that can be seen without reading data."""
    problems = column_problems(df, [field.name for field in fields])
    for field in fields:
        if field.name in df.columns:
            actual, wanted = df.schema[field.name].dataType, field.spark_type()
            if actual != wanted:
                problems.append(f"{field.name} is {actual.simpleString()}, contract says {wanted.simpleString()}")
    return problems


def lineage_problems(fields: Sequence[Field], inputs: dict[str, DataFrame]) -> list[str]:
    """Lineage that points to an input or column that is not there."""
    problems = []
    for field in fields:
        source = field.source()
        if source and (source[0] not in inputs or source[1] not in inputs[source[0]].columns):
            problems.append(f"{field.name}: no {source[0]}['{source[1]}'] to come from")
    return problems


def null_problems(df: DataFrame, fields: Sequence[Field]) -> list[str]:
    """Nulls in the fields that must have none: one aggregation for all of them."""
    required = [field.name for field in fields if not field.nullable and field.name in df.columns]
    if not required:
        return []
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required]).first().asDict()
    return [f"{name} has {count} nulls" for name, count in counts.items() if count]


def check_contract(
    df: DataFrame, fields: Sequence[Field], inputs: dict[str, DataFrame] | None = None, read: bool = True
) -> list[str]:
    """All problems of a table against its contract; `read=False` leaves out the null counts, which need a job."""
    problems = schema_problems(df, fields)
    if inputs is not None:
        problems += lineage_problems(fields, inputs)
    return problems + null_problems(df, fields) if read else problems


def project(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The contracted columns of an input, in contract order; each must be available under its own or lineage name."""
    columns = []
    for field in fields:
        source = field.source()
        name = source[1] if source and source[1] in df.columns else field.name
        if name not in df.columns:
            raise ContractBroken(f"{field.name} is not available")
        columns.append(F.col(name).alias(field.name))
    return df.select(*columns)
