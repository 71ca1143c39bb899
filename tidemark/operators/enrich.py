"""Python only where a row must go through somebody's own code: parsers and per-batch calls, as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.text import before_marker, page_text


def extract_text(
    df: DataFrame,
    source: str,
    name: str = "text",
    marker: str | None = None,
    parser: Callable[[str], str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Readable text of raw documents, cut before `marker`.

    Without a `parser` this is a chain of Spark expressions; with one, the parser runs over Arrow batches, document by
    document. The whole document is always read.
    """
    if parser is None:
        df = df.withColumn(name, page_text(F.col(source)))
    else:
        schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType(), True)])

        names, at = schema.names, df.columns.index(source)

        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [None if raw is None else parser(raw) for raw in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=names)

        df = df.mapInArrow(parse, schema)
    if marker is not None:
        df = df.withColumn(name, before_marker(F.col(name), marker))
    return df.drop(*drop)


def enrich(
    df: DataFrame,
    call: Callable[[pd.DataFrame], Iterable[dict]],
    schema: str,
    keys: Sequence[str],
    batch: int = 64,
    rename: str = "{}",
) -> DataFrame:
    """Many output rows per input row, from a function called once per batch of rows.

    `call` gets at most `batch` rows and yields dicts with the fields of `schema` and `row`, the position in the batch it
    belongs to; the `keys` of that row are added, renamed by `rename`. Keys stay Arrow values, so none loses digits, and whole
    numbers beside nulls reach `call` as Python integers.
    """
    fields = T._parse_datatype_string(schema)
    added = [T.StructField(rename.format(key), df.schema[key].dataType, True) for key in keys]
    out = T.StructType([*fields.fields, *added])
    kinds, places = to_arrow_schema(fields), [df.columns.index(key) for key in keys]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                piece = whole.slice(start, batch)
                answers = list(call(piece.to_pandas(integer_object_nulls=True)))
                if not answers:
                    continue
                rows = pa.array([answer["row"] for answer in answers], pa.int64())
                made = [pa.array([answer.get(f.name) for answer in answers], f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays([*made, *[piece.column(i).take(rows) for i in places]], names=out.names)

    return df.mapInArrow(work, out)
