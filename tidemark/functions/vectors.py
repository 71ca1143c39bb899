"""Vector arithmetic over array columns, in double precision and without Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a vector is all zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def nearest(df: DataFrame, key: str, vector: str, query: Sequence[float], k: int, score: str = "score") -> DataFrame:
    """The `k` rows most similar to one query vector, ties by key: one scan and a top-k per partition."""
    length = sum(float(x) * float(x) for x in query) ** 0.5
    if length == 0:
        raise ValueError("the query vector has no direction")
    target = F.array(*[F.lit(float(x) / length) for x in query])
    own = F.sqrt(dot(F.col(vector), F.col(vector)))
    similar = F.when(own > 0, dot(F.col(vector), target) / own)
    scored = df.withColumn(score, similar).filter(F.col(score).isNotNull())
    return scored.orderBy(F.col(score).desc(), F.col(key)).limit(k)
