"""Small reports: best row per key, histograms, seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: Sequence[str], best: str, ties: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the one with the highest `best`, then the highest of `ties`, then of the other columns.

    The row a window would number first is a maximum, and a maximum combines before the shuffle: a hot key sends one row
    per task instead of all of them.
    """
    rest = [name for name in df.columns if name not in keys]
    order = F.struct(F.col(best), *ties, *[F.col(name) for name in rest])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__best")).select(*keys, "__best.*")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin (`bin` from 0, `n`) between the smallest and the largest value; nulls and NaN are left out."""
    df = df.filter(F.col(column).isNotNull() & ~F.isnan(column))
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or low == high:
        slot = F.lit(0)
    else:
        slot = F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1))
    counted = df.groupBy(slot.cast("long").alias("bin"))
    return counted.agg(F.count(F.lit(1)).alias("n"))


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """Exactly `rows` rows (or all there are), the same for the same seed however the table is stored: lowest hashes win."""
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(ticket, key).limit(rows)
