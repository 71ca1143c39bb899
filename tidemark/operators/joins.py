"""Join shapes that Spark's own `join` does not offer directly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on equally named keys where null matches null; the key columns appear once, from `left`.

    `small` marks a right side whose row count the caller has bounded; it is broadcast.
    """
    renamed = {key: f"__right_{key}" for key in keys}
    right = right.withColumnsRenamed(renamed)
    if small:
        right = F.broadcast(right)
    condition = F.lit(True)
    for key, other in renamed.items():
        condition = condition & F.col(key).eqNullSafe(F.col(other))
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def full_by_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer join with the key coalesced into `left_key`.

    Built as a left join plus the right rows that match nothing: both halves are shapes in which AQE can split a hot key,
    which it cannot in a full outer join.
    """
    matched = left.join(right, left[left_key] == right[right_key], "left").drop(right_key)
    seen = left.select(F.col(left_key).alias("__seen")).distinct()
    alone = right.join(seen, right[right_key] == seen["__seen"], "left_anti").withColumnRenamed(right_key, left_key)
    return matched.unionByName(alone, allowMissingColumns=True)
