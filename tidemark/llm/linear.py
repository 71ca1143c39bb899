"""What the trained operators share: folds, a bounded labelled sample, and small optimisers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(key, text, label) of all rows with a label of 0 or 1."""
    marks = labels.select(F.col(key).alias("marked"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    return docs.select(key, text).join(marks, F.col(key) == F.col("marked")).select(F.col(key).alias("key"), F.col(text).alias("text"), "label")


def bounded(rows: DataFrame, bound: int) -> DataFrame:
    """About `bound` of the rows, all if there are fewer, chosen by a hash of their key."""
    n = rows.count()
    if n <= bound:
        return rows
    # the lowest bound / n of the hash's range
    return rows.filter(F.xxhash64("key", F.lit(7)) < F.lit((bound << 64) // n - (1 << 63)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Steps for a list of arrays, in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.n = arrays, rate, 0
        self.mean, self.square = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.n += 1
        for a, g, m, s in zip(self.arrays, gradients, self.mean, self.square):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            a -= self.rate * (m / (1 - 0.9**self.n)) / (np.sqrt(s / (1 - 0.999**self.n)) + 1e-8)
