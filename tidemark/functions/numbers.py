"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole-number types, narrowest first, and the decimal digits that hold any value of each.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(stored: T.DataType, target: T.DataType) -> bool:
    """Whether `target` holds every value of `stored`: the same type, or a wider number."""
    if stored == target or isinstance(stored, T.NullType):
        return True
    digits, wanted = WHOLE.get(type(stored)), WHOLE.get(type(target))
    if isinstance(target, T.DecimalType):
        if isinstance(stored, T.DecimalType):
            return target.scale >= stored.scale and target.precision - target.scale >= stored.precision - stored.scale
        return digits is not None and target.precision - target.scale >= digits
    if isinstance(target, T.DoubleType):
        return isinstance(stored, T.FloatType) or (digits is not None and digits <= 10)
    if isinstance(target, T.FloatType):
        return digits is not None and digits <= 5
    return digits is not None and wanted is not None and digits <= wanted


LIMB = 20  # bits


def exact_sum(value: Column | str, places: int = 2) -> Column:
    """Sum of values with at most `places` decimals, the same bits in whatever order rows and partitions are added.

    A value is a whole number of units of 10^-places; its three limbs are summed as longs, combined map-side, which 2^43 rows do
    not overflow, and put together in a decimal. NaN makes the sum NaN; infinities and values beyond 2^63 units fail.
    """
    value = F.col(value) if isinstance(value, str) else value
    odd = F.isnan(value)
    units = F.when(~odd, F.round(value * 10**places)).cast("long")
    mask = (1 << LIMB) - 1
    limbs = [units.bitwiseAND(mask), F.shiftright(units, LIMB).bitwiseAND(mask), F.shiftright(units, 2 * LIMB)]
    low, middle, high = (F.sum(x).cast("decimal(25,0)") for x in limbs)
    total = low + middle * F.lit(1 << LIMB).cast("decimal(7,0)") + high * F.lit(1 << 2 * LIMB).cast("decimal(13,0)")
    return F.when(F.bool_or(odd), F.lit(float("nan"))).otherwise(total.cast("double") / 10**places)


def exact_mean(value: Column | str, places: int = 2) -> Column:
    """Mean of values with at most `places` decimals, from their exact sum."""
    return exact_sum(value, places) / F.count(value)
