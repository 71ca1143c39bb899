import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_mean, exact_sum


@pytest.mark.parametrize("places", [0, 2, 6])
def test_same_bits_in_any_order(spark, places):
    """Money of very different sizes, negative too: the exact decimal sum, however rows are dealt."""
    rng = random.Random(places)
    values = [round(rng.choice([1, -1]) * rng.uniform(0, 10 ** rng.randint(0, 8)), places) for _ in range(5000)]
    want = float(sum(Decimal(repr(v)).quantize(Decimal(1).scaleb(-places)) for v in values))
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
    for parts in (1, 3, 7):
        got = df.repartition(parts, F.hash("i", F.lit(parts))).agg(exact_sum("v", places).alias("s"), exact_mean(F.col("v"), places).alias("m")).first()
        assert (got["s"], got["m"]) == (want, want / len(values))


def test_weights_of_a_billion_rows(spark):
    """Limbs as a sum over 10^12 rows would leave them do not overflow where one long would."""
    df = spark.range(4).select(F.lit(9e13).alias("v"))
    assert df.agg(exact_sum("v").alias("s")).first()["s"] == 3.6e14
    hundred = spark.range(2000).select((F.lit(9.0e15) - F.col("id")).alias("v"))
    assert hundred.agg(exact_sum("v", 0).alias("s")).first()["s"] == float(sum(9 * 10**15 - i for i in range(2000)))


def test_nothing_and_not_a_number(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), ("b", None), ("c", float("nan")), ("c", 1.0)], "k string, v double")
    got = {r["k"]: (r["s"], r["m"]) for r in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got["a"] == (1.5, 1.5) and got["b"] == (None, None) and got["c"][0] != got["c"][0]
