import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q

NAN = float("nan")


def table(spark, values, ddl="x double"):
    return spark.createDataFrame([(v,) for v in values], ddl)


EDGES = {
    "empty": [],
    "all null": [None, None],
    "one null": [1.0, None, 2.0],
    "two nulls": [1.0, None, None],
    "plain": [1.0, 2.0, 3.0],
    "repeated": [1.0, 1.0, 4.0],
    "nan": [1.0, NAN],
    "two nans": [NAN, NAN],
}


@pytest.mark.parametrize(
    "check, expected",
    [
        (q.some_null("x"), {"all null", "one null", "two nulls"}),
        (q.no_nulls("x"), {"empty", "plain", "repeated", "nan", "two nans"}),
        (q.all_null("x"), {"empty", "all null"}),
        (q.all_unique("x"), {"empty", "one null", "plain", "nan"}),
        (q.not_unique("x"), {"all null", "two nulls", "repeated", "two nans"}),
        (q.mean_greater_than("x", 1.4), {"one null", "plain", "repeated"}),
        (q.mean_greater_or_equal_than("x", 2.0), {"plain", "repeated"}),
        (q.mean_smaller_than("x", 2.0), {"one null", "two nulls"}),
        (q.mean_smaller_or_equal_than("x", 2.0), {"one null", "two nulls", "plain", "repeated"}),
        (q.accepted_values("x", [1.0, 2.0, 3.0]), {"plain"}),
        (q.accepted_values("x", [1.0, 2.0, None]), {"all null", "one null", "two nulls"}),
        (q.accepted_values("x", [None]), {"all null"}),
        (q.accepted_values("x", [1.0, NAN]), {"nan", "two nans"}),
        (q.positive("x"), {"empty", "plain", "repeated", "nan", "two nans"}),
        (q.column_type("x", "double"), set(EDGES)),
        (q.column_type("x", "float"), set()),
    ],
    ids=lambda v: v.name if isinstance(v, q.Check) else "",
)
def test_edges(spark, check, expected):
    passed = {name for name, values in EDGES.items() if q.holds(table(spark, values), check)}
    assert passed == expected


def test_concatenation_skips_nulls(spark):
    rows = [("a", 1, "a-1"), (None, 2, "x"), ("b", None, "y"), ("c", 3, None)]
    df = spark.createDataFrame(rows, "a string, b int, joined string")
    check = q.equal_concatenation("joined", ["a", "b"], "-")
    assert q.holds(df, check)
    assert not q.holds(df.filter("a IS NULL"), check)  # nothing left to compare
    assert not q.holds(df.limit(0), check)
    wrong = df.union(spark.createDataFrame([("d", 4, "d4")], df.schema))
    assert not q.holds(wrong, check)
    assert [row["a"] for row in q.violations(wrong, check).collect()] == ["d"]


def test_suite_is_one_scan(spark):
    df = table(spark, [1.0, 2.0, None])
    results = q.run_suite(df, [q.no_nulls("x"), q.all_unique("x"), q.mean_greater_than("x", 0.0)])
    assert [(r["check"], r["passed"]) for r in results.collect()] == [
        ("no_nulls", False),
        ("all_unique", True),
        ("mean_greater_than", True),
    ]
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_freshness(spark):
    now = dt.datetime(2024, 5, 2, 12)
    df = spark.createDataFrame([(dt.datetime(2024, 5, 2, 9),), (None,)], "ts timestamp_ntz")
    assert q.holds(df, q.fresh("ts", 3, now))
    assert not q.holds(df, q.fresh("ts", 2.5, now))
    assert not q.holds(df.filter("ts IS NULL"), q.fresh("ts", 3, now))


def test_outcome_must_be_boolean(spark):
    df = table(spark, [1.0])
    assert q.run_expectation(df, lambda d: True) == (True, "")
    assert q.run_expectation(df, lambda d: np.bool_(True))[0]
    assert q.run_expectation(df, lambda d: False) == (False, "expectation returned false")
    with pytest.raises(TypeError, match="unsupported type"):
        q.run_expectation(df, lambda d: 5)

    def asserting(d):
        assert d.count() == 2, "two rows wanted"
        return True

    passed, text = q.run_expectation(df, asserting)
    assert not passed and "two rows wanted" in text


def test_strict_raises_and_relaxed_warns(spark):
    results = q.run_suite(table(spark, [None]), [q.no_nulls("x")]).collect()
    with pytest.warns(UserWarning, match="no_nulls"):
        assert q.enforce(results, strict=False) is False
    with pytest.raises(q.ExpectationFailed):
        q.enforce(results, strict=True)


def test_violations_of_uniqueness_include_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    found = {row["v"] for row in q.violations(df, q.all_unique("k")).collect()}
    assert found == {"a", "b", "d", "e"}


def test_plain_functions(spark):
    df = spark.createDataFrame([("a", "b", "a b", 1.0), ("c", "d", "c d", 3.0)], "a string, b string, ab string, x double")
    assert q.expect_column_equal_concatenation(df, "ab", ["a", "b"], " ")
    assert q.expect_column_mean_greater_than(df, "x", 1.9)
    assert not q.expect_column_mean_greater_than(df, "x", 2.0)
    assert q.expect_column_mean_greater_or_equal_than(df, "x", 2.0)
    assert q.expect_column_mean_smaller_than(df, "x", 2.1)
    assert q.expect_column_mean_smaller_or_equal_than(df, "x", 2.0)
    assert not q.expect_column_some_null(df, "x")
    assert q.expect_column_no_nulls(df, "x")
    assert not q.expect_column_all_null(df, "x")
    assert q.expect_column_all_unique(df, "a")
    assert not q.expect_column_not_unique(df, "a")
    assert q.expect_column_accepted_values(df, "a", ["a", "c"])


def test_own_predicate_counts_null_as_violation(spark):
    df = table(spark, [1.0, None])
    check = q.satisfies("small", "x", F.col("x") < 2)
    assert not q.holds(df, check)
    assert q.violations(df, check).count() == 1
