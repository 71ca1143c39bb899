"""Data-quality checks on the given tables. Documents without a label stand for nulls."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.operators import quality as q


def labelled(t: Tables) -> DataFrame:
    """Documents with their labels; quality and toxic are null where there is none."""
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")


def _result(check: str, column: str, passed: str, observed: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", {passed} AS passed, "
        f"CAST({observed} AS DOUBLE) AS observed FROM {source}"
    )


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"


@query(
    _result(
        "equal_concatenation", "label", "COALESCE(BOOL_AND(label = lang || '/' || quality), false)",
        "COUNT(*) FILTER (WHERE label <> lang || '/' || quality)",
        f"(SELECT *, CASE WHEN toxic = 1 THEN 'x' ELSE lang || '/' || quality END AS label FROM {_LABELLED})",
    )
)
def check_equal_concatenation(t: Tables) -> DataFrame:
    joined = F.concat("lang", F.lit("/"), F.col("quality").cast("string"))
    df = labelled(t).withColumn("label", F.when(F.col("toxic") == 1, "x").otherwise(joined))
    return q.run_suite(df, [q.equal_concatenation("label", ["lang", "quality"], "/")])


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.withColumn("observed", F.round("observed", places))


@query(_result("mean_greater_than", "l_quantity", "AVG(l_quantity) > 25.5", "ROUND(AVG(l_quantity), 6)", "lineitem"))
def check_mean_greater(t: Tables) -> DataFrame:
    return _rounded(q.run_suite(t.lineitem, [q.mean_greater_than("l_quantity", 25.5)]))


@query(
    _result("mean_greater_or_equal_than", "l_tax", "AVG(l_tax) >= 0.04", "ROUND(AVG(l_tax), 6)", "lineitem")
)
def check_mean_greater_or_equal(t: Tables) -> DataFrame:
    return _rounded(q.run_suite(t.lineitem, [q.mean_greater_or_equal_than("l_tax", 0.04)]))


@query(_result("mean_smaller_than", "quality", "AVG(quality) < 0.9", "ROUND(AVG(quality), 6)", _LABELLED))
def check_mean_smaller(t: Tables) -> DataFrame:
    return _rounded(q.run_suite(labelled(t), [q.mean_smaller_than("quality", 0.9)]))


@query(_result("mean_smaller_or_equal_than", "toxic", "AVG(toxic) <= 0.5", "ROUND(AVG(toxic), 6)", _LABELLED))
def check_mean_smaller_or_equal(t: Tables) -> DataFrame:
    return _rounded(q.run_suite(labelled(t), [q.mean_smaller_or_equal_than("toxic", 0.5)]))


_NULLS = "COUNT(*) FILTER (WHERE quality IS NULL)"


@query(_result("some_null", "quality", f"{_NULLS} > 0", _NULLS, _LABELLED))
def check_some_null(t: Tables) -> DataFrame:
    return q.run_suite(labelled(t), [q.some_null("quality")])


@query(_result("no_nulls", "quality", f"{_NULLS} = 0", _NULLS, _LABELLED))
def check_no_nulls(t: Tables) -> DataFrame:
    return q.run_suite(labelled(t), [q.no_nulls("quality")])


@query(_result("all_null", "quality", f"{_NULLS} = COUNT(*)", _NULLS, _LABELLED))
def check_all_null(t: Tables) -> DataFrame:
    return q.run_suite(labelled(t), [q.all_null("quality")])


_VALUES = "(COUNT(DISTINCT {0}) + COALESCE(MAX(CASE WHEN {0} IS NULL THEN 1 ELSE 0 END), 0))"


@query(
    _result(
        "all_unique", "o_orderkey", f"{_VALUES.format('o_orderkey')} = COUNT(*)",
        f"COUNT(*) - {_VALUES.format('o_orderkey')}", "orders",
    )
)
def check_all_unique(t: Tables) -> DataFrame:
    return q.run_suite(t.orders, [q.all_unique("o_orderkey")])


@query(
    _result(
        "not_unique", "quality", f"{_VALUES.format('quality')} < COUNT(*)", f"COUNT(*) - {_VALUES.format('quality')}", _LABELLED
    )
)
def check_not_unique(t: Tables) -> DataFrame:
    return q.run_suite(labelled(t), [q.not_unique("quality")])


@query(
    _result(
        "accepted_values", "event_type", "BOOL_AND(event_type IN ('view', 'click', 'purchase', 'signup'))",
        "COUNT(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup'))", "events",
    )
)
def check_accepted_values(t: Tables) -> DataFrame:
    return q.run_suite(t.events, [q.accepted_values("event_type", ["view", "click", "purchase", "signup"])])


@query(
    _result(
        "accepted_values", "quality", "COALESCE(BOOL_AND(COALESCE(quality IN (0, 1), false)), false)",
        "COUNT(*) FILTER (WHERE NOT COALESCE(quality IN (0, 1), false))", _LABELLED,
    )
)
def check_accepted_values_refuses_null(t: Tables) -> DataFrame:
    return q.run_suite(labelled(t), [q.accepted_values("quality", [0, 1])])


@query(
    _result("fresh", "ts", "MAX(ts) >= TIMESTAMP '2024-01-30 19:00:00'", "FLOOR(EPOCH(MAX(ts)))", "events")
)
def check_freshness(t: Tables) -> DataFrame:
    return q.run_suite(t.events, [q.fresh("ts", 5, dt.datetime(2024, 1, 31))])


@query(
    _result("positive", "c_acctbal", "COUNT(*) FILTER (WHERE c_acctbal <= 0 OR c_acctbal IS NULL) = 0",
            "COUNT(*) FILTER (WHERE c_acctbal <= 0 OR c_acctbal IS NULL)", "customer")
)
def check_positive(t: Tables) -> DataFrame:
    return q.run_suite(t.customer, [q.positive("c_acctbal")])


@query(_result("column_type", "o_totalprice", "COUNT(*) >= 0", "NULL", "orders"))
def check_column_type(t: Tables) -> DataFrame:
    return q.run_suite(t.orders, [q.column_type("o_totalprice", "double")])


@query(
    """SELECT COUNT(*) - COUNT(DISTINCT l_orderkey) AS duplicate_keys, COUNT(*) FILTER (WHERE l_partkey IS NULL)
       AS missing_values FROM lineitem"""
)
def audit_counts(t: Tables) -> DataFrame:
    return q.key_audit(t.lineitem, "l_orderkey", "l_partkey")


@query(
    " UNION ALL ".join(
        [
            _result(
                "all_unique", "o_orderkey", "COUNT(DISTINCT o_orderkey) = COUNT(*)",
                "COUNT(*) - COUNT(DISTINCT o_orderkey)", "orders",
            ),
            _result("no_nulls", "o_custkey", "COUNT(*) = COUNT(o_custkey)", "COUNT(*) - COUNT(o_custkey)", "orders"),
            _result(
                "accepted_values", "o_orderstatus", "BOOL_AND(o_orderstatus IN ('O', 'F'))",
                "COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F'))", "orders",
            ),
            _result("positive", "o_totalprice", "COUNT(*) FILTER (WHERE o_totalprice <= 0) = 0", "COUNT(*) FILTER (WHERE o_totalprice <= 0)", "orders"),
            _result("mean_smaller_than", "o_totalprice", "AVG(o_totalprice) < 300000", "ROUND(AVG(o_totalprice), 6)", "orders"),
            _result(
                "not_unique", "o_custkey", "COUNT(DISTINCT o_custkey) < COUNT(*)",
                "COUNT(*) - COUNT(DISTINCT o_custkey)", "orders",
            ),
        ]
    )
)
def suite_in_one_pass(t: Tables) -> DataFrame:
    checks = [
        q.all_unique("o_orderkey"),
        q.no_nulls("o_custkey"),
        q.accepted_values("o_orderstatus", ["O", "F"]),
        q.positive("o_totalprice"),
        q.mean_smaller_than("o_totalprice", 300000),
        q.not_unique("o_custkey"),
    ]
    return _rounded(q.run_suite(t.orders, checks))


@query(
    """SELECT 'cheap' AS name, COUNT(*) FILTER (WHERE NOT COALESCE(p_retailprice < 2000, false)) = 0 AS passed FROM part
       UNION ALL SELECT 'many', COUNT(*) >= 1 FROM part"""
)
def expectation_functions(t: Tables) -> DataFrame:
    """User functions from table to boolean; the outcomes as rows."""

    def cheap(df: DataFrame) -> bool:
        return q.holds(df, q.satisfies("cheap", "p_retailprice", F.col("p_retailprice") < 2000))

    def many(df: DataFrame) -> bool:
        return not df.isEmpty()

    outcomes = [(f.__name__, q.run_expectation(t.part, f)[0]) for f in (cheap, many)]
    return t.spark.createDataFrame(outcomes, "name string, passed boolean")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')")
def violations_of_accepted_values(t: Tables) -> DataFrame:
    return q.violations(t.events, q.accepted_values("event_type", ["view", "click"])).select("event_id", "event_type")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) IS NOT NULL AND
       l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1)"""
)
def violations_of_uniqueness(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return q.violations(lines, q.all_unique("l_orderkey"))


@query("SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def violations_of_no_nulls(t: Tables) -> DataFrame:
    return q.violations(labelled(t), q.no_nulls("quality")).select("doc_id", "source")


@query(
    """SELECT true AS relaxed_run_succeeds, false AS strict_run_succeeds, COUNT(*) FILTER (WHERE c_acctbal <= 0) AS violations
       FROM customer"""
)
def soft_and_strict(t: Tables) -> DataFrame:
    """A failing check warns in a relaxed run and stops a strict one."""
    import warnings

    results = q.run_suite(t.customer, [q.positive("c_acctbal")]).collect()

    def succeeds(strict: bool) -> bool:
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                q.enforce(results, strict)
        except q.ExpectationFailed:
            return False
        return True

    row = [(succeeds(False), succeeds(True), int(results[0]["observed"]))]
    return t.spark.createDataFrame(row, "relaxed_run_succeeds boolean, strict_run_succeeds boolean, violations bigint")
