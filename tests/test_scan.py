import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from tidemark.functions.params import Parameter, markers, resolve
from tidemark.sources.scan import query, rows, scan

WHOLE = "a = 1 AND (t OR a BETWEEN 2 AND 3)"
# good filters cut short, and filters with a clause or statement hung on
BAD = [
    "", "\t", *[WHOLE[:n] for n in (1, 4, 9, 11, 25)], *[WHOLE + more for more in (")", " AND", " ORDER BY a", " LIMIT 1", "; SHOW TABLES")],
    "WITH x AS (SELECT 1) SELECT a", "(SELECT a", "t; t", "a = 'it", "a ==== 1",
]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", dt.datetime(2024, 1, 1)), (2, "bob", dt.datetime(2024, 1, 2)), (3, None, None)],
        "id int, name string, ts timestamp_ntz",
    )


@pytest.mark.parametrize("text", BAD)
def test_bad_filters(spark, text):
    df = spark.createDataFrame([(1, True)], "a int, t boolean")
    df.createOrReplaceTempView("t")
    with pytest.raises(ValueError, match="Invalid SQL filter"):
        scan(spark, df, columns=["a"], filters=text, limit=1)


@pytest.mark.parametrize(
    "text", ["a = 1", "(a = 1) OR (a = 2)", "n IN ('x', ')')", "t", "NOT t OR a BETWEEN 1 AND 2", "n <> ';'"]
)
def test_good_filters(spark, text):
    df = spark.createDataFrame([(1, "x", True)], "a int, n string, t boolean")
    assert scan(spark, df, filters=text).count() == 1


def test_scan(spark, people):
    assert scan(spark, people).columns == ["id", "name", "ts"]
    assert scan(spark, people, columns=["name"], filters="id > 1", limit=1).count() == 1
    assert scan(spark, people, filters="name IS NULL OR id = 1").count() == 2
    with pytest.raises(ValueError, match="Empty column list"):
        scan(spark, people, columns=[])


def test_scan_reaches_the_file(spark, people, folder):
    people.write.parquet(f"{folder}/people")
    plan = scan(spark, f"{folder}/people", columns=["name"], filters="id > 1")._jdf.queryExecution().toString()
    assert "GreaterThan(id,1)" in plan and "ts" not in plan.split("ReadSchema")[1]


def test_parameters_are_bound_not_pasted(spark, people):
    tricky = "ann' OR '1'='1"
    assert scan(spark, people, filters="name = $who", params={"who": tricky}).count() == 0
    assert scan(spark, people, filters="name = $who AND id < $top", params={"who": "ann", "top": 9, "x": 1}).count() == 1
    assert scan(spark, people, filters="ts >= $at", params={"at": "2024-01-02"}).count() == 1
    with pytest.raises(ValueError, match="no value for parameter"):
        scan(spark, people, filters="id = $nothing", params={"other": 1})


def test_markers_leave_quotes_and_comments():
    assert markers("a = '$x' AND b = $y -- $z\n AND `$w` = 1") == "a = '$x' AND b = :y -- $z\n AND `$w` = 1"
    assert markers("'$a' $b", only=True) == ":b"


def test_query(spark, people):
    found = query(spark, "SELECT id FROM people WHERE id >= $least", tables={"people": people}, params={"least": 2})
    assert sorted(r["id"] for r in found.collect()) == [2, 3]
    assert query(spark, "SELECT * FROM people", tables={"people": people}, max_rows=2).count() == 2
    empty = query(spark, "SELECT id, name FROM people WHERE id > 100", tables={"people": people})
    assert empty.columns == ["id", "name"] and empty.count() == 0


def test_ambiguous_column_fails(spark, people):
    with pytest.raises(AnalysisException, match="AMBIGUOUS_REFERENCE"):
        query(spark, "SELECT name FROM people AS a JOIN people AS b ON a.id == b.id", tables={"people": people})


def test_literal_is_not_nullable(spark, people):
    df = query(spark, "SELECT MAX(id) AS top, 'x' AS lit FROM people", tables={"people": people})
    assert [f.nullable for f in df.schema] == [True, False]


def test_row_iterator_passes_empty_partitions(spark):
    df = spark.range(0, 100, 1, 10).filter("id < 5 OR id > 95")
    assert [r["id"] for r in rows(df)] == [0, 1, 2, 3, 4, 96, 97, 98, 99]


def test_resolve_parameters():
    declared = [
        Parameter("n", int, 3),
        Parameter("ratio", float, required=True),
        Parameter("flag", bool, False),
        Parameter("free", str),
    ]
    assert resolve(declared, {"ratio": "1.5", "flag": "Yes"}) == {"n": 3, "ratio": 1.5, "flag": True}
    assert resolve(declared, {"ratio": 2, "flag": "off", "n": "7", "free": "x"})["n"] == 7
    with pytest.raises(ValueError, match="unknown parameter"):
        resolve(declared, {"ratio": 1, "other": 1})
    with pytest.raises(ValueError, match="missing required parameter"):
        resolve(declared, {})
    with pytest.raises(ValueError, match="invalid boolean"):
        resolve(declared, {"ratio": 1, "flag": "maybe"})
    with pytest.raises(ValueError, match="failed to parse"):
        resolve(declared, {"ratio": "much"})


def test_query_leaves_the_sessions_own_views(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert query(spark, "SELECT * FROM numbers", tables={"numbers": spark.range(5), "others": spark.range(1)}).count() == 5
    assert spark.table("numbers").count() == 3
    assert not spark.catalog.tableExists("others")
    spark.catalog.dropTempView("numbers")
