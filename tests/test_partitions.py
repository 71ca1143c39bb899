import datetime as dt

import pytest

from tidemark.sinks.export import dry_run, export, preview, profile, read_json_array
from tidemark.sinks.partitions import Transform, check_overwrite_filter, partition_spec, pruned, with_partitions


def test_spec():
    assert partition_spec("YEAR(ts), customer") == [Transform("year", "ts"), Transform("identity", "customer")]
    assert partition_spec(["day(ts)", "bucket(16, user_id)"])[1] == Transform("bucket", "user_id", 16)
    assert partition_spec("Bucket(user_id, 4), hour(ts)")[0] == Transform("bucket", "user_id", 4)
    for bad in ("week(ts)", "bucket(ts)", "year(3, ts)", "a b", "", "year(ts"):
        with pytest.raises(ValueError):
            partition_spec(bad)


@pytest.mark.parametrize("name", ["identity", "year", "month", "day", "hour", "bucket"])
@pytest.mark.parametrize("op", ["=", "<", "<=", ">", ">=", "in"])
def test_pruning_changes_no_result(spark, name, op):
    stamps = [dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 2, 29, 12), None]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    spec = [Transform(name, "ts", 3 if name == "bucket" else 0)]
    value = dt.datetime(2024, 1, 1, 0, 30)
    wanted = [value, dt.datetime(2023, 12, 31, 23, 59)] if op == "in" else value
    compare = {
        "=": lambda s: s == value, "<": lambda s: s < value, "<=": lambda s: s <= value,
        ">": lambda s: s > value, ">=": lambda s: s >= value, "in": lambda s: s in wanted,
    }[op]
    found = pruned(with_partitions(df, spec), spec, [("ts", op, wanted)]).collect()
    assert sorted(r["ts"] for r in found) == sorted(s for s in stamps if s and compare(s))


def test_folders_are_pruned(spark, lake):
    rows = [(i, dt.datetime(2020 + i % 4, 1, 1)) for i in range(40)]
    lake.publish({"t": spark.createDataFrame(rows, "id int, ts timestamp_ntz")}, partitioned_by="year(ts)")
    df = lake.read("t", where=[("ts", ">=", dt.datetime(2023, 1, 1))])
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "part_ts_year" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize(
    "text",
    ["day >= '2024-01-01' AND day < '2024-02-01'", "year = 2024", "year IN (1, 2) OR day NOT IN ('a', 'b''c')", "(year != 1) and day <> 'x'"],
)
def test_overwrite_filter_accepts(text):
    assert check_overwrite_filter(text, ["day", "year"]) == text


@pytest.mark.parametrize(
    "text",
    ["", "other = 1", "YEAR(day) = 2024", "CAST(day AS date) = 1", "year BETWEEN 1 AND 2", "NOT year = 1", "year = 1; x", "year + 1 = 2", "year LIKE 'a'"],
)
def test_overwrite_filter_refuses(text):
    with pytest.raises(ValueError):
        check_overwrite_filter(text, ["day", "year"])


def test_overwrite_filter_is_parsed(spark):
    df = spark.createDataFrame([(1,)], "year int")
    check_overwrite_filter("year = 1 OR year IN (2)", ["year"], df)
    for text in ("year = AND year", "year = 1 AND", "(year = 1", "year IN 3"):
        with pytest.raises(ValueError):
            check_overwrite_filter(text, ["year"], df)
    with pytest.raises(ValueError, match="partitioned_by"):
        check_overwrite_filter("year = 1", [])


def test_exports(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert spark.read.parquet(export(df, f"{folder}/p", "parquet")).count() == 2
    header = spark.read.text(export(df.coalesce(1), f"{folder}/c", "csv")).first()[0]
    assert header == "id,name"
    lines = spark.read.json(export(df, f"{folder}/l", "jsonl"), schema="id int, name string")
    assert {tuple(r) for r in lines.collect()} == {(1, "a"), (2, None)}
    array = read_json_array(spark, export(df, f"{folder}/j", "json", limit=5), "id int, name string")
    assert {tuple(r) for r in array.collect()} == {(1, "a"), (2, None)}
    empty = spark.read.text(export(df.limit(0), f"{folder}/e", "json", limit=5))
    assert empty.first()[0] == "[]"
    with pytest.raises(ValueError, match="unsupported format"):
        export(df, f"{folder}/x", "xml")
    with pytest.raises(ValueError, match="limit"):
        export(df, f"{folder}/x", "json")


def test_preview(spark):
    df = spark.range(20)
    dry_run(df)
    assert preview(df, "off") is None
    assert preview(df, "on", 3).count() == 3
    assert [r["id"] for r in preview(df, "tail", 3, ["id"]).collect()] == [17, 18, 19]
    with pytest.raises(ValueError):
        preview(df, "tail")
    with pytest.raises(ValueError):
        preview(df, "middle")
    assert profile(df) == [("id", "bigint", False)]


@pytest.mark.parametrize(
    "text",
    ["NOT IN (1)", "TRUE", "1 = 1", "a = b", "a = NULL", "a = 1 +2", "a", "a IN ()", "a IN (1", "a IN (1,)", "(a = 1", "a = 1)", "a = 1 AND",
     "a = 1 b = 2", "a NOT (1)", "a NOT = 1", "a IN 1", "() OR a = 1", "AND a = 1", "a = (1)"],
)
def test_refused_productions(text):
    with pytest.raises(ValueError, match="overwrite filter"):
        check_overwrite_filter(text, ["a", "b"])


@pytest.mark.parametrize("text", ["a = 1", "a NOT IN (1, 'x')", "(a = 1 AND (b IN (true) OR a <> -2.5))", "((a = 'it''s'))"])
def test_accepted_productions(text):
    assert check_overwrite_filter(text, ["a", "b"]) == text
