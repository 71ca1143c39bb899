import datetime as dt
import re

import pytest

from tidemark.plans.models import Input, Model, run
from tidemark.plans.versions import LOAD
from tidemark.sources.scan import relations


def partition_filters(df):
    """What each scan of the plan prunes by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [text.partition("]")[0] for text in re.findall(r"PartitionFilters: \[([^\n]*)", plan)]


def files_read(df):
    """Files of all scans of an executed plan without exchanges."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def stamps(spark):
    rows = [(i, dt.datetime(2022, 1, 1) + dt.timedelta(days=4 * i, hours=i % 24), i % 5, f"n{i % 3}") for i in range(200)]
    return spark.createDataFrame([*rows, (9999, None, None, None)], "id int, ts timestamp_ntz, user int, name string")


@pytest.mark.parametrize(
    "spec,text",
    [
        ("year(ts)", "ts >= '2023-03-01' AND ts < '2023-04-01'"),
        ("month(ts)", "ts >= '2023-03-05' AND ts < '2023-04-01 12:00:00'"),
        ("day(ts)", "ts BETWEEN '2023-03-05 10:00:00' AND '2023-03-06 10:00:00'"),
        ("day(ts)", "to_date(ts) = '2023-03-05'"),
        ("day(ts)", "year(ts) = 2024"),
        ("month(ts)", "year(ts) > 2023 OR ts < '2022-01-02'"),
        ("hour(ts)", "ts > '2023-03-05 10:00:00' AND ts <= '2023-03-06 10:30:00'"),
        ("hour(ts)", "CAST(ts AS DATE) <= '2022-01-03'"),
        ("bucket(4, user)", "user = 3"),
        ("bucket(4, user)", "user IN (1, 3) AND id < 100"),
        ("name", "name <> 'n1' AND name >= 'n2'"),
        ("name", "name IN ('n0', 'nx') OR name = 'n2'"),
        ("day(ts), name", "'2023-03-05' <= ts AND name = 'n1' AND id % 2 = 0"),
        ("day(ts)", f"id IN ({', '.join(map(str, range(30)))}) AND to_date(ts) IN ({', '.join(repr(f'2022-01-{d:02d}') for d in range(1, 25))})"),
    ],
)
def test_filters_prune_and_change_no_result(spark, lake, spec, text):
    lake.publish({"t": stamps(spark)}, partitioned_by=spec)
    want = sorted(r["id"] for r in lake.read("t").filter(text).select("id").collect())
    for df in (lake.scan("t", filters=text, columns=["id"]), lake.query(f"SELECT id FROM t WHERE {text}")):
        assert all("part_" in f for f in partition_filters(df))
        assert sorted(r["id"] for r in df.collect()) == want
        assert files_read(df) < len(lake.read("t").inputFiles())


@pytest.mark.parametrize("text", ["id = 3", "ts IS NULL", "coalesce(name, 'x') = 'x'", "name = 'n1' OR id = 3", "ts <=> NULL"])
def test_filters_that_say_nothing(spark, lake, text):
    lake.publish({"t": stamps(spark)}, partitioned_by="name, year(ts)")
    assert lake.scan("t", filters=text).count() == lake.read("t").filter(text).count()


def test_each_use_of_a_table_counts(spark, lake):
    """A self join, a union and a subquery read the folders that any of them needs."""
    lake.publish({"t": stamps(spark)}, partitioned_by="day(ts)")
    plain = {"t": lake.read("t")}
    for sql in (
        "SELECT a.id FROM t a JOIN t b ON a.user = b.user WHERE to_date(a.ts) = '2023-03-05' AND to_date(b.ts) = '2023-03-09'",
        "SELECT id FROM t WHERE ts < '2022-01-02' UNION ALL SELECT id FROM t WHERE id = 199",
        "SELECT id FROM t WHERE ts < '2022-01-04' AND id > (SELECT min(id) + 2 FROM t WHERE user = 1)",
        "WITH last AS (SELECT max(ts) AS m FROM t) SELECT id FROM t, last WHERE ts = m",
        "SELECT a.id FROM t a LEFT JOIN t b ON a.id = b.id AND b.ts >= '2023-01-01' WHERE a.ts < '2022-02-01' AND b.id IS NULL",
        "SELECT user FROM t WHERE ts >= '2023-06-01' GROUP BY user HAVING count(*) > 3",
    ):
        from tidemark.sources.scan import query

        want = sorted(tuple(r) for r in query(spark, sql, tables=plain).collect())
        assert sorted(tuple(r) for r in lake.query(sql).collect()) == want, sql


def test_model_inputs_prune(spark, lake):
    lake.publish({"t": stamps(spark)}, partitioned_by="day(ts)")
    seen = {}

    def build(rows):
        seen["filters"] = partition_filters(rows)
        return rows.select("id")

    models = [
        Model("day", build, {"rows": Input("t", filter="to_date(ts) = $day")}),
        Model("all", lambda rows: rows.select("id"), {"rows": Input("t")}),
    ]
    from tidemark.functions.params import Parameter

    done = run(spark, models, lake=lake, declared=[Parameter("day")], params={"day": "2023-03-05"})
    assert "part_ts_day" in seen["filters"][0]
    assert done.outputs["day"].count() == lake.read("t").filter("to_date(ts) = '2023-03-05'").count() and done.outputs["all"].count() == 201


def test_pruning_after_evolution(spark, lake):
    lake.publish({"t": stamps(spark)}, partitioned_by="day(ts)")
    lake.evolve("t", add={"note": "string"}, rename={"id": "number"})
    later = stamps(spark).limit(3).selectExpr("id AS number", "ts", "user", "name", "'x' AS note")
    lake.publish({"t": later}, strategy="APPEND")
    df = lake.scan("t", filters="ts < '2022-01-05 12:00:00'", columns=["number", "note"])
    assert all("part_ts_day" in f for f in partition_filters(df))
    assert {(r["number"], r["note"]) for r in df.collect()} == {(0, None), (0, "x"), (1, None), (1, "x")}


def test_tables_named_in_a_statement(spark):
    sql = "WITH c AS (SELECT * FROM one WHERE x IN (SELECT y FROM two)) SELECT 'three', (SELECT 1 FROM Four) FROM c JOIN ns__five ON true"
    assert relations(spark, sql) == {"c", "one", "two", "four", "ns__five"}


# -- overwrites --------------------------------------------------------------------------------------------------------


def days(spark, first, last, tag):
    rows = [(dt.date(2024, 1, d), h, tag) for d in range(first, last + 1) for h in range(3)]
    return spark.createDataFrame(rows, "day date, hour int, tag string")


def test_thirty_daily_overwrites_are_one_scan(spark, lake):
    lake.publish({"t": days(spark, 1, 30, "old")}, partitioned_by=["day"])
    for d in range(1, 31):
        lake.publish({"t": days(spark, d, d, f"new{d}")}, strategy="OVERWRITE_PARTITIONS", overwrite_filter=f"day = '2024-01-{d:02d}'")
    entry = lake.record()["tables"]["t"]
    assert all(p["deleted"] == [] for p in entry["parts"]) and len(entry["parts"]) == 30
    df = lake.read("t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Filter" not in plan.replace("PartitionFilters", "").replace("DataFilters", "").replace("PushedFilters", "")
    assert sorted(r["tag"] for r in df.collect()) == sorted(f"new{d}" for d in range(1, 31) for _ in range(3))
    assert lake.read("t", 1).filter("tag = 'old'").count() == 90


def test_overwrite_cuts_folders_and_leaves_the_rest(spark, lake):
    """Folders by day, a filter by time: covered days go, cut days are written anew without the rows that go."""
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(240)] + [(999, None)]
    lake.publish({"t": spark.createDataFrame(rows, "id int, ts timestamp_ntz")}, partitioned_by="day(ts)")
    before = set(lake.read("t").inputFiles())
    new = spark.createDataFrame([(1000, dt.datetime(2024, 1, 4))], "id int, ts timestamp_ntz")
    text = "ts >= '2024-01-03 12:00:00' AND ts < '2024-01-06 06:00:00'"
    lake.publish({"t": new}, strategy="OVERWRITE_PARTITIONS", overwrite_filter=text)
    lost = {i for i, t in rows if t and dt.datetime(2024, 1, 3, 12) <= t < dt.datetime(2024, 1, 6, 6)}
    assert sorted(r["id"] for r in lake.read("t").collect()) == sorted({i for i, _ in rows} - lost | {1000})
    entry = lake.record()["tables"]["t"]
    assert all(p["deleted"] == [] for p in entry["parts"])
    kept = set(lake.read("t").inputFiles()) & before
    assert len(before) - len(kept) >= 4 and len(kept) >= 7
    assert lake.read("t", 1).count() == 241


def test_overwrite_of_everything_and_of_nothing(spark, lake):
    lake.publish({"t": days(spark, 1, 3, "old")}, partitioned_by="bucket(2, hour), day")
    lake.publish({"t": days(spark, 1, 3, "x").limit(0)}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="hour IN (0, 1, 2)")
    assert lake.read("t").count() == 0 and lake.read("t").columns == ["day", "hour", "tag"]
    lake.publish({"t": days(spark, 9, 9, "y")}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="hour = 77")
    assert lake.read("t").count() == 3


def test_overwrite_of_odd_folder_names(spark, lake):
    values = ["a b", "50%", "x=y", "p/q", "it's", "é", "1+1", "", None]
    lake.publish({"t": spark.createDataFrame([(v, i) for i, v in enumerate(values)], "p string, i int")}, partitioned_by=["p"])
    for text, gone in (("p = 'p/q'", "p/q"), ("p IN ('50%', '1+1')", "50%"), ("p = 'it''s' OR p = 'x=y'", "x=y")):
        lake.publish({"t": spark.createDataFrame([], "p string, i int")}, strategy="OVERWRITE_PARTITIONS", overwrite_filter=text)
        assert gone not in {r["p"] for r in lake.read("t").collect()}
    assert {r["i"] for r in lake.read("t").collect()} == {0, 5, 7, 8}


def test_records_with_delete_predicates_still_read(spark, lake):
    """Entries as earlier releases wrote them."""
    lake.publish({"t": days(spark, 1, 4, "old")}, partitioned_by=["day"])
    tables = lake.record()["tables"]
    tables["t"]["parts"][0]["deleted"] = ["day = '2024-01-02'"]
    lake.commit_staged(tables, lake.versions()[-1])
    assert lake.read("t").count() == 9
    lake.publish({"t": days(spark, 3, 3, "new")}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="day = '2024-01-03'")
    assert sorted((r["day"].day, r["tag"]) for r in lake.read("t").dropDuplicates(["day"]).collect()) == [(1, "old"), (3, "new"), (4, "old")]
    assert LOAD in lake.record()["tables"]["t"]["parts"][0]["path"]
