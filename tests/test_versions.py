import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.plans.versions import (
    Lake,
    UnknownTable,
    UnknownVersion,
    VersionConflict,
    diff_versions,
    filter_history,
    with_message_parts,
)


@pytest.fixture
def numbers(spark):
    return spark.range(10).select("id", (F.col("id") % 3).alias("part"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_publish_and_read_back(lake, numbers):
    assert lake.publish({"n": numbers}) == 1
    assert lake.publish({"n": numbers.filter("id < 3")}, strategy="APPEND") == 2
    assert lake.publish({"n": numbers.filter("id > 7")}) == 3
    assert [lake.read("n", at).count() for at in (1, 2, 3, None, "main^1", "main@1")] == [10, 13, 2, 2, 13, 10]
    with pytest.raises(UnknownVersion):
        lake.read("n", 9)
    with pytest.raises(UnknownTable):
        lake.read("other")


def test_time_travel_by_timestamp(lake, numbers):
    lake.publish({"n": numbers})
    time.sleep(0.05)
    between = dt.datetime.now(dt.timezone.utc)
    time.sleep(0.05)
    lake.publish({"n": numbers.limit(1)})
    assert lake.read("n", between).count() == 10
    with pytest.raises(UnknownVersion):
        lake.read("n", between - dt.timedelta(days=1))


def test_second_writer_is_refused(spark, lake, numbers):
    lake.publish({"n": numbers})
    late = lake.stage("n", numbers.limit(1))
    lake.publish({"n": numbers.limit(2)})
    with pytest.raises(VersionConflict):
        lake.commit_staged({"n": late}, 1)
    assert lake.read("n").count() == 2


def test_failed_audit_publishes_nothing(lake, numbers):
    lake.publish({"n": numbers})
    with pytest.raises(q.ExpectationFailed, match="all_unique"):
        lake.publish({"n": numbers.union(numbers), "m": numbers}, checks={"n": [q.all_unique("id")]})
    assert lake.versions() == [1] and [r["table"] for r in lake.tables().collect()] == ["n"]
    lake.publish({"n": numbers.union(numbers)}, checks={"n": [q.all_unique("id")]}, strict=False)
    assert lake.read("n").count() == 20


def test_append_must_fit(lake, numbers):
    lake.publish({"n": numbers})
    with pytest.raises(ValueError, match="columns of n"):
        lake.publish({"n": numbers.drop("part")}, strategy="APPEND")
    with pytest.raises(ValueError, match="n.id is bigint"):
        lake.publish({"n": numbers.withColumn("id", F.col("id").cast("int"))}, strategy="APPEND")


def test_overwrite_partitions_keeps_null_rows(spark, lake):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id long, p string")
    lake.publish({"t": df}, partitioned_by=["p"])
    new = spark.createDataFrame([(9, "a")], "id long, p string")
    lake.publish({"t": new}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="p = 'a' OR p != 'b' AND p <> ''")
    assert ids(lake.read("t")) == [2, 3, 4, 9]
    assert {r["p"] for r in lake.read("t").collect()} == {"b", None, "", "a"}
    lake.publish({"t": new}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="p IN ('a', 'b')")
    assert ids(lake.read("t")) == [3, 4, 9]
    assert ids(lake.read("t", 2)) == [2, 3, 4, 9]


def test_overwrite_needs_partitions_and_filter(lake, numbers):
    lake.publish({"n": numbers})
    with pytest.raises(ValueError, match="partitioned_by"):
        lake.publish({"n": numbers}, strategy="OVERWRITE_PARTITIONS", overwrite_filter="id = 1")
    with pytest.raises(ValueError, match="needs an overwrite_filter"):
        lake.publish({"n": numbers}, strategy="OVERWRITE_PARTITIONS", partitioned_by="part")
    with pytest.raises(ValueError, match="OVERWRITE_PARTITIONS only"):
        lake.publish({"n": numbers}, strategy="APPEND", overwrite_filter="part = 1")
    with pytest.raises(ValueError, match="strategy"):
        lake.publish({"n": numbers}, strategy="UPSERT")


def test_merge_rules(lake, numbers):
    lake.publish({"n": numbers})
    a, b = lake.fork("a"), lake.fork("b")
    a.publish({"n": numbers.limit(1), "x": numbers})
    b.publish({"y": numbers})
    lake.merge("a")
    assert lake.read("n").count() == 1
    lake.merge("b")  # b never touched n
    assert [r["table"] for r in lake.tables().collect()] == ["n", "x", "y"]
    b.publish({"n": numbers.limit(2)})
    with pytest.raises(VersionConflict, match="n"):
        lake.merge("b")
    later = lake.fork("later")
    later.publish({"n": numbers.limit(3)})
    lake.merge("later")  # after the first merge: a plain overwrite
    assert lake.read("n").count() == 3
    later.publish({"n": numbers.limit(4)})
    lake.merge("later")
    assert lake.read("n").count() == 4
    later.drop("x")
    lake.merge("later")
    assert [r["table"] for r in lake.tables().collect()] == ["n", "y"]
    with pytest.raises(VersionConflict):
        lake.fork("a")


def test_revert(lake, numbers):
    lake.publish({"n": numbers})
    lake.publish({"n": numbers.limit(1), "m": numbers})
    with pytest.raises(ValueError, match="same version"):
        lake.revert("n", 2)
    with pytest.raises(VersionConflict, match="replace"):
        lake.revert("n", 1)
    with pytest.raises(UnknownTable):
        lake.revert("m", 1)
    lake.revert("n", 1, replace=True)
    assert lake.read("n").count() == 10
    with pytest.raises(ValueError, match="identical"):
        lake.revert("n", 1, replace=True)
    lake.drop("n")
    lake.revert("n", 2)
    assert lake.read("n").count() == 1


def test_tags(lake, numbers):
    lake.publish({"n": numbers})
    lake.tag("v1")
    lake.publish({"n": numbers.limit(2)})
    assert lake.read("n", "v1").count() == 10
    with pytest.raises(VersionConflict):
        lake.tag("v1")
    lake.tag("v1", 2, move=True)
    assert lake.read("n", "v1").count() == 2 and lake.read("n", "v1^1").count() == 10


def test_table_listing_and_diff(lake, numbers):
    lake.publish({"raw.n": numbers, "m": numbers})
    lake.publish({"raw.k": numbers})
    lake.drop("m")
    assert {tuple(r) for r in diff_versions(lake, 1, 3).collect()} == {("raw.k", "added"), ("m", "removed")}
    assert [tuple(r) for r in diff_versions(lake, 1, 3, namespace="main").collect()] == [("m", "removed")]
    with pytest.raises(ValueError, match="itself"):
        diff_versions(lake, "main", 3)
    assert [r["table"] for r in lake.tables(namespace="raw").collect()] == ["raw.k", "raw.n"]
    assert [r["table"] for r in lake.tables(name=r"raw\.n").collect()] == ["raw.n"]


def test_external_is_read_only(lake, numbers, folder):
    numbers.write.parquet(f"{folder}/files")
    lake.register_external("ext", [f"{folder}/files"])
    assert lake.read("ext").count() == 10
    with pytest.raises(ValueError, match="read-only"):
        lake.publish({"ext": numbers}, strategy="APPEND")
    with pytest.raises(VersionConflict):
        lake.register_external("ext", [f"{folder}/files"])
    lake.register_external("ext", [f"{folder}/files/*.parquet"], overwrite=True)
    assert [r["kind"] for r in lake.tables().collect()] == ["external"]


def test_evolution(spark, lake):
    lake.publish({"t": spark.createDataFrame([(1, "x", 2.0)], "id int, name string, old double")})
    lake.evolve("t", rename={"name": "label"}, drop=["old"], add={"score": "int"})
    lake.publish({"t": spark.createDataFrame([(2, "y", 5)], "id int, label string, score int")}, strategy="APPEND")
    lake.evolve("t", rename={"label": "name"})
    assert {tuple(r) for r in lake.read("t").collect()} == {(1, "x", None), (2, "y", 5)}
    assert lake.read("t").columns == ["id", "name", "score"]
    assert lake.read("t", 1).columns == ["id", "name", "old"]
    # a dropped name used again is a new column: the old values stay hidden
    lake.evolve("t", add={"old": "double"})
    assert {r["old"] for r in lake.read("t").collect()} == {None}
    with pytest.raises(ValueError, match="share a name"):
        lake.evolve("t", add={"id": "int"})


def test_conditions_on_renamed_and_added_columns(spark, lake):
    lake.publish({"t": spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")}, partitioned_by="id")
    lake.evolve("t", rename={"name": "label"}, add={"score": "int"})
    assert lake.read("t", where=[("label", "=", "y")]).count() == 1
    assert lake.read("t", where=[("score", ">", 0)]).count() == 0
    with pytest.raises(ValueError, match="partition column"):
        lake.evolve("t", drop=["id"])


def test_history(spark, lake, numbers):
    lake.publish({"n": numbers}, message="  load n \n\n first body\n", author="ann", properties={"env": "dev"})
    lake.publish({"n": numbers}, message="load again", author="bob")
    history = lake.history()
    first = history.filter("version = 1").first()
    assert (first["subject"], first["body"], first["parent"]) == ("load n", "first body", None)
    assert history.filter("version = 2").first()["body"] is None
    assert filter_history(history, message="^load").count() == 1
    assert filter_history(history, message="load again").count() == 1
    assert filter_history(history, author="ann", properties={"env": "dev"}).count() == 1
    assert filter_history(history, parent="main@1").first()["version"] == 2
    assert filter_history(history, limit=1).first()["version"] == 2
    now = dt.datetime.now(dt.timezone.utc)
    assert filter_history(history, start=now - dt.timedelta(hours=1), end=now + dt.timedelta(hours=1)).count() == 2
    empty = with_message_parts(spark.createDataFrame([("  \n ",)], "message string")).first()
    assert empty["subject"] is None and empty["body"] is None


def test_many_parts_stay_shallow(spark, lake):
    for i in range(20):
        lake.publish({"t": spark.range(i, i + 1)}, strategy="APPEND")
    assert sorted(r["id"] for r in lake.read("t").collect()) == list(range(20))


def test_lakes_share_a_root(spark, folder, numbers):
    Lake(spark, f"{folder}/l").publish({"n": numbers})
    assert Lake(spark, f"{folder}/l/").read("n").count() == 10


def test_compact(lake, numbers):
    lake.publish({"n": numbers}, partitioned_by="part")
    for part in (0, 1):
        new = numbers.filter(f"part = {part} AND id > 5")
        lake.publish({"n": new}, strategy="OVERWRITE_PARTITIONS", overwrite_filter=f"part = {part}")
    before = ids(lake.read("n"))
    lake.compact("n")
    entry = lake.record()["tables"]["n"]
    assert len(entry["parts"]) == 1 and entry["parts"][0]["deleted"] == [] and entry["partitioned_by"]
    assert ids(lake.read("n")) == before == [2, 5, 6, 7, 8, 9]


def test_appends_are_one_scan(spark, lake):
    for i in range(4):
        lake.publish({"t": spark.range(i, i + 1)}, strategy="APPEND", partitioned_by="id")
    df = lake.read("t", where=[("id", "=", 2)])
    assert ids(df) == [2]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize(
    "ddl, values",
    [
        ("timestamp_ntz", [dt.datetime(2024, 1, 1, 3, 4, 5), dt.datetime(2024, 5, 1)]),
        ("date", [dt.date(2024, 1, 1), dt.date(1969, 12, 31)]),
        ("boolean", [True, False]),
        ("bigint", [2**40, -1]),
        ("double", [0.1, 1e300]),
        ("string", ["a=b/c", " 7"]),
    ],
)
def test_partition_values_survive(spark, lake, ddl, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], f"id bigint, v {ddl}")
    lake.publish({"t": df}, partitioned_by="v")
    assert {r["id"]: r["v"] for r in lake.read("t").collect()} == dict(enumerate([*values, None]))
    assert [ids(lake.read("t", where=[("v", "=", v)])) for v in values] == [[0], [1]]


def test_sql_and_scans_at_a_version(lake, numbers):
    lake.publish({"n": numbers, "raw.n": numbers.limit(4)})
    lake.publish({"n": numbers.limit(1)})
    assert lake.query("SELECT COUNT(*) AS c FROM n").first()["c"] == 1
    assert lake.query("SELECT COUNT(*) AS c FROM n", at=1).first()["c"] == 10
    assert lake.query("SELECT COUNT(*) AS c FROM n", namespace="raw").first()["c"] == 4
    joined = lake.query("SELECT a.id FROM n a JOIN raw__n b ON a.id = b.id WHERE a.id < $top", at=1, params={"top": 3})
    assert ids(joined) == [0, 1, 2]
    assert lake.query("SELECT * FROM n", at=1, max_rows=2).count() == 2
    found = lake.scan("n", at=1, columns=["id"], filters="part = $p", params={"p": 0}, limit=3)
    assert found.columns == ["id"] and found.count() == 3


def test_audit_of_new_rows_only(lake, numbers):
    lake.publish({"n": numbers})
    checks = {"n": [q.all_unique("id")]}
    with pytest.raises(q.ExpectationFailed):
        lake.publish({"n": numbers}, strategy="APPEND", checks=checks)
    lake.publish({"n": numbers}, strategy="APPEND", checks=checks, audit_new_only=True)
    assert lake.read("n").count() == 20


def test_soft_publish_warns(spark, lake):
    rows = spark.createDataFrame([(1,), (None,)], "a int")
    with pytest.warns(UserWarning, match="t: expectations failed: .*a"):
        lake.publish({"t": rows}, checks={"t": [q.no_nulls("a")]}, strict=False)


def test_overwrite_refuses_another_partitioning(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.publish({"t": spark.createDataFrame([("a", 1)], "nm string, v int")})
    lake.evolve("t", rename={"nm": "name"})
    new = spark.createDataFrame([("a", 2)], "name string, v int")
    with pytest.raises(ValueError, match="partitioned by"):
        lake.publish({"t": new}, strategy="OVERWRITE_PARTITIONS", partitioned_by=["name"], overwrite_filter="name = 'a'")
    assert [tuple(r) for r in lake.read("t").collect()] == [("a", 1)]


def test_tables_of_one_publish_are_written_each_in_its_own_way(lake, numbers):
    lake.publish({"log": numbers})
    own = {"log": {"strategy": "APPEND"}, "n": {"partitioned_by": "part"}, "m": {"partitioned_by": "bucket(2, id)"}}
    assert lake.publish({"log": numbers, "n": numbers, "m": numbers}, options=own) == 2
    entries = lake.record()["tables"]
    assert [entries[x]["partitioned_by"] for x in ("log", "n", "m")] == [[], ["identity(part)"], ["bucket(2, id)"]]
    assert [lake.read(x).count() for x in ("log", "n", "m")] == [20, 10, 10]
    with pytest.raises(ValueError, match="not published: other"):
        lake.publish({"n": numbers}, options={"other": {"strategy": "APPEND"}})


def test_a_line_at_a_time(lake, numbers):
    lake.publish({"n": numbers})
    side = lake.fork("side")
    time.sleep(0.05)
    between = dt.datetime.now(dt.timezone.utc).isoformat()
    time.sleep(0.05)
    side.publish({"n": numbers.limit(1)})
    assert lake.read("n", f"side*{between}").count() == 10 and lake.read("n", "side").count() == 1
    with pytest.raises(UnknownVersion):
        lake.read("n", "side*2001-01-01")
