import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.catalog import QUERIES
from tidemark.functions.times import spark_pattern
from tidemark.operators import quality as q
from tidemark.plans.versions import Lake, UnknownTable, VersionConflict
from tidemark.sources import importer
from tidemark.sources.files import list_files, read_files, read_prefix
from tidemark.sources.importer import import_files
from tidemark.sources.schema_plan import (
    SchemaConflict,
    TablePlan,
    UnreadableFile,
    file_loads,
    footers,
    plan_table,
    read_files_as,
)


def store(folder, name, **columns):
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")


def test_plan_unites_columns(spark, folder):
    store(folder, "a", id=pa.array([1], pa.int32()), x=pa.array(["p"]))
    store(folder, "b", id=pa.array([2], pa.int64()), y=pa.array([1.5]))
    plan = plan_table(spark, f"{folder}/*.parquet", "bucket(4, id)")
    assert [(c.name, c.found, c.chosen) for c in plan.columns] == [
        ("id", ("bigint", "int"), None),
        ("x", ("string",), "string"),
        ("y", ("double",), "double"),
    ]
    assert plan.conflicts == ["id"] and not plan.can_auto_apply
    with pytest.raises(SchemaConflict):
        plan.schema()
    assert plan.resolve({"id": "int"}).can_auto_apply
    assert plan.resolve({"id": "int"}).columns[0].found == ("bigint", "int")
    with pytest.raises(ValueError, match="not in the plan"):
        plan.resolve({"zz": "int"})
    with pytest.raises(FileNotFoundError):
        plan_table(spark, folder + "/none*")


def test_create_and_apply(lake, spark, folder):
    store(folder, "a", id=pa.array([1], pa.int32()))
    importer.create_table(lake, "t", f"{folder}/a.parquet")
    assert lake.read("t").count() == 0 and lake.read("t").schema["id"].dataType.simpleString() == "int"
    with pytest.raises(VersionConflict):
        importer.create_table(lake, "t", f"{folder}/a.parquet")
    importer.create_table(lake, "t", f"{folder}/a.parquet", replace=True)
    store(folder, "b", id=pa.array([1], pa.int64()))
    with pytest.raises(SchemaConflict):
        importer.create_table(lake, "u", f"{folder}/*.parquet")


def test_resolved_values(spark, folder):
    store(folder, "a", id=pa.array([1], pa.int32()), at=pa.array(["20240102030405"]))
    store(folder, "b", id=pa.array([2], pa.int64()), at=pa.array([None], pa.string()))
    files = f"{folder}/*.parquet"
    wanted = {"id": "long", "at": {"datatype": "timestamp", "unit": "us", "parse_format": "%Y%m%d%H%M%S"}}
    rows = read_files_as(spark, files, plan_table(spark, files).resolve(wanted)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, dt.datetime(2024, 1, 2, 3, 4, 5)), (2, None)]
    zoned = {**wanted, "at": {**wanted["at"], "timezone": "UTC"}}
    schema = read_files_as(spark, files, plan_table(spark, files).resolve(zoned)).schema
    assert schema["at"].dataType.simpleString() == "timestamp"


def test_loads_are_bounded(spark, folder):
    for i in range(5):
        store(folder, f"a{i}", id=[i])
    store(folder, "b", id=["x"])
    footer = footers(list_files(spark, f"{folder}/*.parquet"))
    loads = list(file_loads(footer, files_per_load=2))
    assert sorted((types["id"], len(paths)) for types, paths in loads) == [
        ("bigint", 1), ("bigint", 2), ("bigint", 2), ("string", 1),
    ]
    assert len({path for _, paths in loads for path in paths}) == 6


def test_nanoseconds_need_consent(spark, folder):
    stamp = pa.array([1_700_000_000_123_456_789], pa.timestamp("ns"))
    pq.write_table(pa.table({"at": stamp}), f"{folder}/n.parquet", version="2.6")
    plan = plan_table(spark, f"{folder}/n.parquet")
    assert plan.conflicts == ["at"]
    with pytest.raises(ValueError, match="microseconds"):
        plan.resolve({"at": "timestamp"})
    accepted = plan.resolve({"at": {"datatype": "timestamp", "truncate_nanos": True}})
    assert accepted.schema()["at"].dataType.simpleString() == "timestamp_ntz"


def test_import_is_once_per_file(lake, folder):
    store(folder, "a", id=[1, 2])
    importer.create_table(lake, "t", f"{folder}/*.parquet")
    files = f"{folder}/*.parquet"
    assert [r["status"] for r in importer.import_files(lake, "t", files).collect()] == ["imported"]
    assert importer.import_files(lake, "t", files).count() == 0
    store(folder, "b", id=[3])
    importer.import_files(lake, "t", files)
    assert lake.read("t").count() == 3
    importer.import_files(lake, "t", files, allow_duplicates=True)
    assert lake.read("t").count() == 6
    assert lake.read("t__files").count() == 4
    with pytest.raises(UnknownTable):
        importer.import_files(lake, "other", files)


def test_bad_file(lake, folder):
    store(folder, "a", id=[1])
    importer.create_table(lake, "t", f"{folder}/*.parquet")
    with open(f"{folder}/bad.parquet", "wb") as file:
        file.write(b"junk")
    with pytest.raises(importer.ImportFailed, match="bad.parquet"):
        importer.import_files(lake, "t", f"{folder}/*.parquet")
    assert lake.read("t").count() == 0
    status = importer.import_files(lake, "t", f"{folder}/*.parquet", continue_on_error=True)
    assert sorted(r["status"] for r in status.collect()) == ["failed", "imported"]
    assert lake.read("t").count() == 1
    store(folder, "bad", id=[2])  # mended, so it is imported next time
    importer.import_files(lake, "t", f"{folder}/*.parquet")
    assert lake.read("t").count() == 2


def test_best_effort(lake, folder):
    store(folder, "a", id=[1], x=["p"])
    importer.create_table(lake, "t", f"{folder}/*.parquet")
    store(folder, "b", id=[2], more=[True])
    with pytest.raises(SchemaConflict, match="more"):
        importer.import_files(lake, "t", f"{folder}/*.parquet")
    importer.import_files(lake, "t", f"{folder}/*.parquet", best_effort=True)
    assert {tuple(r) for r in lake.read("t").collect()} == {(1, "p"), (2, None)}


def test_audited_import(lake, folder):
    store(folder, "a", id=[1, 1])
    importer.create_table(lake, "t", f"{folder}/*.parquet")
    with pytest.raises(q.ExpectationFailed):
        importer.import_files(lake, "t", f"{folder}/*.parquet", checks=[q.all_unique("id")])
    assert lake.read("t").count() == 0
    importer.import_files(lake, "t", f"{folder}/*.parquet", checks=[q.no_nulls("id")])
    assert lake.read("t").count() == 2


def test_external_refuses_import(lake, spark, folder):
    store(folder, "a", id=[1])
    lake.register_external("ext", [f"{folder}/*.parquet"])
    with pytest.raises(ValueError, match="read-only"):
        importer.import_files(lake, "ext", f"{folder}/*.parquet")


def test_field_ids_do_not_leak(spark, folder):
    field = pa.field("col1", pa.int32(), metadata={b"PARQUET:field_id": b"3"})
    pq.write_table(pa.table({"col1": [1, 2]}, schema=pa.schema([field])), f"{folder}/f.parquet")
    df = read_files(spark, f"{folder}/f.parquet")
    assert df.schema["col1"].metadata == {}
    assert all(not f.metadata for f in df.toArrow().schema)


def test_formats_and_prefixes(spark, folder):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, day int")
    df.write.partitionBy("day").parquet(f"{folder}/days")
    assert [tuple(r) for r in read_prefix(spark, f"{folder}/days", "day=5").collect()] == [(1, "a", 5)]
    df.drop("day").write.option("header", True).csv(f"{folder}/csv")
    assert read_files(spark, f"{folder}/csv", "csv").schema["id"].dataType.simpleString() == "int"
    df.write.json(f"{folder}/lines")
    assert read_files(spark, [f"{folder}/lines"], "jsonl").count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        read_files(spark, folder, "xml")


def test_strptime_patterns():
    assert spark_pattern("%Y%m%d%H%M%S") == "yyyyMMddHHmmss"
    assert spark_pattern("%d/%m/%y at %I:%M %p") == "dd/MM/yy 'a''t' hh:mm a"
    with pytest.raises(ValueError):
        spark_pattern("%Q")


def test_footers_of_paths_with_blanks_and_escapes(spark, folder):
    rows = spark.createDataFrame([(1, "a b:c"), (2, "d/e")], "id int, k string")
    rows.write.partitionBy("k").parquet(f"{folder}/odd name")
    found = footers(list_files(spark, f"{folder}/odd name")).collect()
    assert [(r.column, r.error) for r in found] == [("id", None)] * 2


def test_import_without_a_plan_narrows_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create_table("t", spark.createDataFrame([], "v int").schema)
    spark.createDataFrame([(1.9,)], "v double").coalesce(1).write.parquet(str(tmp_path / "wide"))
    with pytest.raises(SchemaConflict, match="v \\(double into int\\)"):
        import_files(lake, "t", str(tmp_path / "wide"))
    spark.createDataFrame([(7,)], "v smallint").coalesce(1).write.parquet(str(tmp_path / "narrow"))
    import_files(lake, "t", str(tmp_path / "narrow"))
    assert [r.v for r in lake.read("t").collect()] == [7]


def test_plans_and_reads_stop_at_an_unreadable_file(spark, tmp_path):
    spark.createDataFrame([(1,)], "v int").coalesce(1).write.parquet(str(tmp_path / "d"))
    plan = plan_table(spark, str(tmp_path / "d"))
    (tmp_path / "d" / "bad.parquet").write_bytes(b"nothing of the kind")
    with pytest.raises(UnreadableFile, match="bad.parquet"):
        plan_table(spark, str(tmp_path / "d"))
    with pytest.raises(UnreadableFile, match="bad.parquet"):
        read_files_as(spark, str(tmp_path / "d"), plan)
    with pytest.warns(UserWarning, match="left out 1 unreadable"):
        assert read_files_as(spark, str(tmp_path / "d"), plan, continue_on_error=True).count() == 1


def test_plan_survives_as_an_edited_document(spark, folder):
    store(folder, "a", id=pa.array([1], pa.int32()), at=pa.array(["2024/03/01"]))
    store(folder, "b", id=pa.array([2], pa.int64()), at=pa.array(["2024/03/02"]))
    plan = plan_table(spark, f"{folder}/*.parquet", "bucket(4, id)")
    stored = json.loads(json.dumps(plan.document()))
    assert TablePlan.from_document(stored) == plan and plan.conflicts == ["id"]
    stored["columns"][0]["chosen"] = "long"
    stored["columns"][1] |= {"chosen": "timestamp", "parse_format": "%Y/%m/%d"}
    edited = TablePlan.from_document(stored)
    assert [(c.chosen, c.parse_format) for c in edited.columns] == [("bigint", None), ("timestamp", "%Y/%m/%d")]
    assert edited.partitioned_by == plan.partitioned_by and TablePlan.from_document(edited.document()) == edited
    rows = read_files_as(spark, f"{folder}/*.parquet", edited).orderBy("id").collect()
    assert [(r.id, str(r.at)) for r in rows] == [(1, "2024-03-01 00:00:00"), (2, "2024-03-02 00:00:00")]
    stored["columns"][0]["chosen"] = "no such type"
    with pytest.raises(Exception, match="(?i)no|syntax"):
        TablePlan.from_document(stored)
    with pytest.raises(ValueError, match="partition column"):
        TablePlan.from_document({**plan.document(), "partitioned_by": ["day(other)"]})


def test_days_with_values_of_zero_are_published(spark, folder):
    """The SQL counts every row of the two days, and 0 is an amount like any other; a negative or missing one is refused."""

    def ingest(values):
        days = [dt.datetime(2024, 1, 3 + i % 2, 5) for i in range(len(values))]
        rows = [(i, day, 7, "view", value, "{}") for i, (day, value) in enumerate(zip(days, values))]
        schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/events.parquet")
        return [tuple(r) for r in QUERIES["ingest_days_with_audit"](spark, folder).collect()]

    assert ingest([0.0, 1.5, 2.0, 0.0]) == [("view", 4, 3.5)]
    for bad in (-0.01, None):
        with pytest.raises(q.ExpectationFailed, match="value"):
            ingest([1.0, 2.0, bad])
