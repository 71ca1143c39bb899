import datetime as dt
import decimal
import itertools

import pytest

from tidemark.sources import importer, schema_plan, text_shapes
from tidemark.sources.text_shapes import csv_columns, merge_types, merged


def put(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(tmp_path / "*")


def plan(spark, tmp_path, fmt="csv", **more):
    return {c.name: (c.found, c.chosen) for c in schema_plan.plan_table(spark, str(tmp_path), fmt=fmt, **more).columns}


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", "-7", ""], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "123456789012345678901"], "decimal(21,0)"),
        (["1", "2.5"], "double"),
        (["1e3", "-.5", "NaN"], "double"),
        (["1", "007"], "string"),
        (["1", "x"], "string"),
        (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"),
        (["2024-01-31", "2024-02-29"], "date"),
        (["2024-01-31", "2024-02-30"], "string"),
        (["2024-01-31", "2024-01-31 10:00:00.5"], "timestamp_ntz"),
        (["2024-01-31T10:00:00Z", "2024-01-31 10:00:00+02:00"], "timestamp"),
        (["2024-01-31T10:00:00Z", "2024-01-31 10:00:00"], "string"),
        (["", ""], "void"),
        (["1" * 39], "double"),
    ],
)
def test_types_of_text(spark, tmp_path, values, kind):
    put(tmp_path, "a.csv", "k,v\n" + "".join(f"{i},{v}\n" for i, v in enumerate(values)))
    assert plan(spark, tmp_path)["v"] == ((kind,), "string" if kind == "void" else kind)


def test_merging_is_a_lattice():
    kinds = ["void", "int", "bigint", "decimal(21,0)", "decimal(30,0)", "double", "date", "timestamp_ntz", "timestamp", "boolean", "string"]
    join = lambda a, b: None if a is None or b is None else merged(a, b)
    for a, b, c in itertools.product(kinds, repeat=3):
        assert merged(a, b) == merged(b, a) and merged(a, a) == a
        assert join(merged(a, b), c) == join(a, merged(b, c))
    assert merge_types(["double", "int", "void"]) == "double" and merge_types(["int", "string"]) is None and merge_types([]) == "string"


def test_conflict_across_two_csvs_and_its_resolution(spark, lake, tmp_path):
    put(tmp_path, "a.csv", "id,when,amount\n1,20240131,5\n2,20240201,7\n")
    pattern = put(tmp_path, "b/b.csv", 'amount,id,when\n"n/a",3,2024-02-02\n2.5,4,\n')
    found = plan(spark, tmp_path)
    assert found == {"id": (("int",), "int"), "when": (("date", "int"), None), "amount": (("int", "string"), None)}
    with pytest.raises(schema_plan.SchemaConflict, match="amount"):
        importer.create_table(lake, "t", str(tmp_path), fmt="csv")
    decided = schema_plan.plan_table(spark, str(tmp_path), fmt="csv").resolve({"when": "string", "amount": "string"})
    rows = schema_plan.read_files_as(spark, str(tmp_path), decided, fmt="csv").collect()
    assert sorted((r["id"], r["when"], r["amount"]) for r in rows) == [(1, "20240131", "5"), (2, "20240201", "7"), (3, "2024-02-02", "n/a"), (4, None, "2.5")]
    assert pattern


def test_csv_with_quotes_breaks_and_missing_columns(spark, lake, tmp_path):
    put(tmp_path, "a b+%.csv", 'id,note\n1,"a, ""b""\nsecond line"\n2,\n')
    put(tmp_path, "[c].csv", "id,extra\n3000000000,2024-01-01\n")
    put(tmp_path, "only_header.csv", "id,note\n")
    importer.create_table(lake, "t", str(tmp_path), fmt="csv")
    for again in (False, False, True):
        importer.import_files(lake, "t", str(tmp_path), fmt="csv", allow_duplicates=again)
    rows = sorted({(r["id"], r["note"], r["extra"]) for r in lake.read("t").collect()})
    assert rows == [(1, 'a, "b"\nsecond line', None), (2, None, None), (3000000000, None, dt.date(2024, 1, 1))]
    assert lake.read("t").count() == 6


def test_bad_csv_files(spark, lake, tmp_path):
    put(tmp_path, "good.csv", "id,v\n1,2\n")
    put(tmp_path, "wide.csv", "id,v\n1,2,3\n4,5\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "twice.csv", "id,id\n1,2\n")
    with pytest.raises(schema_plan.UnreadableFile):
        schema_plan.plan_table(spark, str(tmp_path), fmt="csv")
    with pytest.warns(UserWarning, match="2 unreadable"):
        decided = schema_plan.plan_table(spark, str(tmp_path), fmt="csv", continue_on_error=True)
    importer.apply_plan(lake, "t", decided)
    with pytest.raises(importer.ImportFailed):
        importer.import_files(lake, "t", str(tmp_path), fmt="csv")
    status = importer.import_files(lake, "t", str(tmp_path), fmt="csv", continue_on_error=True)
    got = {r["path"].rsplit("/", 1)[1]: (r["status"], r["error"]) for r in status.collect()}
    assert got["good.csv"] == ("imported", None) and got["wide.csv"] == ("failed", "1 rows do not fit the header")
    assert [tuple(r) for r in lake.read("t").collect()] == [(1, 2)]


def test_narrowing_text_is_refused_without_a_plan(spark, lake, tmp_path):
    put(tmp_path, "a/a.csv", "id,v\n1,2\n")
    importer.create_table(lake, "t", str(tmp_path / "a"), fmt="csv")
    put(tmp_path, "b/b.csv", "id,v\n2,2.5\n")
    with pytest.raises(schema_plan.SchemaConflict, match="double into int"):
        importer.import_files(lake, "t", str(tmp_path / "b"), fmt="csv")
    put(tmp_path, "c/c.csv", "id,v\n3,\n")
    importer.import_files(lake, "t", str(tmp_path / "c"), fmt="csv")
    assert [tuple(r) for r in lake.read("t").collect()] == [(3, None)]


def test_json_lines(spark, lake, tmp_path):
    put(tmp_path, "a.jsonl", '{"id": 1, "v": 1.5, "tags": ["x"], "in": {"k": 1}, "none": null}\n\n{"id": 2, "v": 2}\n')
    put(tmp_path, "b.json", '{"id": 30000000000, "v": 1, "mixed": 1}\n{"mixed": "a", "id": 4}\n')
    found = plan(spark, tmp_path, "jsonl")
    assert found == {
        "id": (("bigint",), "bigint"), "in": (("struct<k:bigint>",), "struct<k:bigint>"), "mixed": (("string",), "string"),
        "none": (("void",), "string"), "tags": (("array<string>",), "array<string>"), "v": (("bigint", "double"), "double"),
    }
    importer.create_table(lake, "t", str(tmp_path), fmt="jsonl")
    for _ in range(2):
        importer.import_files(lake, "t", str(tmp_path), fmt="jsonl")
    rows = {r["id"]: (r["v"], r["mixed"], r["tags"]) for r in lake.read("t").collect()}
    assert rows == {1: (1.5, None, ["x"]), 2: (2.0, None, None), 30000000000: (1.0, "1", None), 4: (None, "a", None)}


def test_json_conflicts_and_broken_lines(spark, tmp_path):
    put(tmp_path, "a.jsonl", '{"id": 1}\n')
    put(tmp_path, "b.jsonl", '{"id": "x"}\n')
    assert plan(spark, tmp_path, "jsonl")["id"] == (("bigint", "string"), None)
    decided = schema_plan.plan_table(spark, str(tmp_path), fmt="jsonl").resolve({"id": "string"})
    assert sorted(r["id"] for r in schema_plan.read_files_as(spark, str(tmp_path), decided, fmt="jsonl").collect()) == ["1", "x"]
    put(tmp_path, "c.jsonl", '{"id": 1}\n[1]\n{"id":\n')
    with pytest.raises(schema_plan.UnreadableFile, match="2 lines"):
        plan(spark, tmp_path, "jsonl")


def test_formats_times_and_headers(spark, tmp_path):
    put(tmp_path, "a.csv", "id,at\n1,31.01.2024 10:00\n2,\n")
    decided = schema_plan.plan_table(spark, str(tmp_path), fmt="csv").resolve({"id": "decimal(10,2)", "at": {"datatype": "timestamp", "parse_format": "%d.%m.%Y %H:%M"}})
    rows = sorted(map(tuple, schema_plan.read_files_as(spark, str(tmp_path), decided, fmt="csv").collect()))
    assert rows == [(decimal.Decimal("1.00"), dt.datetime(2024, 1, 31, 10)), (decimal.Decimal("2.00"), None)]
    assert csv_columns('a,"b, c"') == ["a", "b, c"]
    with pytest.raises(ValueError, match="unsupported format"):
        schema_plan.plan_table(spark, str(tmp_path), fmt="xml")
    with pytest.raises(FileNotFoundError):
        schema_plan.plan_table(spark, str(tmp_path), fmt="jsonl")


@pytest.mark.parametrize("width", [3, 30])
def test_code_of_a_text_scan_is_compiled(spark, width):
    """The JVM compiles no method of more than 8000 bytes; run without, typing a value took about ten times as long."""
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{name} string" for name in ["uri", *names, f"c{width}"])
    rows = spark.createDataFrame([("f", *["1"] * width, None)], schema)
    typed = text_shapes._kinds(rows, names, True)
    assert [c["type"] for c in typed.first()["columns"]] == ["int"] * width
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is then known before it runs
    try:
        plan = typed.select("*")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    methods = getattr(debug, "MODULE$").codegenStringSeq(plan)
    sizes = [methods.apply(i)._3().maxMethodCodeSize() for i in range(methods.size())]
    assert len(sizes) == 3 and max(sizes[:2]) < 8000  # the last stage only sees a row for each file


def test_rows_that_do_not_fit_are_found_without_types(spark, tmp_path):
    for name, row in (("fits", "1,2"), ("long", "1,2,3"), ("short", "1")):
        put(tmp_path, f"{name}.csv", f"a,b\n5,6\n{row}\n")
    for typed in (True, False):
        rows = schema_plan.shapes(schema_plan.listed(spark, str(tmp_path), "csv"), "csv", typed).collect()
        found = {(r["path"].rsplit("/")[-1], r["column"], r["type"], r["error"]) for r in rows}
        kind = "int" if typed else "string"
        error = "1 rows do not fit the header"
        assert found == {
            ("fits.csv", "a", kind, None), ("fits.csv", "b", kind, None), ("long.csv", None, None, error), ("short.csv", None, None, error),
        }
