import pytest
from pyspark.sql import functions as F

from tidemark.functions.params import Parameter
from tidemark.operators import quality as q
from tidemark.plans import contracts
from tidemark.plans.models import Expectation, Input, Model, RunFailed, ordered, relations, run, sql_model, sql_text_model


@pytest.fixture
def trips(spark):
    return spark.createDataFrame([(1, 2.0), (2, 5.0), (3, 0.5)], "zone int, miles double")


def passing(data):
    return data


def test_many_parents(spark, trips):
    seen = []

    def both(a, b):
        seen.append("both")
        return a.union(b).withColumnRenamed("c", "d")

    def renamed(d):
        return d.withColumnRenamed("d", "e")

    def all_of(a, b, d, e):
        return a.union(b).union(d).union(e)

    models = [
        Model("last", all_of, {"a": Input("m0"), "b": Input("m1"), "d": Input("m2", ["d"]), "e": Input("m3", ["e"])}),
        Model("m3", renamed, {"d": Input("m2")}, columns=["e"]),
        Model("m2", both, {"a": Input("m0"), "b": Input("m1")}, columns=["d"]),
        sql_text_model("m0", "SELECT CASE WHEN zone IS NOT NULL THEN 'v0' ELSE 'v0' END AS c FROM trips LIMIT 1"),
        sql_text_model("m1", "SELECT CASE WHEN zone IS NOT NULL THEN 'v1' ELSE 'v1' END AS c FROM trips LIMIT 1"),
    ]
    done = run(spark, models, {"trips": trips}, strict=True)
    assert sorted(r["c"] for r in done.outputs["last"].collect()) == ["v0"] * 3 + ["v1"] * 3
    assert seen == ["both"]  # built once although two models read it
    assert [r["model"] for r in done.summary.collect()].index("m2") > 1


def test_names(spark):
    twice = [Model("a", passing), Model("a", passing)]
    with pytest.raises(ValueError, match="duplicate definition of 'a'"):
        ordered(twice, set())
    with pytest.raises(ValueError, match="cycle"):
        ordered([Model("a", passing, {"x": Input("b")}), Model("b", passing, {"x": Input("a")})], set())
    with pytest.raises(ValueError, match="reads itself"):
        ordered([Model("t", passing, {"x": Input("t")})], {"t"})
    with pytest.raises(ValueError, match="reads itself"):
        ordered([sql_text_model("t", "SELECT * FROM t")], {"t"})
    with pytest.raises(ValueError, match="no model or table named 'gone'"):
        ordered([Model("a", passing, {"x": Input("gone")})], set())


def test_sql_file_directives(spark, folder):
    from pathlib import Path

    path = Path(folder) / "my_view.sql"
    path.write_text("SELECT zone FROM trips")
    assert sql_model(path).name == "my_view"
    path.write_text(
        '-- tidemark: name = renamed\n-- tidemark: materialization_strategy=REPLACE\n'
        '-- tidemark: partitioned-by="day(ts), zone"\n-- tidemark: output_schema = Zones\nSELECT zone FROM trips'
    )
    zones = [contracts.Field("zone", "Int32")]
    model = sql_model(path, {"Zones": zones})
    assert (model.name, model.strategy, model.partitioned_by) == ("renamed", "REPLACE", "day(ts), zone")
    assert model.schema is zones
    with pytest.raises(ValueError, match="no schema named"):
        sql_model(path)
    with pytest.raises(ValueError, match="unknown directive"):
        sql_text_model("x", "-- tidemark: speed=fast\nSELECT 1")


def test_names_in_quotes_are_no_parents():
    model = sql_text_model("x", "SELECT 'other' AS s -- other\n FROM base /* other */")
    assert model.parents({"other", "base"}) == {"base"}


def test_parameters_reach_sql_filters_and_functions(spark, trips):
    def scaled(data, ratio):
        return data.withColumn("miles", F.col("miles") * ratio)

    models = [
        sql_text_model("near", "SELECT * FROM trips WHERE miles < $top"),
        Model("scaled", scaled, {"data": Input("near", ["miles"], filter="zone = $zone")}),
    ]
    declared = [Parameter("top", float, 4.0), Parameter("zone", int, required=True), Parameter("ratio", float, 10.0)]
    done = run(spark, models, {"trips": trips}, declared=declared, params={"zone": "1"})
    assert [r["miles"] for r in done.outputs["scaled"].collect()] == [20.0]
    with pytest.raises(ValueError, match="missing required"):
        run(spark, models, {"trips": trips}, declared=declared)
    with pytest.raises(ValueError, match="unknown parameter"):
        run(spark, models, {"trips": trips}, declared=declared, params={"zone": 1, "speed": 1})


def test_contract_warns_or_fails(spark, trips):
    models = [Model("m", passing, {"data": Input("trips")}, columns=["zone"])]
    with pytest.warns(UserWarning, match="unexpected column miles"):
        done = run(spark, models, {"trips": trips})
    assert done.summary.first()["outcome"] == "problems"
    with pytest.raises(RunFailed, match="unexpected column miles"):
        run(spark, models, {"trips": trips}, strict=True)
    run(spark, [Model("m", passing, {"data": Input("trips")}, columns=["*"])], {"trips": trips}, strict=True)


def test_typed_contract(spark, trips):
    fields = [contracts.Field("zone", "Int32", nullable=False, lineage="trips['zone']"), contracts.Field("miles", "Float64")]
    models = [Model("m", passing, {"data": Input("trips")}, schema=fields)]
    run(spark, models, {"trips": trips}, strict=True)
    with_null = trips.union(spark.createDataFrame([(None, 1.0)], trips.schema))
    with pytest.raises(RunFailed, match="zone has 1 nulls"):
        run(spark, models, {"trips": with_null}, strict=True)
    with pytest.raises(RunFailed, match="miles is string"):
        run(spark, models, {"trips": trips.withColumn("miles", F.lit("x"))}, strict=True)


def test_contract_types(spark):
    with pytest.raises(contracts.ContractBroken, match="lose precision"):
        contracts.Field("t", "TimestampNano").spark_type()
    assert contracts.Field("t", "TimestampNanoUTC", allow_truncate=True).spark_type().simpleString() == "timestamp"
    assert contracts.Field("t", "TimestampMicro").spark_type().simpleString() == "timestamp_ntz"
    with pytest.raises(contracts.ContractBroken, match="unknown type"):
        contracts.Field("t", "Decimal").spark_type()
    with pytest.raises(contracts.ContractBroken, match="lineage"):
        contracts.Field("t", "Int32", lineage="trips.zone").source()


def test_projection_schema_on_input(spark, trips):
    fields = [contracts.Field("area", "Int32", lineage="trips['zone']")]
    models = [Model("m", passing, {"data": Input("trips", projection=fields)}, columns=["area"])]
    assert run(spark, models, {"trips": trips}, strict=True).outputs["m"].columns == ["area"]
    with pytest.raises(contracts.ContractBroken, match="not available"):
        contracts.project(trips, [contracts.Field("other", "Int32")])


def test_outputs_are_published_together(spark, lake, trips):
    models = [
        Model("a", passing, {"data": Input("trips")}, strategy="REPLACE"),
        Model("b", passing, {"data": Input("a")}, strategy="APPEND"),
        Model("c", passing, {"data": Input("a")}),
    ]
    done = run(spark, models, {"trips": trips}, lake=lake, message="nightly")
    assert done.version == 1 and lake.read("b").count() == 3
    assert [r["table"] for r in lake.tables().collect()] == ["a", "b"]
    run(spark, models, {"trips": trips}, lake=lake)
    assert (lake.read("a").count(), lake.read("b").count()) == (3, 6)
    assert {r["model"]: r["rows"] for r in done.summary.collect()} == {"a": 3, "b": 3, "c": None}


def test_without_transaction_each_output_is_a_version(spark, lake, trips):
    models = [
        Model("a", passing, {"data": Input("trips")}, strategy="REPLACE"),
        Model("b", passing, {"data": Input("a")}, strategy="REPLACE"),
    ]
    run(spark, models, {"trips": trips}, lake=lake, transaction=False)
    assert lake.versions() == [1, 2]


def test_strict_failure_publishes_nothing(spark, lake, trips):
    models = [
        Model("a", passing, {"data": Input("trips")}, strategy="REPLACE"),
        Model("b", passing, {"data": Input("a")}, strategy="REPLACE"),
    ]
    bad = [Expectation("b", checks=[q.mean_greater_than("miles", 100)])]
    with pytest.raises(q.ExpectationFailed, match="mean_greater_than"):
        run(spark, models, {"trips": trips}, lake=lake, expectations=bad, strict=True)
    assert lake.versions() == []
    with pytest.warns(UserWarning, match="mean_greater_than"):
        done = run(spark, models, {"trips": trips}, lake=lake, expectations=bad)
    assert done.version == 1 and [passed for _, passed, _ in done.expectations] == [False]


@pytest.mark.parametrize("answer, text", [(5, "unsupported type"), (False, "returned false")])
def test_expectation_functions_in_a_run(spark, trips, answer, text):
    models = [Model("a", passing, {"data": Input("trips")})]
    bad = [Expectation("a", lambda df: answer, columns=["miles"], name="mine")]
    with pytest.raises(q.ExpectationFailed, match=text):
        run(spark, models, {"trips": trips}, expectations=bad, strict=True)
    with pytest.warns(UserWarning, match=text):
        run(spark, models, {"trips": trips}, expectations=bad)


def test_expectation_on_a_source(spark, trips):
    good = [Expectation("trips", checks=[q.no_nulls("zone")])]
    done = run(spark, [Model("a", passing, {"data": Input("trips")})], {"trips": trips}, expectations=good, strict=True)
    assert done.expectations == [("no_nulls(zone)", True, "")]


def test_dry_run_and_preview(spark, lake, trips):
    models = [Model("a", passing, {"data": Input("trips")}, strategy="REPLACE")]
    done = run(spark, models, {"trips": trips}, lake=lake, dry=True, preview_mode="tail", strict=True)
    assert lake.versions() == [] and done.version is None
    assert done.previews["a"].count() == 3


def test_input_at_a_version(spark, lake, trips):
    lake.publish({"trips": trips})
    lake.publish({"trips": trips.limit(1)})
    models = [Model("old", passing, {"data": Input("trips", ref=1)}), Model("new", passing, {"data": Input("trips")})]
    outputs = run(spark, models, lake=lake).outputs
    assert (outputs["old"].count(), outputs["new"].count()) == (3, 1)


def test_model_must_return_a_table(spark, trips):
    with pytest.raises(RunFailed, match="not a DataFrame"):
        run(spark, [Model("a", lambda data: 5, {"data": Input("trips")})], {"trips": trips})


def test_relations_are_what_a_statement_reads():
    assert relations("SELECT SUM(x) AS revenue FROM orders o, (items i) JOIN `parts` ON revenue = 1") == {"orders", "items", "parts"}
    assert relations("SELECT * FROM a JOIN b ON a.x = b.y LEFT JOIN c USING (x) ORDER BY z") == {"a", "b", "c"}
    assert relations("SELECT * FROM (SELECT x FROM t) AS s, u WHERE EXISTS (SELECT 1 FROM ns)") == {"t", "u", "ns"}
    assert relations("WITH orders AS (SELECT 'FROM p' FROM orders) SELECT * FROM orders -- FROM v") == {"orders"}
    assert {"t", "u"} <= relations("SELECT * FROM (SELECT x, y FROM t) JOIN (u) ON sum(x) = 1")


def test_an_alias_named_like_a_model_makes_no_cycle():
    models = [
        sql_text_model("revenue", "SELECT * FROM totals"),
        sql_text_model("totals", "SELECT SUM(x) AS revenue FROM orders ORDER BY revenue"),
    ]
    assert [m.name for m in ordered(models, {"orders"})] == ["totals", "revenue"]


def test_failed_and_skipped_models_are_in_the_summary(spark, lake):
    """A body that raises, and one whose rows raise when they are written; nothing is published."""
    def raises(rows):
        raise KeyError("no such thing")

    bad_rows = lambda rows: rows.select(F.raise_error(F.lit("bad row")).cast("int").alias("id"))
    for body, told in ((raises, "KeyError"), (bad_rows, "bad row")):
        lake.publish({"src": spark.range(3)})
        before = lake.versions()
        models = [
            Model("first", lambda rows: rows, {"rows": Input("src")}, strategy="REPLACE"),
            Model("broken", body, {"rows": Input("first")}, strategy="REPLACE"),
            Model("after", lambda rows: rows, {"rows": Input("broken")}, strategy="REPLACE"),
        ]
        done = run(spark, models, lake=lake, stop=False)
        found = {r["model"]: (r["outcome"], r["problems"]) for r in done.summary.collect()}
        assert not done.succeeded and done.version is None and lake.versions() == before
        assert found["first"][0] == "succeeded" and found["after"] == ("skipped", []) and found["broken"][0] == "failed"
        assert told in found["broken"][1][0]
        with pytest.raises(Exception) as stopped:
            run(spark, models, lake=lake)
        assert {r["model"]: r["outcome"] for r in stopped.value.run.summary.collect()}["broken"] == "failed"
