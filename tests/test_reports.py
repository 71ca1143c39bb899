from tidemark.operators.reports import histogram, keep_best, seeded_sample


def test_keep_best(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), (None, None, "n"), ("b", None, "m")], "k string, v int, w string")
    found = {r["k"]: (r["v"], r["w"]) for r in keep_best(df, ["k"], "v").collect()}
    assert found == {"a": (3, "z"), None: (None, "n"), "b": (None, "m")}


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(None,)], "x double")
    assert {r["bin"]: r["n"] for r in histogram(df, "x", 5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert [tuple(r) for r in histogram(df.filter("x = 3"), "x", 5).collect()] == [(0, 1)]
    assert histogram(df.filter("x > 99"), "x", 5).count() == 0


def test_seeded_sample_ignores_layout(spark):
    df = spark.range(1000)
    first = {r["id"] for r in seeded_sample(df, "id", 50, 7).collect()}
    assert first == {r["id"] for r in seeded_sample(df.repartition(13), "id", 50, 7).collect()}
    assert len(first) == 50 and first != {r["id"] for r in seeded_sample(df, "id", 50, 8).collect()}
    assert seeded_sample(df, "id", 5000, 7).count() == 1000
