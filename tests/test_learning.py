import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.functions.text import named_groups, page_text
from tidemark.functions.times import whole_minutes
from tidemark.functions.vectors import cosine, nearest
from tidemark.operators.enrich import enrich, extract_text
from tidemark.plans import learning


def test_skip_gram(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "b", "d"],)] * 5 + [(["once"],)], "items array<string>")
    vectors = {r["item"]: r["vector"] for r in learning.skip_gram(df, "items").collect()}
    assert set(vectors) == {"a", "b", "c", "d"}
    assert {len(v) for v in vectors.values()} == {48}


def test_vocabulary_is_checked(spark, monkeypatch):
    monkeypatch.setattr(learning, "VOCABULARY_FLOATS", 48)
    df = spark.createDataFrame([(["a", "b"],)] * 3, "items array<string>")
    with pytest.raises(ValueError, match="exceed one Word2Vec model"):
        learning.skip_gram(df, "items")


def test_skip_gram_keeps_the_model_off_the_driver(spark):
    groups = [[f"{group}{i}" for i in range(8)] for group in "xyz"]
    lists = [([*group[i:], *group[:i]],) for group in groups for i in range(8)] * 8 + [(None,), (["x0", None, "rare", "x1", None],)]
    vectors = learning.skip_gram(spark.createDataFrame(lists, "items array<string>"), "items", partitions=3, iterations=4)
    assert vectors.inputFiles()  # a table, not rows sent by the driver
    found = {r["item"]: r["vector"] for r in vectors.collect()}
    assert set(found) == {None, *(item for group in groups for item in group)}

    def similar(a, b):
        return sum(p * q for p, q in zip(found[a], found[b])) / math.dist(found[a], [0] * 48) / math.dist(found[b], [0] * 48)

    for group in groups:
        for item in group:
            nearest_item = max((x for x in found if x not in (None, item)), key=lambda x: similar(item, x))
            assert nearest_item in group


def test_vectors_with_metadata_are_not_sent_by_the_driver(spark, folder):
    when = dt.datetime(2024, 1, 1)
    lines = [(order, order % 3 + line, 1, line, 10.0, 1.0, 0.0, 0.0, "A", "O", when) for order in range(12) for line in range(3)]
    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(i, f"part {i}", "b", "PROMO", 1, 1.0) for i in range(5)] * 2
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, schema).write.parquet(f"{folder}/part.parquet")
    found = QUERIES["item_vectors_with_metadata"](spark, folder)
    assert any("/model-" in path for path in found.inputFiles())
    assert sorted(tuple(r) for r in found.collect()) == [(i, 48, n, f"part {i}", "b") for i, n in enumerate([4, 8, 12, 8, 4])]


def test_rounds_use_every_pair_once(spark):
    lists = [[1, 2, 3, 2], [5], list(range(100, 130)), [7, 7], []]
    tokens = spark.createDataFrame([(keys,) for keys in lists], "keys array<bigint>").coalesce(2)

    def used(blocks):
        pairs = Counter()
        for turn in range(blocks):
            for row in tokens.mapInArrow(learning._pairs(blocks, turn), learning.STATE).collect():
                items, contexts = (memoryview(row[name]).cast("q").tolist() for name in ("keys", "vectors"))
                assert {item % blocks for item in items} == {row["block"]}
                assert {context % blocks for context in contexts} == {(row["block"] + turn) % blocks}
                pairs.update(zip(items, contexts))
        return pairs

    whole = used(1)
    assert used(4) == whole == used(7)
    near = Counter((a, b) for keys in lists for i, a in enumerate(keys) for j, b in enumerate(keys) if 0 < abs(i - j) <= 5)
    assert whole <= near and {(7, 7)} <= set(whole) and len(whole) > len(near) / 3
    assert {(a, b) for a, b in near if a >= 100 and abs(a - b) == 1} <= set(whole)  # a window is 1 to 5 wide


def test_forecast_follows_a_line(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(28)]
    rows = [("up", d, 10 + 2 * i) for i, d in enumerate(days)] + [("flat", days[0], 5)]
    series = spark.createDataFrame(rows, "k string, ds date, y long")
    found = {(r["k"], r["ds"]): r for r in learning.forecast(series, ["k"], 3).collect()}
    assert len(found) == 28 + 3 + 1 + 3
    ahead = found[("up", dt.date(2024, 1, 30))]
    assert math.isclose(ahead["yhat"], 10 + 2 * 29, abs_tol=1e-6)
    assert ahead["yhat_lower"] <= ahead["yhat"] <= ahead["yhat_upper"]
    assert math.isclose(found[("flat", dt.date(2024, 1, 4))]["yhat"], 5.0)


def test_forecast_of_one_series(spark):
    rows = [(dt.date(2024, 1, d), 3 * d) for d in range(1, 15)]
    found = learning.forecast(spark.createDataFrame(rows, "ds date, y long"), [], 2)
    assert found.count() == 16


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [2.0, 0.0])], "id int, v array<float>")
    found = nearest(df, "id", "v", [3.0, 0.0], 3).collect()
    assert [r["id"] for r in found] == [1, 4, 2]
    assert math.isclose(found[2]["score"], 1 / math.sqrt(2))
    scores = df.select(cosine(F.col("v"), F.array(F.lit(1.0), F.lit(1.0))).alias("s")).collect()
    assert scores[2]["s"] is None
    with pytest.raises(ValueError):
        nearest(df, "id", "v", [0.0, 0.0], 1)


def test_page_text(spark):
    html = "<html><STYLE>p{}</STYLE><script>var a='<p>';</script><!-- <p>no</p> --><p>A&amp;B &lt;x&gt;</p>\n <b>c</b></html>"
    df = spark.createDataFrame([(html,), (None,)], "html string")
    assert [r[0] for r in df.select(page_text(F.col("html"))).collect()] == ["A&B <x> c", None]


def test_extract_text(spark):
    df = spark.createDataFrame([(1, "HELLO MARK rest", "p"), (2, "no cut", "q"), (3, None, "r")], "id int, raw string, path string")
    out = extract_text(df, "raw", "text", marker="mark", parser=str.lower, drop=["path"])
    assert {r["id"]: r["text"] for r in out.collect()} == {1: "hello ", 2: "no cut", 3: None}
    assert "path" not in out.columns


def test_enrich_calls_once_per_batch(spark):
    df = spark.createDataFrame([(i, f"w{i}") for i in range(10)], "id int, word string").coalesce(1)

    def call(batch):
        for i, word in enumerate(batch["word"]):
            for n in range(int(word[1:]) % 3):
                yield {"row": i, "n": n, "size": len(batch)}

    out = enrich(df, call, "n int, size int", ["id"], batch=4, rename="source_{}").collect()
    assert len(out) == sum(i % 3 for i in range(10))
    assert {r["size"] for r in out} <= {4, 2}
    assert {r["source_id"] for r in out} == {i for i in range(10) if i % 3}


def test_named_groups_need_a_full_match(spark):
    df = spark.createDataFrame([("u.b-x",), ("u.b-x tail",), ("zz",)], "name string")
    out = df.select(*named_groups(F.col("name"), r"(\w+)\.(\w+)-(\w+)", ["user", "branch", "command"])).collect()
    assert [tuple(r) for r in out] == [("u", "b", "x"), (None, None, None), (None, None, None)]


def test_whole_minutes_cut_toward_zero(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 30), dt.datetime(2024, 1, 1, 0, 2)), (dt.datetime(2024, 1, 1, 0, 2), dt.datetime(2024, 1, 1, 0, 0, 30))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(whole_minutes(F.col("a"), F.col("b"))).collect()] == [1, -1]
