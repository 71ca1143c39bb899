"""Positions, medians and lists against plain Python, with one key holding a third of all rows."""

import random
import statistics
from collections import defaultdict

import pytest

from tidemark.operators.joins import full_by_key, match_keys
from tidemark.operators.ranks import exact_median, number_ordered, number_rows, ordered_lists, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]), rng.randrange(50), rng.randrange(9)) for _ in range(3000)]
    rows += [("hot", 7, 7)] * 1500  # copies of one row
    return spark.createDataFrame(rows, "k string, o int, v int").repartition(6), rows


def test_number_rows(spark, skewed):
    df, rows = skewed
    numbers = sorted(r["row_number"] for r in number_rows(df).collect())
    assert numbers == list(range(1, len(rows) + 1))


def test_number_rows_of_nothing(spark, skewed):
    assert number_rows(skewed[0].limit(0)).count() == 0


@pytest.mark.parametrize("block", [100_000, 7])
def test_number_ordered(spark, skewed, monkeypatch, block):
    monkeypatch.setattr("tidemark.operators.ranks.BLOCK", block)
    df, rows = skewed
    placed = number_ordered(df, ["o"]).collect()
    assert sorted(r["row_number"] for r in placed) == list(range(1, len(rows) + 1))
    key = [(r["o"], r["k"] or "", r["v"]) for r in sorted(placed, key=lambda r: r["row_number"])]
    assert key == sorted(key)


def test_running_total(spark):
    rows = [(k, o, 1 + o % 3) for k in ["x", "y", None] for o in range(40)]
    df = spark.createDataFrame(rows, "k string, o int, n int")
    expected, seen = {}, defaultdict(int)
    for k, o, n in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        expected[(k, o)] = seen[k]
        seen[k] += n
    found = {(r["k"], r["o"]): r["before"] for r in running_total(df, ["k"], ["o"], "n", "before").collect()}
    assert found == expected


def test_exact_median(spark, skewed):
    df, rows = skewed
    groups = defaultdict(list)
    for k, o, v in rows:
        groups[k].append(o)
    found = {r["k"]: r["m"] for r in exact_median(df, ["k"], "o", "m").collect()}
    assert found == {k: float(statistics.median(values)) for k, values in groups.items()}


def test_median_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 4.0), (1, 1.0), (2, None)], "k int, x double")
    assert [(r["k"], r["m"]) for r in exact_median(df, ["k"], "x", "m").collect()] == [(1, 2.5)]


@pytest.mark.parametrize("piece", [100_000, 64])
def test_ordered_lists(spark, skewed, piece):
    df, rows = skewed
    groups = defaultdict(list)
    for k, o, v in sorted(rows, key=lambda r: (r[1], r[2])):
        groups[k].append(v)
    pieces = defaultdict(dict)
    for r in ordered_lists(df, ["k"], ["o"], "v", "items", piece=piece).collect():
        assert len(r["items"]) <= piece
        pieces[r["k"]][r["piece_no"]] = r["items"]
    joined = {k: [v for n in sorted(found) for v in found[n]] for k, found in pieces.items()}
    assert joined == dict(groups)


def test_ordered_lists_keep_null_items(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, None)], "k int, o int, v string")
    assert ordered_lists(df, ["k"], ["o"], "v", "items").first()["items"] == [None, "b", None]


def test_match_keys_on_nulls(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 5)], "k string, r int")
    assert [tuple(r) for r in match_keys(left, right, ["k"]).collect()] == [(None, 1, 5)]
    assert match_keys(left, right, ["k"], "left_anti").first()["k"] == "a"


def test_full_by_key(spark):
    left = spark.createDataFrame([(1, "x"), (None, "n"), (2, "y")], "a int, l string")
    right = spark.createDataFrame([(1, "r1"), (3, "r3"), (None, "rn")], "b int, r string")
    found = sorted((tuple(r) for r in full_by_key(left, right, "a", "b").collect()), key=str)
    expected = [(1, "x", "r1"), (2, "y", None), (None, "n", None), (3, None, "r3"), (None, None, "rn")]
    assert found == sorted(expected, key=str)


@pytest.mark.parametrize("small,accuracy,block", [(50, 20, 100_000), (50, 20, 3), (10**6, 1000, 100_000)])
def test_median_of_large_keys(spark, monkeypatch, small, accuracy, block):
    """Sketched bounds, ranked middles and keys sorted at once agree; a third of all rows has one key, and values repeat."""
    from tidemark.operators import ranks

    for name, bound in (("SMALL", small), ("ACCURACY", accuracy), ("BLOCK", block)):
        monkeypatch.setattr(ranks, name, bound)
    rng = random.Random(5)
    rows = [(rng.choice([None, "hot", "hot", *"abcdefgh"]) if i % 3 else "hot", float(rng.choice([rng.randint(-50, 50), rng.gauss(0, 1e6), 7]))) for i in range(4000)]
    rows += [("one", 2.5), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert {r["k"]: r["m"] for r in exact_median(df, ["k"], "v", "m").collect()} == {k: statistics.median(v) for k, v in groups.items()}
    assert [r["m"] for r in exact_median(df, [], "v", "m").collect()] == [statistics.median([v for _, v in rows if v is not None])]


def test_median_when_a_sketch_misses(spark, monkeypatch):
    from tidemark.operators import ranks

    monkeypatch.setattr(ranks, "SMALL", 10)
    monkeypatch.setattr(ranks.F, "percentile_approx", lambda *_: ranks.F.first(ranks.F.array(ranks.F.lit(1e9), ranks.F.lit(2e9))))
    df = spark.createDataFrame([("a", float(i)) for i in range(101)], "k string, v double")
    assert [tuple(r) for r in exact_median(df, ["k"], "v", "m").collect()] == [("a", 50.0)]
    assert exact_median(df.filter("false"), [], "v", "m").collect() == []
