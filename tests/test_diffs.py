import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.diffs import apply_changes, diff_bags, diff_rows, diff_schema, latest_changes, merge_rows

DDL = "k int, a string, b int"
tables = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, None])))
few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], DDL)


@few
@given(tables, tables)
def test_diff_rows(spark, before, after):
    expected = {(k, "added") for k in after.keys() - before.keys()}
    expected |= {(k, "removed") for k in before.keys() - after.keys()}
    expected |= {(k, "changed") for k in before.keys() & after.keys() if before[k] != after[k]}
    found = diff_rows(frame(spark, before), frame(spark, after), ["k"]).collect()
    assert {tuple(r) for r in found} == expected


@few
@given(tables, tables, tables)
def test_merge_rows(spark, base, ours, theirs):
    expected, clashes = {}, set()
    for k in base.keys() | ours.keys() | theirs.keys():
        b, o, t = base.get(k), ours.get(k), theirs.get(k)
        if o != b and t != b and o != t:
            clashes.add(k)
        else:
            taken = t if t != b else o
            if taken is not None:
                expected[k] = taken
    merged, conflicts = merge_rows(frame(spark, base), frame(spark, ours), frame(spark, theirs), ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in merged.collect()} == expected
    assert {r["k"] for r in conflicts.collect()} == clashes


def test_conflict_kinds(spark):
    base, ours, theirs = {1: ("x", 1), 2: ("x", 1)}, {2: ("y", 1), 3: ("n", 1)}, {1: ("z", 1), 3: ("m", 1)}
    _, conflicts = merge_rows(frame(spark, base), frame(spark, ours), frame(spark, theirs), ["k"])
    assert {tuple(r) for r in conflicts.collect()} == {
        (1, "removed", "changed"),
        (2, "changed", "removed"),
        (3, "added", "added"),
    }


def test_duplicate_keys_are_refused(spark):
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], DDL)
    once = spark.createDataFrame([(1, "x", 1)], DDL)
    with pytest.raises(Exception, match="duplicate key"):
        diff_rows(twice, once, ["k"]).collect()
    with pytest.raises(Exception, match="duplicate key"):
        merge_rows(once, twice, once, ["k"])


def test_nulls_do_not_slide_between_columns(spark):
    before = spark.createDataFrame([(1, "x", None), (2, None, None)], "k int, a string, b string")
    after = spark.createDataFrame([(1, None, "x"), (2, None, None)], "k int, a string, b string")
    assert [tuple(r) for r in diff_rows(before, after, ["k"]).collect()] == [(1, "changed")]


def test_diff_bags(spark):
    before = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    after = spark.createDataFrame([(1,), (3,), (3,), (None,)], "x int")
    assert {tuple(r) for r in diff_bags(before, after).collect()} == {(1, -1), (2, -1), (3, 2)}


def test_diff_schema(spark):
    before = spark.createDataFrame([], "a int, b string, c double")
    after = spark.createDataFrame([], "a bigint, c double, d date")
    assert {tuple(r) for r in diff_schema(before, after).collect()} == {
        ("a", "retyped", "int", "bigint"),
        ("b", "removed", "string", None),
        ("d", "added", None, "date"),
    }


def test_apply_changes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    changes = spark.createDataFrame(
        [
            (1, "a2", "update", 1), (1, None, "delete", 2), (2, "b2", "update", 3), (3, "c", "insert", 1),
            (3, "c2", "update", 2), (4, "d", "insert", 1), (4, None, "delete", 5), (None, "n2", "update", 1),
        ],
        "k int, v string, op string, seq int",
    )
    assert latest_changes(changes, ["k"], ["seq"]).count() == 5
    found = {(r["k"], r["v"]) for r in apply_changes(base, changes, ["k"], ["seq"]).collect()}
    assert found == {(2, "b2"), (3, "c2"), (None, "n2")}


def test_a_wider_number_is_no_change_and_other_types_are_refused(spark):
    old = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    new = spark.createDataFrame([(1, 5), (2, 7)], "k bigint, v bigint")
    assert [tuple(r) for r in diff_rows(old, new, ["k"]).collect()] == [(2, "changed")]
    merged, conflicts = merge_rows(old, old, new, ["k"])
    assert conflicts.count() == 0 and sorted(map(tuple, merged.collect())) == [(1, 5), (2, 7)]
    with pytest.raises(ValueError, match="no type of v"):
        diff_rows(old, spark.createDataFrame([(1, "5")], "k int, v string"), ["k"])


def test_diff_of_tables_of_keys_alone(spark):
    old, new = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(map(tuple, diff_rows(old, new, ["k"]).collect())) == [(1, "removed"), (3, "added")]
