import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.streaming import jobs

DDL = "ts timestamp, key string, value double"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{folder}/in/{name}")


def stream(spark, folder):
    return jobs.file_stream(spark, f"{folder}/in/*", DDL, files_per_batch=1)


def test_import_picks_up_new_files_only(spark, folder):
    arrive(spark, folder, "1", [(at(1), "a", 1.0)])
    for _ in range(2):
        jobs.import_stream(stream(spark, folder), f"{folder}/out", f"{folder}/cp")
    arrive(spark, folder, "2", [(at(2), "a", 2.0)])
    jobs.import_stream(stream(spark, folder), f"{folder}/out", f"{folder}/cp")
    assert sorted(r["value"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1.0, 2.0]


def test_late_rows_are_dropped_after_the_bound(spark, folder):
    def stats():
        return jobs.windowed_stats(stream(spark, folder), "ts", "key", "value", f"{folder}/out", f"{folder}/cp", "1 hour", "1 hour")

    arrive(spark, folder, "1", [(at(1, 5), "a", 1.0), (at(1, 50), "a", 3.0)])
    stats()
    arrive(spark, folder, "2", [(at(1, 55), "a", 8.0), (at(4), "a", 5.0)])  # late, within the bound
    stats()
    arrive(spark, folder, "3", [(at(1, 10), "a", 100.0), (at(4, 30), "a", 7.0)])  # the first is too late now
    found = {r["start"].hour: (r["n"], r["highest"], r["mean"]) for r in stats().collect()}
    assert found == {1: (3, 8.0, 4.0), 4: (2, 7.0, 6.0)}


def test_first_and_best_per_key(spark, folder):
    arrive(spark, folder, "1", [(at(1), "a", 1.0), (at(1, 1), "b", 2.0)])
    arrive(spark, folder, "2", [(at(1, 2), "a", 9.0)])
    first = jobs.first_per_key(stream(spark, folder), ["key"], "ts", f"{folder}/first", f"{folder}/cp1", "1 hour")
    assert sorted(r["key"] for r in first.collect()) == ["a", "b"]
    best = jobs.best_per_key(stream(spark, folder), ["key"], "value", f"{folder}/best", f"{folder}/cp2")
    assert {(r["key"], r["value"]) for r in best.collect()} == {("a", 9.0), ("b", 2.0)}


def test_change_merge_over_batches(spark, folder):
    ddl = "k int, v string, op string, seq int"
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for i, rows in enumerate([[(1, "a2", "update", 1), (3, "c", "insert", 1)], [(1, None, "delete", 2)]]):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/in/{i}")
        changes = jobs.file_stream(spark, f"{folder}/in/*", ddl, files_per_batch=1)
        merged = jobs.merge_stream(changes, base, ["k"], ["seq"], f"{folder}/log", f"{folder}/cp")
    assert {(r["k"], r["v"]) for r in merged.collect()} == {(2, "b"), (3, "c")}


def test_audit_sets_bad_rows_aside(spark, folder):
    arrive(spark, folder, "1", [(at(1), "a", 1.0), (at(1), "a", -1.0)])
    arrive(spark, folder, "2", [(at(2), None, 4.0)])
    checks = [q.positive("value"), q.no_nulls("key"), q.mean_greater_than("value", 0.5)]
    good, bad, results = f"{folder}/good", f"{folder}/bad", f"{folder}/results"
    jobs.audit_stream(stream(spark, folder), checks, good, bad, results, f"{folder}/cp")
    assert jobs.read_batches(spark, good).count() == 1
    assert jobs.read_batches(spark, bad).count() == 2
    outcomes = jobs.read_batches(spark, results).groupBy("check").agg(F.count_if("passed").alias("n")).collect()
    assert {r["check"]: r["n"] for r in outcomes} == {"positive": 1, "no_nulls": 1, "mean_greater_than": 1}


def test_repeated_batch_changes_nothing(spark, folder):
    df = spark.createDataFrame([(1,)], "x int")
    for _ in range(2):
        df.write.mode("overwrite").parquet(jobs.batch_folder(f"{folder}/t", 0))
    assert jobs.read_batches(spark, f"{folder}/t").count() == 1


def test_target_belongs_to_one_checkpoint_and_no_data_is_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = jobs.file_stream(spark, str(tmp_path / "in"), "k int, v int")
    first = jobs.best_per_key(stream, ["k"], "v", str(tmp_path / "out"), str(tmp_path / "c1"))
    assert first.columns == ["k", "v"] and first.count() == 0
    with pytest.raises(ValueError, match="another target"):
        jobs.best_per_key(stream, ["k"], "v", str(tmp_path / "out"), str(tmp_path / "c2"))


def counted(spark, folder, n):
    for i in range(n):
        spark.createDataFrame([(i % 4, float(i), at(1, i))], "key int, value double, ts timestamp").coalesce(1).write.parquet(f"{folder}/in/{i:03d}")
    return jobs.file_stream(spark, f"{folder}/in/*", "key int, value double, ts timestamp", files_per_batch=1)


def test_fifty_batches_read_as_a_base_and_few_folders(spark, folder):
    best = jobs.best_per_key(counted(spark, folder, 50), ["key"], "value", f"{folder}/out", f"{folder}/cp")
    places = {f.partition("/out/")[2].rpartition("/")[0] for f in best.inputFiles()}
    assert sum(p.startswith("_base") for p in places) == 1 and len(places) <= 1 + jobs.FOLD_EVERY + 1
    assert {(r["key"], r["value"]) for r in best.select("key", "value").collect()} == {(0, 48.0), (1, 49.0), (2, 46.0), (3, 47.0)}


@pytest.mark.parametrize("stage", ["reduce", "record"])
def test_a_fold_that_dies_loses_nothing(spark, folder, monkeypatch, stage):
    schema = spark.createDataFrame([], "key int, value long").schema
    folded = jobs.Folded(spark, f"{folder}/t", schema, lambda rows: rows.groupBy("key").agg(F.sum("value").alias("value"), F.max("batch").alias("batch")), 3)

    def write(n):
        folded.write(spark.createDataFrame([(n % 2, 1)], schema), n)

    def state():
        return {r["key"]: r["value"] for r in folded.read().collect()}

    for n in range(3):
        write(n)

    def dies(*_):
        raise RuntimeError("lost")

    # the fold before batch 3 is done for good dies while it writes its base, or before its record is there
    if stage == "reduce":
        monkeypatch.setattr(folded, "reduce", dies)
    else:
        monkeypatch.setattr(folded.records, "create", dies)
    with pytest.raises(RuntimeError):
        write(3)
    monkeypatch.undo()
    assert state() == {0: 2, 1: 2}
    write(3)  # Spark repeats the batch
    assert folded.last()[0] == 2 and state() == {0: 2, 1: 2}
    write(3)  # and once more, after the fold
    for n in range(4, 8):
        write(n)
    write(7)
    assert folded.last()[0] == 5 and state() == {0: 4, 1: 4}
    # a base without a record counts for nothing
    spark.createDataFrame([(0, 99, 6)], "key int, value long, batch int").write.parquet(f"{folder}/t/_base/9999999999-x")
    assert state() == {0: 4, 1: 4}
    folded.expire()
    assert state() == {0: 4, 1: 4} and folded.waiting(-1) == [6, 7]


def test_a_claim_without_content_does_not_stay(spark, folder):
    """A marker appears whole: what a lost driver left aside does not count."""
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{folder}/t/batch=0")
    open(f"{folder}/t/_aside-lost", "w").close()
    jobs.claim(spark, f"{folder}/t", "mine")
    jobs.claim(spark, f"{folder}/t", "mine")
    with pytest.raises(ValueError, match="another target"):
        jobs.claim(spark, f"{folder}/t", "other")
