from types import SimpleNamespace

import pytest

from tidemark import session


def fake(master, named=None, checkpoint=None):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: named))


def test_shared_root_is_the_clusters():
    assert session.shared_root(fake("spark://host", "s3://bucket/cp/")) == "s3://bucket/cp"
    assert session.shared_root(fake("spark://host", None, "hdfs:///cp/1")) == "hdfs:///cp/1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake("spark://host"))


def test_local_root_is_made_once(tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_local_roots", {})
    monkeypatch.setattr("tempfile.mkdtemp", lambda prefix: str(tmp_path))
    assert session.shared_root(fake("local[4]")) == session.shared_root(fake("local[4]")) == str(tmp_path)


def test_written_survives_and_keeps_its_schema(spark):
    df = session.written(spark.range(5).selectExpr("id", "cast(null as string) AS name"), "t")
    assert df.count() == 5 and df.columns == ["id", "name"]
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_tune_sets_runtime_options(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    assert session.tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"
