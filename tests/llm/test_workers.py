"""All queries of the package where workers do not have it: the driver alone knows where it lies."""

import os
import subprocess
import sys
import textwrap

from tests.llm.corpus import awkward

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
    import sys
    sys.path.insert(0, sys.argv[1])
    from tidemark.session import build_session
    import __spark_entry__ as entry
    spark = build_session(4, "workers", partitions=4)
    lone = spark.range(1).mapInArrow(lambda bs: ([__import__("tidemark"), b][1] for b in bs), "id long")
    try:
        lone.collect()
        sys.exit("workers have the package")
    except Exception:
        pass
    for name, build in entry.queries().items():
        if name == "pipeline" or name.startswith("op"):
            print(name, build(spark, sys.argv[2]).count(), flush=True)
"""


def test_queries_run_without_the_package_on_workers(spark, small, tmp_path):
    rows = [(k, t, "en" if i % 3 else "de", "s", len(t or "")) for i, (k, t) in enumerate(awkward(n=30)) if k is not None and len(t or "") < 9000]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, i % 2, i % 5 == 0) for i, (k, *_) in enumerate(rows)]
    spark.createDataFrame([(k, q, int(t)) for k, q, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("benchmark", "pages"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(20).write.parquet(f"{tmp_path}/{name}.parquet")
    away = tmp_path / "away"
    away.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", textwrap.dedent(SCRIPT), REPO, str(tmp_path)], cwd=away, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-3000:]
    counts = dict(line.split() for line in ran.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert len(counts) == 14 and all(int(counts[n]) == len(rows) for n in counts if n[:4] in ("op2_", "op3_", "op4_", "op6_", "op7_", "op8_", "op9_") or n[:5] in ("op10_", "op12_", "op13_"))
