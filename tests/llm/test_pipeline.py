import re
from collections import Counter

import corpus_pipeline
from tests.llm.test_benchmark import places
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_packing import checked
from tidemark.llm.quality import report_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(rows, width):
    words = {k: WORD.findall(t) for k, t in rows}
    seen = Counter(tuple(w[i : i + width]) for w in words.values() for i in range(len(w) - width + 1))
    out = {}
    for key, text in rows:
        w = words[key]
        gone = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        out[key] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else text
    return {k: t for k, t in out.items() if t}


def test_each_stage_against_brute_force(spark, small, folder):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    schema, labels = docs.schema, spark.read.parquet(f"{small}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {r.doc_id: r.text for r in docs.collect()}
    steps = {
        "quality_rules": lambda have: {r.doc_id: have[r.doc_id] for r in report_quality(docs, labels).collect() if r.kept},
        "ngram_jaccard_join": lambda have: {k: have[k] for k in {c for _, _, c in components(list(have.items()), 5, 80)}},
        "substring_dedup": lambda have: cut(list(have.items()), 35),
        "benchmark_decontamination": lambda have: {k: t for k, t in have.items() if not places(t, items, 10)[1]},
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == [*steps, "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, small)
        assert made.columns == schema.names and made.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        before, want = len(want), steps[name](want)
        got = docs.collect()
        assert len(got) == len(want) and {r.doc_id: r.text for r in got} == want
        assert all(r.n_chars == len(r.text) for r in got)
        print(name, before, len(want))
    checked(list(want.items()), corpus_pipeline.STAGES[-1][1](spark, docs, small).collect(), 2048, 0.01)
    checked(list(want.items()), corpus_pipeline.run(spark, small).collect(), 2048, 0.01)


def test_empty_documents(spark, small, folder):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
