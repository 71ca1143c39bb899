import hashlib
import re

import pytest

from tests import oracle
from tests.llm.corpus import awkward, frame
from tidemark.llm.benchmark import decontaminate, report_hits
from tidemark.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def places(text, items, width):
    w, hit, found = words(text), set(), set()
    for key, item in items:
        v = words(item)
        n = min(width, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(key)
    return w, hit, found


def brute(rows, items, width):
    out = []
    for key, text in rows:
        w, hit, found = places(text, items, width)
        names = ",".join(sorted(str(x) for x in found if x is not None))
        n = len({x for x in found if x is not None})
        out.append((key, len(w), len(hit), n, hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench(rows):
    own = [(i, " ".join(WORD.findall((rows[i][1] or "").translate(LOWER))[5:30])) for i in range(0, 60, 4)]
    return [*own, (900, "One"), (901, "a a A a"), (902, None), (903, ""), (904, "-- !"), (905, rows[8][1]), (905, rows[8][1]), (906, "ab CD"), (10, "É é"), (None, "one two")]


@pytest.mark.parametrize("width,limit", [(3, 1 << 25), (10, 1 << 25), (10, 0)])
def test_against_brute_force(spark, monkeypatch, width, limit):
    monkeypatch.setattr("tidemark.llm.benchmark.BROADCAST_CHARS", limit)
    rows = [*awkward(), (800, "x ONE, y"), (801, "é É"), (802, "Ab.cd")]
    items = spark.createDataFrame(bench(rows), "item_id long, text string")
    got = report_hits(frame(spark, rows), items, width=width).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, bench(rows), width)


def test_removal(spark):
    rows = awkward()
    items = spark.createDataFrame(bench(rows), "item_id long, text string")
    docs = frame(spark, rows)
    clean = decontaminate(docs, items)
    assert clean.schema == docs.schema
    assert sorted(map(tuple, clean.select("doc_id", "text").collect()), key=str) == sorted(
        [r for r in rows if not places(r[1], bench(rows), 10)[1]], key=str
    )
    cut = decontaminate(docs, items, remove="spans").select("doc_id", "text").collect()
    want = []
    for key, text in rows:
        _, hit, _ = places(text, bench(rows), 10)
        raw = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        want.append((key, " ".join(w for i, w in enumerate(raw) if i not in hit) if hit else text))
    assert sorted(map(tuple, cut), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs, items = frame(spark, awkward()), spark.createDataFrame([], "item_id long, text string")
    assert report_hits(docs.limit(0), items).collect() == []
    assert report_hits(docs, items).filter("contaminated").count() == 0


def test_query(spark, small):
    name = "op6_benchmark_decontamination"
    got = QUERIES[name](spark, small)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items, 10)
    assert oracle.compare(name, got.toArrow(), oracle.fetch(oracle.connect(small), ORACLES[name])) == []
