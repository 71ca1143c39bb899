import hashlib
import random
from collections import Counter

import pytest

from tests.llm.corpus import awkward, frame
from tidemark.llm.queries import QUERIES
from tidemark.llm.suffixes import remove_repeats, report_repeats


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,gram,hot_runs", [(20, 8, 2000), (20, 8, 3), (50, 16, 2000), (200, 64, 0)])
def test_against_brute_force(spark, width, gram, hot_runs):
    rows = awkward()
    got = report_repeats(frame(spark, rows), width=width, gram=gram, hot_runs=hot_runs, keep_first=False).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, width)


@pytest.mark.parametrize("hot_runs", [2000, 1])
def test_first_copy_stays(spark, hot_runs):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abc ") for _ in range(60))) for i in range(30)]
    shared = "".join(rng.choice("abc ") for _ in range(40))
    rows = [(i, t[:20] + shared[:k] + t[20:]) for (i, t), k in zip(rows, [40, 30, 25, 40, 0] * 6)] + [(90, rows[4][1]), (91, rows[4][1])]
    width, seen, want = 20, set(), {}
    for key, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if t[i : i + width] in seen:
                gone[i : i + width] = [True] * width
            seen.add(t[i : i + width])
        want[key] = "".join(c for c, g in zip(t, gone) if not g)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    order = {r.doc_id: i for i, r in enumerate(docs.collect())}
    assert list(order) == [k for k, _ in rows]
    got = remove_repeats(docs, width=width, gram=8, hot_runs=hot_runs)
    assert got.schema == docs.schema
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_empty_table(spark):
    assert report_repeats(frame(spark, [])).collect() == []


def test_query_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op9_suffix_array_dedup"](spark, small).collect()), key=str) == brute(rows, 200)
