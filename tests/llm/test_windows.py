import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.llm.corpus import awkward, frame
from tidemark.llm.chunks import CHUNK_BYTES, as_bytes, lay_chunks
from tidemark.llm.queries import QUERIES
from tidemark.llm.windows import remove_repeats, repeats, report_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [3, 7, 35])
def test_against_brute_force(spark, width):
    rows = awkward()
    got = report_repeats(frame(spark, rows), window=width).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, width)


def test_empty_table(spark):
    assert report_repeats(frame(spark, []), window=3).collect() == []


def test_intervals_are_maximal(spark):
    rows = [(1, "x a b c d y"), (2, "a b c d z"), (3, "q")]
    got = {r.doc_id: [(i["first"], i["last"]) for i in r.removed] for r in report_repeats(frame(spark, rows), window=3).collect()}
    assert got == {1: [(1, 4)], 2: [(0, 3)], 3: []}


def test_rewrite_keeps_columns_and_other_texts(spark):
    rows = [(1, "x  a b c y", "k"), (2, "a b c\nz", None), (3, "p  q\tr", "k"), (4, None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string")
    got = remove_repeats(docs, window=3)
    assert got.schema == docs.schema
    assert sorted(map(tuple, got.collect())) == [(1, "x y", "k"), (2, "z", None), (3, "p  q\tr", "k"), (4, None, "k")]


def test_query_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_substring_dedup"](spark, small).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 35)


def test_chunks_are_compressed_once(spark):
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in lay_chunks(frame(spark, awkward()), "text").inputFiles()]
    found = {f.row_group(i).column(c).compression for f in files for i in range(f.num_row_groups) for c in range(3)}
    assert found == {"UNCOMPRESSED"}


def test_memory_of_a_full_chunk():
    """Words are hashed and cut slice by slice: two workers and a JVM share an executor's room."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(24):x}" for _ in range(400)) for _ in range(CHUNK_BYTES // 2800)]
    levels = [zlib.compress(b"\x01" * (len(texts) * (400 - 34)))]
    row = {"chunk": "c", "docs": as_bytes(pa.table({"doc_id": range(len(texts)), "text": texts})), "levels": levels}
    size = sum(map(len, texts))
    del texts
    tracemalloc.start()
    try:
        for _ in repeats(row, "text", 35):
            pass
        assert tracemalloc.get_traced_memory()[1] < 11 * size
    finally:
        tracemalloc.stop()
