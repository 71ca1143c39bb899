import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.corpus import awkward, frame
from tidemark.llm.packing import first_fit, pack
from tidemark.llm.queries import QUERIES, public_file

ODD = ["don't stop 'TIS it's we'll", "Ünï × ÷ ÀÉß", "<|endoftext|> x<|startoftext|>", "á éx ﬁ İ ΑΣ", "12345 3rd x²½", " nb sp \x85 \x1cq"]


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=100, deadline=None)
def test_first_fit_is_first_fit_decreasing(sizes):
    bins, offsets = first_fit(np.array(sizes, np.int64), 20)
    room, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        if b == len(room):
            room.append(20)
        want[i] = (b, 20 - room[b])
        room[b] -= sizes[i]
    assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [want[i] for i in range(len(sizes))]


def checked(rows, pieces, length, waste):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_file("word_bpe_49k.json"))
    ids = defaultdict(list)
    for key, text in rows:
        ids[key].append([*model.encode(text or "", add_special_tokens=False).ids, 1])
    got, room = defaultdict(list), defaultdict(list)
    for p in pieces:
        got[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        room[p.sequence_id].append((p.offset, p.length))
    want = defaultdict(list)
    for key, copies in ids.items():
        for x in copies:
            for s in range(0, len(x), length):
                own = np.array(x[s : s + length], "<u4")
                want[key].append((s, len(own), zlib.crc32(own), len(x)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    assert len(room) <= (1 + waste) * sum(n for parts in room.values() for _, n in parts) / length + 2


@pytest.mark.parametrize("length,group", [(2048, 4000), (64, 10)])
def test_ids_and_layout(spark, length, group):
    rows = [*awkward(), *enumerate(ODD, 1000)]
    with open(public_file("word_bpe_49k.json"), encoding="utf-8") as file:
        got = pack(frame(spark, rows), file.read(), length=length, group=group).collect()
    checked(rows, got, length, 0.35)


def test_equal_rows_of_one_key_spread_over_batches(spark):
    rows = [(7, "the same text")] * 2000
    with open(public_file("word_bpe_49k.json"), encoding="utf-8") as file:
        got = pack(frame(spark, rows), file.read(), group=50).collect()
    checked(rows, got, 2048, 40)
    assert max(Counter(r.sequence_id >> 32 for r in got).values()) < 150


def test_empty_table(spark):
    with open(public_file("word_bpe_49k.json"), encoding="utf-8") as file:
        assert pack(frame(spark, []), file.read()).collect() == []


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    checked(rows, QUERIES["op1_packing"](spark, small).collect(), 2048, 0.01)
